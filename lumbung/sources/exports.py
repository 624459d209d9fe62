"""Readers for CSV exports and order documents. Everything stays text until staging."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbung.constants import CUSTOMER_FIELDS, ORDER_FIELDS, PART_FIELDS, PRODUCT_FIELDS
from lumbung.operators.unnest import part_column
from lumbung.schemas import ORDER_DOCUMENT

# Where Spark puts the text of a row whose number of values is wrong, and what that row is then called.
RECORD, ROW_SHAPE = "_record", "_row_shape"


def read_csv_export(
    spark: SparkSession,
    folder: str,
    export_name: str,
    fields: tuple[str, ...],
    loaded_at: datetime,
    multiline: bool = True,
) -> DataFrame:
    """Rows of one export as text, matched to ``fields`` by header name.

    Empty values stay empty text. A field that the file lacks is NULL, and so are
    the fields at the end of a row that is too short; values beyond the header are
    left out. Such rows say ``short`` or ``long`` in ``_row_shape``, which is NULL
    for all others, so that a load can count them. A part file whose header
    differs from the others' stops the read. Without ``multiline`` a file can be
    split over tasks; a row with a line break inside quotes then comes as two short
    rows.
    """
    path = f"{folder.rstrip('/')}/{export_name}"
    reader = spark.read.options(
        header="true", quote='"', escape='"', encoding="UTF-8", enforceSchema="false", columnPruning="false",
        multiLine=str(multiline).lower(), mode="PERMISSIVE", columnNameOfCorruptRecord=RECORD,
    )
    header = reader.csv(path).columns  # looks at the first line only
    provenance = [F.lit(export_name).alias("_source_file"), F.lit(loaded_at).cast("timestamp").alias("_loaded_at")]
    if not header:
        nothing = spark.createDataFrame([], ", ".join(f"{f} string" for f in (*fields, ROW_SHAPE)))
        return nothing.select(*fields, *provenance, ROW_SHAPE)
    rows = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in (*header, RECORD)])).csv(path)
    # Spark hands over the record itself where its number of values is not that of the header.
    unquoted = F.regexp_replace(RECORD, r'"(?:[^"]|"")*"', "")
    values = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","), F.lit(""))) + 1
    shape = F.when(F.col(RECORD).isNull(), F.lit(None)).when(values < len(header), "short").otherwise("long")

    def value(field: str) -> Column:
        if field not in header:
            return F.lit(None).cast("string").alias(field)
        missing = F.col(RECORD).isNotNull() & (values <= header.index(field))
        return F.when(missing, F.lit(None)).otherwise(F.coalesce(F.col(f"`{field}`"), F.lit(""))).alias(field)

    return rows.select(*map(value, fields), *provenance, shape.alias(ROW_SHAPE))


def read_customers(
    spark: SparkSession, folder: str, export_name: str, loaded_at: datetime, multiline: bool = True
) -> DataFrame:
    return read_csv_export(spark, folder, export_name, CUSTOMER_FIELDS, loaded_at, multiline)


def read_products(
    spark: SparkSession, folder: str, export_name: str, loaded_at: datetime, multiline: bool = True
) -> DataFrame:
    return read_csv_export(spark, folder, export_name, PRODUCT_FIELDS, loaded_at, multiline)


def read_orders(
    spark: SparkSession, path: str, loaded_at: datetime, source_system: str = "documents"
) -> DataFrame:
    """Order documents from files, one JSON object per line; the nested items stay JSON text.

    Without the folder there are no documents, which the gate on raw tables reports.
    """
    try:
        documents = spark.read.schema(ORDER_DOCUMENT).option("mode", "FAILFAST").json(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        documents = spark.createDataFrame([], ORDER_DOCUMENT)
    return raw_orders_from(documents, loaded_at, source_system)


def raw_orders_from(documents: DataFrame, loaded_at: datetime, source_system: str) -> DataFrame:
    """Raw order rows from any source of documents, such as a document store's own Spark reader.

    Items may be JSON text or a nested array; ``[]`` stands for absent ones.
    """
    items = F.col("items")
    if not isinstance(documents.schema["items"].dataType, T.StringType):
        items = F.to_json(items)
    return documents.withColumn("items", F.coalesce(items, F.lit("[]"))).select(
        *ORDER_FIELDS,
        *[part_column(documents, name).alias(name) for name in PART_FIELDS],
        F.lit(source_system).alias("_source_system"),
        F.lit(loaded_at).cast("timestamp").alias("_loaded_at"),
    )
