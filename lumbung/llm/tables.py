"""Reading the given tables, carrying whole rows through an operator, batch sizes of Python workers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows handed to a Python worker at a time. Texts can be long, so batches are kept short.
ROWS_PER_BATCH = 500


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def named(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def ids_and_texts(docs: DataFrame) -> DataFrame:
    """Only the two columns that operators work on, so that other columns can have any name.

    Null ids stay null; null texts become empty.
    """
    short_batches(docs.sparkSession)
    return docs.select(
        named("doc_id").cast("long").alias("doc_id"), F.coalesce(named("text").cast("string"), F.lit("")).alias("text")
    )


def whole_rows(docs: DataFrame) -> DataFrame:
    """``row`` holds all columns as they came; ``doc_id`` and ``text`` are for the operator."""
    short_batches(docs.sparkSession)
    return docs.select(
        F.struct(*[named(c).alias(c) for c in docs.columns]).alias("row"),
        named("doc_id").cast("long").alias("doc_id"),
        F.coalesce(named("text").cast("string"), F.lit("")).alias("text"),
    )


def short_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))


def checkpointed(frame: DataFrame) -> DataFrame:
    """Cut the lineage by a checkpoint in the folder that all executors share.

    The cluster names it in ``spark.checkpoint.dir``; only a session without that setting gets one of its own.
    """
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        from lumbung.session import shared_folder

        context.setCheckpointDir(shared_folder(frame.sparkSession))
    return frame.checkpoint(eager=True)
