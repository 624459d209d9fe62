"""What lies in the landing area: daily exports named ``<dataset>_YYYYMMDD.csv``.

An export is one file, or a folder of part files under the same name.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NEWEST = "dataset string, export_name string, is_valid boolean"


def newest_export(spark: SparkSession, folder: str, dataset: str) -> tuple[str, bool] | None:
    """Name of the newest export and whether it holds any data; None without an export.

    The names in the folder are gone through one by one, so that any number of old exports needs no memory; what
    lies inside an export is only looked at for the newest one, and only until a file with data turns up.
    """
    top = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(top):
        return None
    newest, found = "", files.listStatusIterator(top)
    while found.hasNext():
        name = found.next().getPath().getName()
        if name > newest and re.fullmatch(rf"{dataset}_.*\.csv", name):
            newest = name
    return (newest, any_data(spark, f"{folder}/{newest}")) if newest else None


def any_data(spark: SparkSession, path: str) -> bool:
    """Whether any file at or below the path that Spark's readers would look at has a byte."""
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = top.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(top, True)
    while found.hasNext():
        file = found.next()
        if file.getLen() > 0 and not file.getPath().getName().startswith(("_", ".")):
            return True
    return False


def newest_exports(spark: SparkSession, folders: Mapping[str, str]) -> DataFrame:
    """One row per dataset that has an export."""
    found = {dataset: newest_export(spark, folder, dataset) for dataset, folder in folders.items()}
    return spark.createDataFrame([(dataset, *newest) for dataset, newest in found.items() if newest], NEWEST)


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Size of the files at or below the paths, from the file listing; 0 if one of them is not there."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
