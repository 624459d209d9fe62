"""One row per key: the newest version."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_by(frame: DataFrame, key: str | tuple[str, ...], version: str) -> DataFrame:
    """Keep the row with the highest ``version`` for each ``key`` (one column or several).

    All other columns break ties, in the order of the schema, so equal versions
    give the same row on every run. Spark recognises the "row number = 1" shape
    and keeps at most one row per key and task *before* the shuffle, so a key
    that holds a large part of all rows arrives as one row per map task.
    """
    keys = (key,) if isinstance(key, str) else key
    ties = [F.col(c).asc_nulls_last() for c in frame.columns if c not in (*keys, version)]
    newest_first = Window.partitionBy(*keys).orderBy(F.col(version).desc_nulls_first(), *ties)
    return frame.withColumn("_age", F.row_number().over(newest_first)).filter("_age = 1").drop("_age")
