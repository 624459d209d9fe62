"""Share of a group in the total."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.functions.amounts import percent_or_zero


def with_share(groups: DataFrame, value: str, share: str, digits: int = 1) -> DataFrame:
    """Add each group's percentage of the sum over all groups.

    The total is a scalar subquery over the groups, not a window without
    partitions: no task ever holds all groups.
    """
    total = groups.agg(F.sum(value).alias("total")).scalar()
    return groups.withColumn(share, percent_or_zero(F.col(value), total, digits))
