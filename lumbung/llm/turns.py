"""Turns of conversations in order, numbered without any task holding a whole conversation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumbung.llm.tables import checkpointed


def in_order(turns: DataFrame, *order: Column) -> DataFrame:
    """Adds ``part`` and ``at``: rows of a conversation (``conv_id``) lie in parts, and ``at`` rises in their order.

    Rows are sorted over the cluster by conversation and ``order``, so a conversation of very many rows is spread
    over parts. ``at`` is the place in the sorted whole: the part, then the row in it. The sorted rows are written
    to the shared folder, so that a lost executor doesn't cut them anew. Equal rows stay together and are read one
    after the other, never held.
    """
    order = (F.col("conv_id"), *order)
    ranged = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = checkpointed(ranged.withColumn("at", F.monotonically_increasing_id()))
    return placed.withColumn("part", F.shiftright("at", 33).cast("int"))  # Spark keeps the partition in these bits


def parts_of(placed: DataFrame) -> DataFrame:
    """One row per conversation and part: its ``first`` place and its number of rows, ``n``."""
    return placed.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))


def before(agg, name: str) -> Column:
    """``agg`` of a column over the earlier parts of a conversation; null in its first part."""
    return agg(name).over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
