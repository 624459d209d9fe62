"""Shards by jump consistent hashing.

The shard follows from a stable key and the number of shards alone: no table of
ranges, and one more shard takes only its own share of rows, from all others
alike. Rows then get gapless numbers within their shard without any task seeing
a whole shard: a shard is cut into parts by hash, parts are numbered side by
side and start where the rows of earlier parts end.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbung.llm.tables import ids_and_texts

SHARDS = 8
ROWS_PER_STRETCH = 10_000  # equal rows that are numbered together
# Fixed value: the multiplier of the published generator.
MULTIPLIER = np.uint64(2862933555777941757)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key: follow the key's jumps until one passes the last shard."""
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), np.int64)
    going = np.arange(len(state))
    while len(going):
        state[going] = state[going] * MULTIPLIER + np.uint64(1)
        step = (1 << 31) / ((state[going] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        landed = np.floor((shard[going] + 1) * step)
        inside = landed < shards
        going = going[inside]
        shard[going] = landed[inside].astype(np.int64)
    return shard


def shard_of(key: str | Column, shards: int) -> Column:
    """0 to ``shards`` - 1 for a column of stable 64-bit keys."""

    @F.arrow_udf(T.IntegerType())
    def place(keys: pa.Array) -> pa.Array:
        numbers = keys.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        return pa.array(jump(numbers, shards).astype(np.int32))

    return place(key)


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document with its shard, its number there, and its shard if there were one more.

    The key is a hash of doc_id; all rows with a null id share one shard. Null texts have size 1 and the
    checksum of nothing. Repeated rows get one number each. No rows, no shards.
    """
    key = F.xxhash64("doc_id")
    rows = ids_and_texts(docs).select(
        "doc_id",
        (F.octet_length("text") + 1).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
    )
    # Equal rows are numbered as one row with a count, so that many of them are no large group.
    counted = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies"))
    # Parts and rows per part both grow with the square root of the number of rows.
    parts = max(1, math.isqrt(docs.count() // shards))
    placed = counted.withColumns(
        {
            "shard": shard_of(key, shards),
            "grown_shard": shard_of(key, shards + 1),
            "part": F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(parts)),
        }
    )
    in_part = Window.partitionBy("shard", "part").orderBy("doc_id", "size", "text_crc32")
    numbered = placed.withColumn("last", F.sum("copies").over(in_part))
    totals = placed.groupBy("shard", "part").agg(F.sum("copies").alias("total"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("shard", "part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("start"))
    first = F.col("start") + F.col("last") - F.col("copies")
    placed = numbered.join(starts, ["shard", "part"]).withColumns({"first": first, "end": first + F.col("copies")})
    # Equal rows get their numbers in stretches, which are dealt anew, so that no task or array has all of them.
    stretches = F.sequence("first", F.col("end") - 1, F.lit(ROWS_PER_STRETCH).cast("long"))
    dealt = placed.withColumn("from", F.explode(stretches)).repartition("shard", "from")
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        F.explode(F.sequence("from", F.least(F.col("from") + ROWS_PER_STRETCH, "end") - 1)).alias("slot"),
        "grown_shard",
    )
