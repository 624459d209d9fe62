"""Session settings and the shared working folder."""

from __future__ import annotations

import functools
import math
import tempfile
import uuid

from pyspark.sql import SparkSession

# What every plan of this package relies on, whoever built the session.
SEMANTICS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Run-time re-planning: coalesce small partitions, split skewed ones, broadcast by measured size.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}

# A partition of this much input sorts in an executor's memory or with a little spill.
INPUT_BYTES_PER_SHUFFLE_PARTITION = 256 * 1024**2
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def build_session(app: str = "lumbung", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SEMANTICS, **ADAPTIVE, **extra}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings that results depend on in a session built elsewhere."""
    for key, value in SEMANTICS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def size_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Give shuffles enough partitions for the size of the input.

    Adaptive execution merges partitions that turn out small but does not split
    ordinary ones, so the starting number has to follow the data, without a
    ceiling. Small inputs keep the session's own setting, also after large ones.
    """
    wanted = math.ceil(input_bytes / INPUT_BYTES_PER_SHUFFLE_PARTITION)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(INITIAL_PARTITIONS, str(wanted))
    else:
        spark.conf.unset(INITIAL_PARTITIONS)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as named by the cluster in ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a fresh temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return local_folder()


@functools.cache
def local_folder() -> str:
    return tempfile.mkdtemp(prefix="lumbung-")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; no two calls get the same one."""
    return f"{shared_folder(spark)}/lumbung/{label}-{uuid.uuid4().hex}"
