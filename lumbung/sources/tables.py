"""Parquet tables: full refresh, intermediate results, publication of finished runs."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.operators.watch import Watch
from lumbung.session import fresh_folder


def refresh(frame: DataFrame, path: str, *order_by: str, watch: Watch | None = None) -> DataFrame:
    """Replace the table at ``path`` and read it back; ``watch`` has its aggregates afterwards.

    ``order_by`` sorts the rows by range over files, so that later filters on
    the first column skip files and row groups by their statistics; further
    columns split values that many rows share. Compared with one folder per
    value this leaves no tiny files and no oversized ones. Files are compressed
    by zstd, whatever the session says: keys made by MD5 take half the space.
    """
    if order_by:
        frame = frame.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    (watch.on(frame) if watch else frame).write.mode("overwrite").option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def together(spark: SparkSession, jobs: Mapping[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Run independent writes side by side, so that one job's last tasks do not leave the cluster idle."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(job)) for name, job in jobs.items()}
        return {name: job.result() for name, job in running.items()}


def settle(frame: DataFrame, label: str, folder: str | None = None, watch: Watch | None = None) -> DataFrame:
    """Write an intermediate result once and continue from there: below ``folder``, or in the shared folder.

    Several consumers then share the work, and a lost executor costs a re-read, not a recomputation.
    """
    return refresh(frame, f"{folder}/{label}" if folder else fresh_folder(frame.sparkSession, label), watch=watch)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of tables that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


PUBLICATIONS, FAILURES = "publications", "failures"


def add_to_log(spark: SparkSession, log: str, run_id: str, finished_at: str) -> None:
    entry = spark.range(1).select(
        F.lit(run_id).alias("run_id"), F.lit(finished_at).cast("timestamp").alias("finished_at")
    )
    entry.write.mode("append").parquet(log)


def read_log(spark: SparkSession, log: str) -> DataFrame:
    try:
        return spark.read.schema("run_id string, finished_at timestamp").parquet(log)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "run_id string, finished_at timestamp")


def publish(spark: SparkSession, warehouse: str, run_id: str, finished_at: str) -> None:
    """Make a finished run the current one by adding one row to the publication log."""
    add_to_log(spark, f"{warehouse}/{PUBLICATIONS}", run_id, finished_at)


def log_failure(spark: SparkSession, warehouse: str, run_id: str, finished_at: str) -> None:
    """Note that a run has ended without publication."""
    add_to_log(spark, f"{warehouse}/{FAILURES}", run_id, finished_at)


def current_run(spark: SparkSession, warehouse: str) -> str | None:
    log = read_log(spark, f"{warehouse}/{PUBLICATIONS}")
    return log.agg(F.max_by("run_id", F.struct("finished_at", "run_id"))).first()[0]


def superseded(spark: SparkSession, warehouse: str, keep: int) -> list[str]:
    """Ended runs older than the ``keep`` newest published ones, out of those whose folders are still there.

    A run that is in neither log is still being written, and stays. So does a failed run that is newer than the
    oldest published one that stays. Folders and logs have one entry per run.
    """
    if keep < 1:
        raise ValueError("the current run has to stay")
    newest_first = F.struct("finished_at", "run_id")
    published = read_log(spark, f"{warehouse}/{PUBLICATIONS}").orderBy(newest_first.desc()).limit(keep).collect()
    if len(published) < keep:
        return []
    oldest = published[-1]
    ended = [read_log(spark, f"{warehouse}/{log}") for log in (PUBLICATIONS, FAILURES)]
    border = F.struct(F.lit(oldest["finished_at"]).alias("finished_at"), F.lit(oldest["run_id"]).alias("run_id"))
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{warehouse}/runs")
    there = {f.getPath().getName() for f in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)}
    older = ended[0].unionByName(ended[1]).filter(newest_first < border)
    return sorted(row["run_id"] for row in older.collect() if row["run_id"] in there)


def retire(spark: SparkSession, warehouse: str, keep: int) -> list[str]:
    """Remove the folders of superseded runs; whoever reads the current run is not disturbed."""
    gone = superseded(spark, warehouse, keep)
    for run_id in gone:
        # The folder goes last: while it is there, a removal that was interrupted is taken up again.
        for path in (*[table_path(warehouse, run_id, name) for name in MARTS], run_folder(warehouse, run_id)):
            remove(spark, path)
    return gone


def run_folder(warehouse: str, run_id: str) -> str:
    return f"{warehouse}/runs/{run_id}"


MARTS = ("dim_customers", "dim_products", "fact_order_items", "fct_daily_sales")


def table_path(warehouse: str, run_id: str, name: str) -> str:
    """Where a run's table lies: a mart is a partition of one table for all runs, the rest is in the run's folder."""
    return f"{warehouse}/marts/{name}/run_id={run_id}" if name in MARTS else f"{run_folder(warehouse, run_id)}/{name}"


def name_marts(spark: SparkSession, warehouse: str, prefix: str = "") -> None:
    """Views by which SQL users read the marts of the current run.

    They look the run up in the publication log and read its partition only, so they are made once, and the one
    row that publishes a run moves all of them together. The warehouse needs a published run.
    """
    for name in MARTS:
        spark.sql(f"""
            CREATE OR REPLACE VIEW {prefix}{name} AS SELECT * EXCEPT (run_id) FROM parquet.`{warehouse}/marts/{name}`
            WHERE run_id = (SELECT max_by(run_id, struct(finished_at, run_id)) FROM parquet.`{warehouse}/{PUBLICATIONS}`)
        """)


def read_published(spark: SparkSession, warehouse: str, name: str) -> DataFrame:
    run_id = current_run(spark, warehouse)
    if run_id is None:
        raise LookupError(f"nothing has been published in {warehouse}")
    return spark.read.parquet(table_path(warehouse, run_id, name))
