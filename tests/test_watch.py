"""Counts taken while writing equal counts taken from the table, also when tasks are tried again."""

import json
import subprocess
import sys
import textwrap
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lumbung.operators.watch import Watch
from lumbung.plans import quality
from lumbung.sources.tables import refresh

ROOT = Path(__file__).parent.parent


def metrics():
    return {"rows": F.count(F.lit(1)), "odd": F.count(F.when(F.col("id") % 2 == 1, 1)), "total": F.sum("id")}


@pytest.mark.parametrize("order_by", [(), ("id",)])
@pytest.mark.parametrize("rows", [0, 1, 1000])
def test_counts_equal_the_table(spark, tmp_path, order_by, rows):
    watch = Watch(metrics())
    table = refresh(spark.range(rows).repartition(5), str(tmp_path / "t"), *order_by, watch=watch)
    again = table.agg(*[m.alias(n) for n, m in metrics().items()]).first().asDict()
    found = watch.values
    assert {n: found.get(n, 0) or 0 for n in again} == {n: v or 0 for n, v in again.items()}


def test_a_watch_without_a_write(spark):
    with pytest.raises(LookupError):
        Watch(metrics()).values


def test_row_tests_read_no_mart(spark, tmp_path):
    """The outcomes are a local table; the report still reads keys for the uniqueness and parent tests."""
    tests = [t for t in quality.row_tests(date(2026, 9, 10)) if t.table == "fct_daily_sales"]
    watches = quality.row_watches(tests)
    frame = spark.createDataFrame([(None, date(2026, 9, 1)), ("k", None)], "daily_sales_id string, order_date date")
    refresh(frame, str(tmp_path / "daily"), watch=watches["fct_daily_sales"])
    found = quality.written_row_failures(spark, tests, watches)
    assert "Scan parquet" not in found._jdf.queryExecution().executedPlan().toString()
    again = quality.row_failures({"fct_daily_sales": spark.read.parquet(str(tmp_path / "daily"))}, tests)
    assert sorted(found.collect()) == sorted(again.collect())


RETRIED = """
    import json, sys
    from pyspark import TaskContext
    from pyspark.sql import functions as F
    sys.path.insert(0, {root!r})
    from lumbung.operators.watch import Watch
    from lumbung.session import build_session
    from lumbung.sources.tables import refresh

    spark = build_session("retried", "local[2,4]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "3"}})

    def fails_first(batches):
        attempt = TaskContext.get().attemptNumber()
        for i, batch in enumerate(batches):
            yield batch
            if attempt == 0 and i == 2:
                raise RuntimeError("lost after some rows were counted")

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    rows = spark.range(0, 4000, 1, 4).mapInArrow(fails_first, "id long")
    watch = Watch({{"rows": F.count(F.lit(1)), "total": F.sum("id")}})
    table = refresh(rows, sys.argv[1], watch=watch)
    again = table.agg(F.count("*").alias("rows"), F.sum("id").alias("total")).first().asDict()
    print(json.dumps([watch.values, again]))
"""


def test_retried_tasks_count_once(tmp_path):
    code = textwrap.dedent(RETRIED.format(root=str(ROOT)))
    done = subprocess.run([sys.executable, "-c", code, str(tmp_path / "t")], capture_output=True, text=True, timeout=300)
    found, again = json.loads(done.stdout.strip().splitlines()[-1])
    assert "lost after some rows" in done.stderr
    assert found == again == {"rows": 4000, "total": 7998000}
