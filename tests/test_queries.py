"""Every registered query against its expected result, and the test-table adapter."""

import json

import pytest
from pyspark.sql import functions as F

from checks.compare import connect, difference
from checks.oracle import ORACLE
from checks.queries import QUERIES
from checks.rawdata import Layers, raw_lines, raw_orders

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_query_has_an_expected_result():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    assert difference(spark, db, name, FOLDER) == ""


def test_entry(spark):
    from __spark_entry__ import entry

    assert entry(spark).count() > 0


@pytest.mark.parametrize("limit", [2, 3])
@pytest.mark.parametrize(
    "name", ["kpi_exact_orders", "int_customer_metrics", "dim_products", "fct_daily_sales", "int_order_items", "unnest_order_items"]
)
def test_results_do_not_depend_on_the_size_of_documents(spark, db, monkeypatch, name, limit):
    monkeypatch.setattr(Layers, "document_items", limit)
    assert difference(spark, db, name, FOLDER) == ""


def test_large_orders_come_in_parts(spark):
    """No line is lost, no document exceeds the limit, ids stay."""
    whole, parts = raw_orders(spark, FOLDER), raw_orders(spark, FOLDER, document_items=2)
    sizes = parts.select(F.json_array_length("items").alias("n"))
    assert whole.select(F.sum(F.json_array_length("items"))).first()[0] == sizes.select(F.sum("n")).first()[0]
    assert parts.count() > whole.count() and sizes.filter("n > 2").count() == 0
    assert parts.select("order_id").distinct().count() == whole.select("order_id").distinct().count()
    assert whole.filter("part > 0").count() == 0


def test_hot_order_is_split(spark, tmp_path):
    """A third of all lines in one order end up in many documents, numbered without gaps."""
    for table in ("orders", "lineitem"):
        frame = spark.read.parquet(f"{FOLDER}/{table}.parquet")
        if table == "lineitem":
            hot = frame.select(*[F.lit(7).cast("long").alias(c) if c == "l_orderkey" else F.col(c) for c in frame.columns])
            frame = frame.unionByName(hot.limit(frame.count() // 2))
        frame.write.parquet(f"{tmp_path}/{table}.parquet")
    documents = raw_orders(spark, str(tmp_path), document_items=100)
    pieces = documents.filter("order_id = 'ORD0000007' AND month(_loaded_at) = 12")
    parts = sorted((d["part"], d["lines_before"], len(json.loads(d["items"]))) for d in pieces.collect())
    assert len(parts) >= 30 and max(n for *_, n in parts) <= 100
    assert [p for p, *_ in parts] == list(range(len(parts)))
    assert [b for _, b, _ in parts] == [sum(n for *_, n in parts[:i]) for i in range(len(parts))]
    documents = documents.select("order_id", "items", "_loaded_at").collect()
    keys = spark.read.parquet(f"{tmp_path}/orders.parquet").select(F.col("o_orderkey").alias("l_orderkey"))
    lines = raw_lines(spark, str(tmp_path)).join(keys, "l_orderkey").count()
    newest = [d for d in documents if d["_loaded_at"].month == 12]
    assert sum(len(json.loads(d["items"])) for d in newest) == lines


@pytest.mark.parametrize(
    "name",
    [
        "stg_orders", "ingest_orders_json", "raw_provenance", "raw_full_refresh", "order_dates", "hygiene_flags", "dq_not_null",
        "dq_unique", "dq_orphan_rows", "dq_raw_counts", "dq_document_violations", "dq_accepted_values", "dq_relationships",
    ],
)
def test_documents_count_once_however_many_parts(spark, db, monkeypatch, name):
    monkeypatch.setattr(Layers, "document_items", 2)
    assert difference(spark, db, name, FOLDER) == ""


def test_ranges_do_not_cut_orders(spark):
    """Orders below the limit stay whole with many range partitions."""
    before = {key: spark.conf.get(key) for key in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "50")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        ranges = raw_lines(spark, FOLDER).repartitionByRange("l_orderkey", "product_id", "qty", "unit_price", "discount")
        assert ranges.select(F.spark_partition_id().alias("p")).distinct().count() > 10
        assert raw_orders(spark, FOLDER).filter("part > 0").count() == 0
        parts = raw_orders(spark, FOLDER, document_items=3).filter("month(_loaded_at) = 12").collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    sizes = {}
    for row in parts:
        sizes.setdefault(row["order_id"], {})[row["part"]] = len(json.loads(row["items"]))
    for found in sizes.values():
        assert sorted(found) == list(range(len(found))) and all(found[p] == 3 for p in range(len(found) - 1))
