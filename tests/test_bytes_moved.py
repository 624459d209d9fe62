"""What is moved and written grows with the rows, in as few steps as the result needs."""

import glob
import random

from pyspark.sql import functions as F

from checks import queries, rawdata
from lumbung.plans import quality, sales
from lumbung.sources.tables import refresh
from tests.test_plans_at_scale import final_plan


def shuffles(frame):
    """Shuffles by key of the plan that has run."""
    ran = final_plan(frame).split("== Initial Plan ==")[0]
    return [x for x in ran.split("\n") if "Exchange hashpartitioning(" in x]


def lines(spark, sizes):
    dice = random.Random(5)
    rows = [
        (key, dice.choice(["P1", "P2", None]), dice.choice([1, 2, None]), None, None) for key, n in sizes.items() for _ in range(n)
    ]
    return spark.createDataFrame(rows, "l_orderkey long, product_id string, qty int, unit_price decimal(18,2), discount decimal(18,4)")


def test_documents_of_orders_that_fit_equal_those_cut_from_ranges(spark):
    frame = lines(spark, {1: 1, 2: 6, 3: 7, 4: 25, None: 9}).repartition(5)
    found = rawdata.documents_of_orders(frame, 6)
    wanted = rawdata.parts_of_orders(frame.filter("l_orderkey is not null"), 6)
    assert found.schema.simpleString() == wanted.schema.simpleString()
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))


def test_lines_of_orders_that_fit_move_once_and_are_written_once(spark, monkeypatch):
    written = []
    settle = rawdata.settle
    monkeypatch.setattr(rawdata, "settle", lambda frame, label, *more, **named: written.append(label) or settle(frame, label, *more, **named))
    documents = rawdata.documents_of_orders(lines(spark, {1: 3, 2: 4}), 6)
    assert written == ["large_orders"]
    assert len(shuffles(documents)) == 1


def test_unique_test_moves_hashes_only(spark):
    frame = spark.range(1_000).select(F.md5(F.col("id").cast("string")).alias("k"))
    twice = frame.unionByName(frame.limit(3))
    for rows, failures in ((frame, 0), (twice, 3)):
        found = quality.unique_failures({"t": rows}, [quality.UniqueTest("t", "k")])
        assert found.first().failures == failures
        assert not [x for x in shuffles(found) if "(hash" in x]


def test_tables_and_landed_documents_are_compressed(spark, tmp_path):
    refresh(spark.range(10), f"{tmp_path}/t")
    assert glob.glob(f"{tmp_path}/t/*.zstd.parquet")
    root = queries.land(rawdata.Layers(spark, "/root/testdata/sf0.001"))
    found = glob.glob(f"{root}/{queries.C.ORDER_COLLECTION}/*.json*")
    assert found and all(f.endswith(".json.gz") for f in found)


def test_partial_rows_of_a_daily_group_do_not_grow_with_the_tasks(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(500).select(
            *[(F.col("id") % 1).cast("string").alias(c) for c in ("category", "payment_method", "channel")],
            F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 1).cast("int")).alias("order_date"),
            F.col("id").cast("string").alias("order_id"), F.lit("completed").alias("order_status"), F.lit(1).alias("qty"),
            *[F.lit(2).cast("decimal(18,4)").alias(c) for c in ("gross_revenue_idr", "discount_idr", "cogs_idr")],
        )
        daily = sales.fct_daily_sales(rows)
        assert daily.first().total_orders == 500
        first, second = sorted(shuffles(daily), key=lambda x: "_task" not in x)
        assert "_task" in first and "_task" not in second
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_not_null_test_reads_the_staged_orders_that_the_line_items_are_made_from(spark, monkeypatch):
    built = []
    compute = rawdata.Layers.compute_stg_orders
    monkeypatch.setattr(rawdata.Layers, "_written", {})
    monkeypatch.setattr(rawdata.Layers, "compute_stg_orders", lambda self: built.append(1) or compute(self))
    queries.QUERIES["dq_not_null"](spark, "/root/testdata/sf0.001").collect()
    assert len(built) == 1
