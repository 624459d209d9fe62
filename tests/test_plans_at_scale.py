"""Plan properties that matter on large data, checked on small data with thresholds turned down."""

import json

import pytest
from pyspark.sql import functions as F

from lumbung.plans import customers, line_items, products, quality, reports, sales, staging
from lumbung.schemas import MONEY
from lumbung.session import size_shuffles
from lumbung.sources.tables import settle

HOT = 30_000


def final_plan(frame):
    frame.write.mode("overwrite").format("noop").save()
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """As on data that is too large to broadcast, with small partitions counting as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture(scope="module")
def orders(spark):
    """Clean orders; one customer and one product hold a third of everything."""
    hot = F.col("id") % 3 == 0
    item = F.struct(
        F.when(hot, "P0").otherwise(F.concat(F.lit("P"), (F.col("id") % 500).cast("string"))).alias("product_id"),
        F.lit(1).alias("qty"), F.lit(100).alias("unit_price"),
    )
    frame = spark.range(0, HOT, 1, 6).select(
        F.concat(F.lit("O"), F.col("id").cast("string")).alias("order_id"),
        F.when(hot, "C0").otherwise(F.concat(F.lit("C"), (F.col("id") % 700).cast("string"))).alias("customer_id"),
        F.lit("2026-09-03 00:00:00").cast("timestamp").alias("ordered_at"),
        F.lit("2026-09-03").cast("date").alias("order_date"),
        F.lit("completed").alias("order_status"),
        F.lit("cod").alias("payment_method"),
        F.lit("website").alias("channel"),
        F.to_json(F.array(item)).alias("items_jsonb"),
    )
    return settle(frame, "orders")


@pytest.fixture(scope="module")
def catalogue(spark):
    ids = spark.range(0, 400).select(F.concat(F.lit("P"), F.col("id").cast("string")).alias("product_id"))
    return settle(
        ids.select(
            "product_id", F.lit("n").alias("product_name"), F.lit("c").alias("category"),
            F.lit(100).cast(MONEY).alias("price_idr"), F.lit(60).cast(MONEY).alias("cost_idr"),
        ),
        "catalogue",
    )


@pytest.fixture(scope="module")
def people(spark):
    return settle(spark.range(0, 600).select(F.concat(F.lit("C"), F.col("id").cast("string")).alias("customer_id")), "people")


def test_hot_keys_are_split_in_both_lookups(no_broadcast, orders, catalogue, people):
    plan = final_plan(line_items.line_item_layer(orders, catalogue, people))
    final = plan[: plan.index("Initial Plan")]
    assert final.count("SortMergeJoin(skew=true)") == 2


def test_lookups_are_broadcast_when_measured_small(orders, catalogue, people):
    plan = line_items.line_item_layer(orders, catalogue, people)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2


def test_both_lookup_strategies_agree(spark, no_broadcast, orders, catalogue, people):
    shuffled = settle(line_items.line_item_layer(orders, catalogue, people), "shuffled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    small = line_items.line_item_layer(orders, catalogue, people)
    assert shuffled.count() == HOT
    assert shuffled.exceptAll(small).count() == 0


@pytest.fixture(scope="module")
def layer(orders, catalogue, people):
    return settle(line_items.line_item_layer(orders, catalogue, people), "line_items")


def scanned(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return plan, plan[plan.index("ReadSchema") :].splitlines()[0]


def test_marts_read_only_their_columns(layer):
    _, columns = scanned(customers.int_customer_metrics(layer))
    assert "product_name" not in columns and "order_item_id" not in columns
    plan, columns = scanned(products.product_sales_metrics(layer))
    assert "customer_id" not in columns and "EqualTo(order_status,completed)" in plan


def test_report_filters_reach_the_scan(layer):
    daily = settle(sales.fct_daily_sales(layer), "daily")
    plan, columns = scanned(reports.daily_trend(daily, category="c", channel="website"))
    assert "EqualTo(category,c)" in plan and "EqualTo(channel,website)" in plan
    assert "total_cogs_idr" not in columns


def test_row_tests_share_one_scan(layer):
    fact = settle(sales.fact_order_items(layer), "fact")
    tests = [t for t in quality.not_null_tests() if t.table == "fact_order_items"] + [quality.negative_revenue_test()]
    plan, columns = scanned(quality.row_failures({"fact_order_items": fact}, tests))
    assert plan.count("FileScan") == 1 and "payment_method" not in columns


def test_parent_test_counts_keys_before_the_join(no_broadcast, layer, people):
    fact = sales.fact_order_items(layer)
    tests = [quality.ParentTest("f", "customer_id", "p", "customer_id")]
    frame = quality.parent_failures({"f": fact, "p": people}, tests)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    join = plan.index("LeftAnti")
    assert "HashAggregate(keys=[key" in plan[join:] or "HashAggregate(keys=[customer_id" in plan[join:]
    assert frame.first().failures == fact.filter("customer_id = 'UNKNOWN'").count()


@pytest.fixture(scope="module")
def raw_in_parts(spark):
    """Raw orders as a run writes them: whole documents, and one order in parts, 300 in an old and 120 in a new load."""

    def documents(load, day, parts, lines):
        items = F.to_json(F.array(F.struct(F.lit("P1").alias("product_id"), F.lit(1).alias("qty"))))
        whole = spark.range(0, 2_000).select(
            F.concat(F.lit("O"), F.col("id").cast("string")).alias("order_id"), F.lit(None).cast("int").alias("part")
        )
        cut = spark.range(0, parts).select(F.lit(" BIG").alias("order_id"), F.col("id").cast("int").alias("part"))
        return whole.unionByName(cut).select(
            "order_id", F.lit("C1").alias("customer_id"), F.lit("2026-09-03T10:00:00+00:00").alias("order_date"),
            F.lit("completed").alias("status"), F.lit("cod").alias("payment_method"), F.lit("website").alias("channel"),
            F.lit("0").alias("total_amount"), items.alias("items"), "part", (F.col("part") * lines).cast("long").alias("lines_before"),
            F.lit(None).cast("string").alias("product_before"), F.lit(load).alias("_source_system"),
            F.lit(f"2026-09-{day} 00:00:00").cast("timestamp").alias("_loaded_at"),
        )

    return settle(documents("a", "03", 300, 1).unionByName(documents("b", "04", 120, 1)).repartition(4), "raw_in_parts")


def operators(frame):
    """Every operator of the plan before anything ran, with its arguments."""
    query = frame._jdf.queryExecution()
    return frame.sparkSession._jvm.PythonSQLUtils.explainString(query, "formatted").strip().split("\n\n")


def test_newest_orders_read_and_shuffle_items_once(no_broadcast, raw_in_parts):
    frame = staging.stg_orders(raw_in_parts)
    scans = [o for o in operators(frame) if "ReadSchema" in o]
    with_items = [o for o in scans if "items:string" in o]
    # Disjoint filters, and both reach the scan; the other scans read no items.
    assert sum("Or(IsNull(part),EqualTo(part,0))" in o for o in with_items) == 1
    assert sum("GreaterThan(part,0)" in o for o in with_items) == 1 and len(with_items) == 2 and len(scans) == 4
    moved = [o for o in operators(frame) if "Exchange" in o.strip().split("\n")[0] and "items" in o]
    assert sorted(o[o.index("hashpartitioning") :].count("#") for o in moved) == [1, 2, 2]  # first parts once, by order alone
    rows = frame.groupBy("order_id", "_loaded_at").count().filter("order_id = 'BIG'").collect()
    assert [(str(r["_loaded_at"])[:10], r["count"]) for r in rows] == [("2026-09-04", 120)]
    assert frame.count() == 2_120


def test_without_parts_items_are_read_once(spark, raw_in_parts):
    """The scan for further parts skips every row group."""
    whole = settle(raw_in_parts.filter("part IS NULL"), "raw_whole")
    frame = staging.stg_orders(whole)
    frame.collect()
    nodes, rows = [frame._jdf.queryExecution().executedPlan().executedPlan()], []
    while nodes:
        node = nodes.pop()
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            nodes.append(node.plan())
            continue
        if "items" in node.output().mkString(",") and node.nodeName().startswith("Scan parquet"):
            rows.append(node.metrics().apply("numOutputRows").value())
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    assert sum(rows) == whole.count()


def test_no_cross_joins_or_global_windows(layer, people):
    fact = sales.fact_order_items(layer)
    daily = sales.fct_daily_sales(layer)
    for frame in (reports.guest_audit(fact), reports.channel_share(daily), reports.category_share(daily)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "Window" not in plan


def test_exact_order_counts_need_no_distinct(layer):
    counts = reports.kpi_exact_orders(sales.fact_order_items(layer))
    assert counts._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1  # the final single row
    assert counts.first().total_orders == HOT


@pytest.mark.parametrize(("size", "partitions"), [(10**6, None), (10**12, "3726"), (10**14, "372530"), (10**15, "3725291")])
def test_shuffle_partitions_follow_the_input(spark, size, partitions):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    spark.conf.unset(key)
    size_shuffles(spark, size)
    assert spark.conf.get(key, None) == partitions
    size_shuffles(spark, 10**6)
    assert spark.conf.get(key, None) is None


def test_one_large_document(orders, catalogue, people):
    """A document is one row; its lines are numbered in that row."""
    lines = json.dumps([{"product_id": f"P{i % 7}", "qty": 1, "unit_price": 1} for i in range(20_000)])
    big = orders.limit(1).withColumn("items_jsonb", F.lit(lines))
    frame = sales.fact_order_items(line_items.line_item_layer(big, catalogue, people))
    row = frame.agg(F.count("*").alias("n"), F.count_distinct("order_item_id").alias("k")).first()
    assert (row.n, row.k) == (20_000, 20_000)
