"""Every query of the engine over one folder of test tables.

Each entry takes ``(spark, folder)`` and works on whole tables. Amounts leave
the engine as doubles, as the last step.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.rawdata import AS_OF, LOADED_AT, Layers, raw_order_heads, first_parts, with_item_counts
from lumbung import constants as C
from lumbung.functions.amounts import at_least, count_where, decimals_to_double, percent, sum_where
from lumbung.functions.text import has_email_format, lowered, raised, trimmed
from lumbung.operators.unnest import explode_items
from lumbung.plans import customers, line_items, products, quality, reports, sales, staging
from lumbung.session import fresh_folder
from lumbung.sources import exports, landing, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the filtered reports.
CATEGORY = "ECONOMY"
CHANNEL = "website"
SEARCH_TERM = "EcO"
# In names only, and in SKUs only.
NAME_TERM = "WIDget"
SKU_TERM = "-77"


def query(build: Callable[[Layers], DataFrame]) -> Callable[[Layers], DataFrame]:
    @functools.wraps(build)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return decimals_to_double(build(Layers(spark, folder)))

    QUERIES[build.__name__] = run
    return build


# ---------------------------------------------------------------- sources and sinks


def land(layers: Layers) -> str:
    """Write the raw tables as a landing area: two customer exports, one of products, order documents."""
    root = fresh_folder(layers.spark, "landing")
    text = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    provenance = ("_source_file", "_loaded_at")
    for dataset, frame, names in (
        (C.CUSTOMER_EXPORT, layers.raw_customers, ("customers_20261130.csv", "customers_20261201.csv")),
        (C.PRODUCT_EXPORT, layers.raw_products, ("products_20261201.csv",)),
    ):
        for name in names:
            rows = frame.filter(F.col("_source_file") == name).drop(*provenance)
            rows.write.options(**text).csv(f"{root}/{dataset}/{name}")
    layers.raw_orders.drop("_source_system", "_loaded_at").write.option("compression", "gzip").json(f"{root}/{C.ORDER_COLLECTION}")
    return root


def newest_names(layers: Layers, root: str) -> DataFrame:
    return landing.newest_exports(layers.spark, {d: f"{root}/{d}" for d in (C.CUSTOMER_EXPORT, C.PRODUCT_EXPORT)})


def read_landed(layers: Layers) -> dict[str, DataFrame]:
    root = land(layers)
    newest = {r["dataset"]: r["export_name"] for r in newest_names(layers, root).collect()}
    spark = layers.spark
    return {
        "customers": exports.read_customers(
            spark, f"{root}/{C.CUSTOMER_EXPORT}", newest[C.CUSTOMER_EXPORT], LOADED_AT
        ),
        "products": exports.read_products(spark, f"{root}/{C.PRODUCT_EXPORT}", newest[C.PRODUCT_EXPORT], LOADED_AT),
        "orders": exports.read_orders(spark, f"{root}/{C.ORDER_COLLECTION}", LOADED_AT),
    }


@query
def ingest_customers_csv(x: Layers) -> DataFrame:
    return read_landed(x)["customers"].drop(exports.ROW_SHAPE)


@query
def ingest_products_csv(x: Layers) -> DataFrame:
    return read_landed(x)["products"].drop(exports.ROW_SHAPE)


@query
def ingest_ragged_rows(x: Layers) -> DataFrame:
    """Customers as an export in which every seventh row lacks its last two values and every eleventh has one more."""
    root = fresh_folder(x.spark, "ragged")
    number = F.substring("customer_id", 5, 20).cast("long")
    quoted = [F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')) for c in map(F.col, C.CUSTOMER_FIELDS)]
    line = F.when(number % 7 == 0, F.concat_ws(",", *quoted[:-2])).when(number % 11 == 0, F.concat_ws(",", *quoted, F.lit("more")))
    lines = x.raw_customers.filter("_source_file = 'customers_20261201.csv'").select(line.otherwise(F.concat_ws(",", *quoted)).alias("value"))
    header = x.spark.createDataFrame([(0, ",".join(C.CUSTOMER_FIELDS))], "place int, value string")
    parts = header.crossJoin(F.broadcast(x.spark.range(2).withColumnRenamed("id", "part")))
    dealt = lines.select(F.lit(1).alias("place"), "value", F.pmod(F.xxhash64("value"), F.lit(2)).alias("part"))
    whole = parts.unionByName(dealt).repartition(2, "part").sortWithinPartitions("part", "place")
    whole.select("part", "value").write.partitionBy("part").text(f"{root}/written")
    read = [exports.read_customers(x.spark, f"{root}/written", f"part={part}", LOADED_AT) for part in (0, 1)]
    return quality.stack(read).select(*C.CUSTOMER_FIELDS, exports.ROW_SHAPE)


@query
def landing_empty_newest(x: Layers) -> DataFrame:
    """A day later the customers' export is there without a byte."""
    root = land(x)
    x.spark.range(1).select(F.lit("").alias("value")).limit(0).write.text(f"{root}/{C.CUSTOMER_EXPORT}/customers_20261202.csv")
    return newest_names(x, root)


@query
def run_retention(x: Layers) -> DataFrame:
    """Four published runs and a failed one, of which the two newest published ones stay."""
    warehouse = fresh_folder(x.spark, "warehouse")
    for day in (1, 2, 3, 4, 5):
        tables.refresh(x.daily, tables.table_path(warehouse, f"run-{day}", "fct_daily_sales"))
        tables.refresh(x.daily.limit(0), f"{tables.run_folder(warehouse, f'run-{day}')}/dq_report")
        log = tables.log_failure if day == 2 else tables.publish
        log(x.spark, warehouse, f"run-{day}", f"2026-12-0{day}T00:00:00")
    tables.retire(x.spark, warehouse, 2)
    left = x.spark.read.parquet(f"{warehouse}/marts/fct_daily_sales")
    is_current = F.col("run_id") == tables.current_run(x.spark, warehouse)
    return left.groupBy("run_id").agg(F.count("*").alias("n_rows")).withColumn("is_current", is_current)


@query
def ingest_orders_json(x: Layers) -> DataFrame:
    # Landed loads of an order have the same id and time; parts repeat the other fields of their document.
    head = ("customer_id", "order_date", "status", "payment_method", "channel", "total_amount")
    orders = with_item_counts(tables.settle(read_landed(x)["orders"], "landed_orders"), "items", *head)
    return orders.select(
        "order_id", "customer_id", "order_date", "status", "payment_method", "channel", "total_amount",
        F.col("items").alias("n_items"), "items_checksum", "_source_system", "_loaded_at",
    )


@query
def raw_provenance(x: Layers) -> DataFrame:
    raw = read_landed(x)
    origins = [
        raw["customers"].select(F.lit("customers").alias("raw_table"), F.col("_source_file").alias("origin"), "_loaded_at"),
        raw["products"].select(F.lit("products").alias("raw_table"), F.col("_source_file").alias("origin"), "_loaded_at"),
        first_parts(raw["orders"]).select(F.lit("orders").alias("raw_table"), F.col("_source_system").alias("origin"), "_loaded_at"),
    ]
    return quality.stack(origins).groupBy("raw_table", "origin", "_loaded_at").agg(F.count("*").alias("n_rows"))


@query
def raw_full_refresh(x: Layers) -> DataFrame:
    """Loading twice leaves one load behind."""
    raw = read_landed(x)
    warehouse = fresh_folder(x.spark, "raw")
    loaded = {}
    for name in raw:
        tables.refresh(raw[name], f"{warehouse}/{name}")
        loaded[name] = tables.refresh(raw[name], f"{warehouse}/{name}")
    loaded["orders"] = first_parts(loaded["orders"])
    return quality.raw_counts(loaded).select("target", F.col("rows").alias("n_rows"))


@query
def landing_latest_file(x: Layers) -> DataFrame:
    return newest_names(x, land(x)).select("dataset", "export_name")


@query
def landing_file_validity(x: Layers) -> DataFrame:
    return newest_names(x, land(x))


@query
def mart_roundtrip(x: Layers) -> DataFrame:
    """Marts of two runs, the second one published last, read by name."""
    warehouse = fresh_folder(x.spark, "warehouse")
    for run_id, share in (("run-1", 0.0), ("run-2", 1.0)):
        for name, mart in {**x.marts, "fct_daily_sales": x.compute_daily()}.items():
            tables.refresh(mart.filter(F.lit(share) > 0), tables.table_path(warehouse, run_id, name))
        tables.publish(x.spark, warehouse, run_id, f"2026-12-01T0{run_id[-1]}:00:00")
    prefix = f"checked_{uuid.uuid4().hex}_"
    tables.name_marts(x.spark, warehouse, prefix)
    return x.spark.table(f"{prefix}fct_daily_sales")


@query
def export_marts_json(x: Layers) -> DataFrame:
    """All sections written as JSON and read back: records, and revenue of those that have any."""
    root = fresh_folder(x.spark, "export")
    report = tables.refresh(quality.mart_report(x.marts, AS_OF), f"{root}/dq_report")
    written = reports.export_json(x.marts, report, root, LOADED_AT)
    revenue = {
        "daily_sales": "gross_revenue_idr",
        "products": "total_revenue_generated_idr",
        "customer_tiers": "total_gross_spend",
        "kimball_audit": "total_revenue",
        "summary": "total_gross_revenue",
    }
    return quality.stack(
        [
            x.spark.read.schema(schema).json(f"{root}/{section}").agg(
                F.count("*").alias("records"),
                F.sum(F.col(revenue[section]) if section in revenue else F.lit(None)).cast("decimal(28,4)").alias("revenue"),
            ).select(F.lit(section).alias("section"), "records", "revenue")
            for section, schema in written.items()
        ]
    )


# ---------------------------------------------------------------- staging pieces


@query
def dedup_latest_customers(x: Layers) -> DataFrame:
    return staging.newest(x.raw_customers, "customer_id").select("customer_id", "full_name", "_source_file", "_loaded_at")


@query
def dedup_latest_products(x: Layers) -> DataFrame:
    return staging.newest(x.raw_products, "product_id").select("product_id", "sku", "_source_file", "_loaded_at")


@query
def dedup_latest_orders(x: Layers) -> DataFrame:
    return staging.newest_orders(x.raw_orders).filter("part = 0").select("order_id", "customer_id", "status", "order_date", "_loaded_at")


@query
def hygiene_strings(x: Layers) -> DataFrame:
    return x.raw_customers.select(
        "customer_id", "_source_file",
        trimmed("full_name").alias("full_name"),
        lowered("segment").alias("customer_segment"),
        raised("gender").alias("gender"),
        F.length(trimmed("full_name")).alias("name_length"),
    )


@query
def email_validation(x: Layers) -> DataFrame:
    return x.raw_customers.select(
        "customer_id", "_source_file",
        trimmed("email").alias("raw_email"),
        has_email_format("email").alias("is_valid_email"),
        F.when(has_email_format("email"), lowered("email")).alias("email"),
    )


@query
def stock_clamp(x: Layers) -> DataFrame:
    stock = F.col("stock_qty").cast("int")
    return x.raw_products.select("product_id", stock.alias("raw_stock_qty"), at_least(stock, 0).alias("stock_qty"))


@query
def typed_casts(x: Layers) -> DataFrame:
    return x.stg_products.select("product_id", "price_idr", "cost_idr", "weight_gram", "is_active", "raw_stock_qty")


@query
def order_dates(x: Layers) -> DataFrame:
    return first_parts(x.stg_orders).select("order_id", "ordered_at", "order_date")


@query
def hygiene_flags(x: Layers) -> DataFrame:
    flags = [
        x.stg_customers.select(F.lit("valid_email").alias("flag"), F.col("is_valid_email").alias("value")),
        x.stg_products.select(F.lit("valid_pricing").alias("flag"), F.col("is_valid_pricing").alias("value")),
        first_parts(x.stg_orders).select(F.lit("status_present").alias("flag"), F.col("is_status_present").alias("value")),
        x.line_items.select(F.lit("registered_customer").alias("flag"), F.col("is_registered_customer").alias("value")),
    ]
    return quality.stack(flags).groupBy("flag", "value").agg(F.count("*").alias("n_rows"))


# ---------------------------------------------------------------- models


@query
def stg_customers(x: Layers) -> DataFrame:
    return x.compute_stg_customers()


@query
def stg_products(x: Layers) -> DataFrame:
    return x.compute_stg_products()


@query
def stg_orders(x: Layers) -> DataFrame:
    return with_item_counts(x.stg_orders, "items_jsonb").withColumnRenamed("items_jsonb", "n_items").drop(*C.PART_FIELDS)


@query
def unnest_order_items(x: Layers) -> DataFrame:
    lines = explode_items(x.stg_orders.select("order_id", "order_status", "items_jsonb", *C.PART_FIELDS))
    # Nullable quantities leave as doubles, like amounts.
    return lines.select(
        "order_id", "order_status", "product_id", F.col("qty").cast("double").alias("qty"),
        "unit_price", "discount", "subtotal",
    )


@query
def line_index(x: Layers) -> DataFrame:
    lines = explode_items(x.stg_orders.select("order_id", "items_jsonb", *C.PART_FIELDS))
    return lines.select(
        "order_id", F.col("line_no").alias("item_index"), "product_id", F.col("qty").cast("double").alias("qty")
    )


@query
def int_order_items(x: Layers) -> DataFrame:
    return line_items.int_order_items(x.compute_line_items())


@query
def line_metrics(x: Layers) -> DataFrame:
    lines = line_items.price_lines(
        explode_items(x.stg_orders.select("order_id", "items_jsonb", *C.PART_FIELDS)), x.stg_products
    )
    return lines.select(
        "order_id", "line_no", "product_id", "qty", "unit_price_idr", "discount_idr",
        "gross_revenue_idr", "cogs_idr", "gross_profit_idr",
    )


@query
def surrogate_keys(x: Layers) -> DataFrame:
    lines = line_items.int_order_items(x.line_items).select(
        F.lit("line").alias("kind"), F.col("order_item_id").alias("surrogate_key")
    )
    days = x.compute_daily().select(F.lit("day").alias("kind"), F.col("daily_sales_id").alias("surrogate_key"))
    return lines.unionByName(days)


@query
def int_customer_metrics(x: Layers) -> DataFrame:
    return customers.int_customer_metrics(x.line_items)


@query
def product_sales_metrics(x: Layers) -> DataFrame:
    return products.product_sales_metrics(x.line_items)


@query
def dim_customers(x: Layers) -> DataFrame:
    return x.compute_dim_customers()


@query
def customer_tiering(x: Layers) -> DataFrame:
    return x.compute_dim_customers().select("customer_id", "lifetime_net_spend_idr", "customer_tier")


@query
def dim_products(x: Layers) -> DataFrame:
    return x.compute_dim_products()


@query
def stock_status(x: Layers) -> DataFrame:
    return x.stg_products.select(
        "product_id", "stock_qty", products.stock_status(F.col("stock_qty")).alias("stock_status")
    )


@query
def fact_order_items(x: Layers) -> DataFrame:
    return x.compute_fact()


@query
def safe_margin(x: Layers) -> DataFrame:
    return x.compute_fact().select(
        "order_item_id", "gross_revenue_idr", "gross_profit_idr", "profit_margin_percentage",
        percent(F.col("discount_idr"), F.col("unit_price_idr"), 1).alias("discount_percentage"),
    )


@query
def fct_daily_sales(x: Layers) -> DataFrame:
    return x.compute_daily()


# ---------------------------------------------------------------- joins and aggregates on their own


@query
def orphan_customers(x: Layers) -> DataFrame:
    """Buyers without a customer record, with what they bought."""
    buyers = x.line_items.groupBy("customer_id").agg(F.count("*").alias("n_items"))
    return buyers.join(x.stg_customers.select("customer_id"), "customer_id", "left_anti")


@query
def distinct_orders(x: Layers) -> DataFrame:
    """Distinct orders per product, all statuses, by Spark's own distinct count."""
    return x.line_items.groupBy("product_id").agg(F.count_distinct("order_id").alias("total_orders"))


@query
def conditional_distinct(x: Layers) -> DataFrame:
    """Distinct orders per category and status class, counted in two steps as in the daily mart."""
    per_order = x.line_items.select("category", "order_id", "order_status").distinct()
    return per_order.groupBy("category").agg(
        F.count("order_id").alias("total_orders"),
        F.count(F.when(F.col("order_status") == C.STATUS_COMPLETED, F.col("order_id"))).alias("completed_orders"),
        F.count(F.when(F.col("order_status") == C.STATUS_CANCELLED, F.col("order_id"))).alias("cancelled_orders"),
    )


@query
def conditional_sums(x: Layers) -> DataFrame:
    completed = F.col("order_status") == C.STATUS_COMPLETED
    return x.line_items.groupBy("payment_method", "channel").agg(
        F.sum("qty").alias("units"),
        F.sum("gross_revenue_idr").alias("gross_revenue_idr"),
        F.sum(F.col("discount_idr") * F.col("qty")).alias("total_discount_idr"),
        sum_where(completed, F.col("gross_revenue_idr")).alias("net_revenue_idr"),
        sum_where(completed, F.col("gross_profit_idr")).alias("net_profit_idr"),
        count_where(completed).alias("completed_lines"),
    )


# ---------------------------------------------------------------- reports


@query
def report_daily_sales(x: Layers) -> DataFrame:
    return reports.daily_sales_extract(x.daily)


@query
def product_ranking(x: Layers) -> DataFrame:
    return reports.product_ranking(x.dim_products, "revenue")


@query
def product_ranking_by_margin(x: Layers) -> DataFrame:
    return reports.product_ranking(x.dim_products, "margin")


@query
def product_ranking_by_units(x: Layers) -> DataFrame:
    return reports.product_ranking(x.dim_products, "units")


@query
def inventory_search(x: Layers) -> DataFrame:
    return reports.inventory_search(x.dim_products, SEARCH_TERM, CATEGORY, "units")


@query
def inventory_search_by_name(x: Layers) -> DataFrame:
    return reports.inventory_search(x.dim_products, NAME_TERM)


@query
def inventory_search_by_sku(x: Layers) -> DataFrame:
    return reports.inventory_search(x.dim_products, SKU_TERM)


@query
def tier_summary(x: Layers) -> DataFrame:
    return reports.tier_summary(x.dim_customers)


@query
def tier_share(x: Layers) -> DataFrame:
    return reports.tier_share(x.dim_customers)


@query
def guest_audit(x: Layers) -> DataFrame:
    return reports.guest_audit(x.fact)


@query
def pipeline_summary(x: Layers) -> DataFrame:
    return reports.run_summary(x.dim_customers, x.dim_products, x.fact, x.daily)


@query
def filter_values(x: Layers) -> DataFrame:
    return reports.filter_values(x.daily)


@query
def kpi_summary(x: Layers) -> DataFrame:
    return reports.kpi_summary(x.daily, x.fact, x.dim_customers, x.dim_products)


@query
def kpi_filtered(x: Layers) -> DataFrame:
    return reports.kpi_filtered(x.daily, x.fact, x.dim_customers, x.dim_products, CATEGORY, CHANNEL)


@query
def kpi_exact_orders(x: Layers) -> DataFrame:
    return reports.kpi_exact_orders(x.fact)


@query
def guest_revenue_prorata(x: Layers) -> DataFrame:
    return reports.guest_revenue_prorata(x.daily, x.fact, CATEGORY, CHANNEL)


@query
def guest_revenue_exact(x: Layers) -> DataFrame:
    return reports.guest_revenue_exact(x.fact, x.dim_products, CATEGORY, CHANNEL)


@query
def fulfillment_rate(x: Layers) -> DataFrame:
    return reports.fulfillment_rate(x.daily)


@query
def daily_trend(x: Layers) -> DataFrame:
    return reports.daily_trend(x.daily)


@query
def daily_trend_of_channel(x: Layers) -> DataFrame:
    return reports.daily_trend(x.daily, channel=CHANNEL)


@query
def channel_share(x: Layers) -> DataFrame:
    return reports.channel_share(x.daily)


@query
def category_share(x: Layers) -> DataFrame:
    return reports.category_share(x.daily)


@query
def revenue_reconciliation_written(x: Layers) -> DataFrame:
    """Summed by the jobs that write the lines and the fact."""
    watches = x.watches("line_items", "fact_order_items")
    return reports.written_reconciliation(x.spark, watches["line_items"], watches["fact_order_items"])


@query
def revenue_reconciliation(x: Layers) -> DataFrame:
    return reports.revenue_reconciliation(x.line_items, x.fact)


# ---------------------------------------------------------------- data tests, on raw data (dirty) and marts (clean)


@query
def dq_not_null(x: Layers) -> DataFrame:
    raw = [
        quality.RowTest("raw.orders", "not_null", "status", F.col("status").isNull()),
        quality.RowTest("raw.orders", "not_null", "order_id", F.col("order_id").isNull()),
    ]
    lines = [
        quality.RowTest("raw.items", "not_null", c, F.col(c).isNull()) for c in ("qty", "unit_price", "discount")
    ]
    items = explode_items(x.settled_stg_orders.select("order_id", "items_jsonb", *C.PART_FIELDS))
    on_raw = quality.row_failures({"raw.orders": first_parts(x.raw_orders), "raw.items": items}, raw + lines)
    return on_raw.unionByName(quality.row_failures(x.marts, quality.not_null_tests()))


@query
def dq_unique(x: Layers) -> DataFrame:
    raw = {"raw.customers": x.raw_customers, "raw.products": x.raw_products, "raw.orders": first_parts(x.raw_orders)}
    keys = [
        quality.UniqueTest("raw.customers", "customer_id"),
        quality.UniqueTest("raw.products", "product_id"),
        quality.UniqueTest("raw.orders", "order_id"),
    ]
    return quality.unique_failures(raw, keys).unionByName(quality.unique_failures(x.marts, quality.UNIQUE))


@query
def dq_relationships(x: Layers) -> DataFrame:
    raw = {"raw.customers": x.raw_customers, "raw.orders": first_parts(x.raw_orders)}
    on_raw = quality.parent_failures(
        raw, [quality.ParentTest("raw.orders", "customer_id", "raw.customers", "customer_id")]
    )
    return on_raw.unionByName(quality.parent_failures(x.marts, quality.PARENTS))


@query
def dq_negative_revenue(x: Layers) -> DataFrame:
    """Before the clamps of the line metrics (dirty) and in the fact (clean)."""
    items = explode_items(x.stg_orders.select("order_id", "items_jsonb", *C.PART_FIELDS)).select(
        ((F.col("unit_price") - F.col("discount")) * F.col("qty")).alias("gross_revenue_idr"),
        F.col("qty").alias("cogs_idr"),
    )
    return quality.row_failures(
        {"raw.items": items, "fact_order_items": x.fact},
        [quality.negative_revenue_test("raw.items"), quality.negative_revenue_test()],
    )


@query
def dq_order_dates(x: Layers) -> DataFrame:
    """Against the dates as given, a generation too early (dirty), and in the fact (clean)."""
    given_dates = x.spark.read.parquet(f"{x.folder}/orders.parquet").select(
        F.col("o_orderdate").cast("date").alias("order_date")
    )
    return quality.row_failures(
        {"orders": given_dates, "fact_order_items": x.fact},
        [quality.order_date_test(AS_OF, "orders"), quality.order_date_test(AS_OF)],
    )


@query
def dq_stock(x: Layers) -> DataFrame:
    raw = x.raw_products.select(F.col("stock_qty").cast("int").alias("stock_qty"))
    return quality.row_failures(
        {"raw.products": raw, "dim_products": x.dim_products},
        [quality.stock_test("raw.products"), quality.stock_test()],
    )


def raw_item_amounts(x: Layers) -> DataFrame:
    """Items before the clamps of the line metrics."""
    return explode_items(x.stg_orders.select("order_id", "items_jsonb", *C.PART_FIELDS)).select(
        "order_id", "product_id", "qty",
        ((F.col("unit_price") - F.col("discount")) * F.col("qty")).alias("gross_revenue_idr"),
        F.col("qty").alias("cogs_idr"),
    )


@query
def dq_negative_revenue_rows(x: Layers) -> DataFrame:
    tests = [quality.negative_revenue_test("raw.items"), quality.negative_revenue_test()]
    sides = {"raw.items": raw_item_amounts(x), "fact_order_items": x.fact}
    return quality.stack(
        [
            quality.violating_rows(sides, t).select(F.lit(t.table).alias("target"), "order_id", "product_id", "qty", "gross_revenue_idr")
            for t in tests
        ]
    )


@query
def dq_order_dates_rows(x: Layers) -> DataFrame:
    given = x.spark.read.parquet(f"{x.folder}/orders.parquet").select(
        F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_orderdate").cast("date").alias("order_date")
    )
    tests = [quality.order_date_test(AS_OF, "orders"), quality.order_date_test(AS_OF)]
    sides = {"orders": given, "fact_order_items": x.fact}
    return quality.stack(
        [quality.violating_rows(sides, t).select(F.lit(t.table).alias("target"), "order_id", "order_date") for t in tests]
    )


@query
def dq_stock_rows(x: Layers) -> DataFrame:
    raw = x.raw_products.select("product_id", F.col("stock_qty").cast("int").alias("stock_qty"))
    tests = [quality.stock_test("raw.products"), quality.stock_test()]
    sides = {"raw.products": raw, "dim_products": x.dim_products}
    return quality.stack(
        [quality.violating_rows(sides, t).select(F.lit(t.table).alias("target"), "product_id", "stock_qty") for t in tests]
    )


@query
def dq_orphan_rows(x: Layers) -> DataFrame:
    test = quality.ParentTest("raw.orders", "customer_id", "raw.customers", "customer_id")
    return quality.violating_rows({"raw.orders": first_parts(x.raw_orders), "raw.customers": x.raw_customers}, test)


@query
def dq_raw_counts(x: Layers) -> DataFrame:
    raw = {"customers": x.raw_customers, "products": x.raw_products, "orders": first_parts(x.raw_orders)}
    return quality.raw_counts(raw).withColumnRenamed("rows", "n_rows")


@query
def dq_report(x: Layers) -> DataFrame:
    return quality.mart_report(x.marts, AS_OF, x.watches(*x.marts))


@query
def dq_report_reread(x: Layers) -> DataFrame:
    """The same tests with the row tests read from the finished marts."""
    return quality.mart_report(x.marts, AS_OF)


@query
def dq_document_violations(x: Layers) -> DataFrame:
    return quality.document_violations(x.raw_orders)


# Items of planted documents: numbers that are none, no items at all, a price that is none beside a missing product.
BAD_ITEMS = (
    '[{"product_id":"P","qty":"two","unit_price":"1","discount":"none"}]',
    None,
    '[{"product_id":"P","qty":1,"unit_price":"free"},{"qty":1,"unit_price":2}]',
)


@query
def dq_document_types(x: Layers) -> DataFrame:
    """All documents, and a copy of each with bad items, by its number."""
    kind = F.pmod("o_orderkey", F.lit(len(BAD_ITEMS)))
    items = F.element_at(F.array(*map(F.lit, BAD_ITEMS)), (kind + 1).cast("int"))
    heads = raw_order_heads(x.spark, x.folder)
    planted = heads.withColumns({"order_id": F.concat(F.lit("BAD-"), "order_id"), "items": items, "part": F.lit(0)})
    same = [c for c in x.raw_orders.columns if c in planted.columns]
    return quality.document_violations(x.raw_orders.select(*same).unionByName(planted.select(*same)))


@query
def dq_dirty_profile(x: Layers) -> DataFrame:
    return quality.dirty_profile(x.raw_customers, x.raw_products, raw_order_heads(x.spark, x.folder))


@query
def dq_accepted_values(x: Layers) -> DataFrame:
    return quality.status_and_payment_values(first_parts(x.stg_orders))
