"""Reports. Every one of them reads finished marts."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbung import constants as C
from lumbung.functions.amounts import as_money, count_where, percent_or_zero, sum_where
from lumbung.functions.keys import dashed_md5
from lumbung.functions.text import contains_ignoring_case
from lumbung.operators.shares import with_share
from lumbung.operators.watch import Watch
from lumbung.schemas import MONEY_SUM

PRODUCT_SORTS = {
    "revenue": "total_revenue_generated_idr",
    "margin": "margin_percentage",
    "units": "total_units_sold",
}


def chosen(frame: DataFrame, category: str = C.ALL, channel: str = C.ALL) -> DataFrame:
    """Optional filters; ``ALL`` leaves the frame alone."""
    if category != C.ALL:
        frame = frame.filter(F.col("category") == category)
    if channel != C.ALL:
        frame = frame.filter(F.col("channel") == channel)
    return frame


def daily_sales_extract(daily: DataFrame) -> DataFrame:
    return daily.select(
        F.col("order_date").cast("string").alias("order_date"),
        "category", "payment_method", "channel",
        "total_orders", "completed_orders", "cancelled_orders", "total_units_sold",
        "gross_revenue_idr", "net_revenue_idr", "total_cogs_idr", "gross_profit_idr", "net_profit_idr",
        "net_profit_margin_percentage",
    ).orderBy(F.col("order_date").asc_nulls_last())


def product_ranking(products: DataFrame, sort_by: str = "revenue") -> DataFrame:
    """The catalogue with its sales, best first; a distributed sort, product id breaks ties."""
    return products.select(
        "product_id", "sku", "product_name", "category", "price_idr", "cost_idr", "unit_margin_idr",
        "margin_percentage", "stock_qty", "is_active", "total_completed_orders", "total_units_sold",
        "total_revenue_generated_idr", "total_profit_generated_idr", "stock_status",
    ).orderBy(F.col(PRODUCT_SORTS[sort_by]).desc_nulls_last(), F.col("product_id").asc_nulls_last())


def inventory_search(
    products: DataFrame, term: str = "", category: str = C.ALL, sort_by: str = "revenue"
) -> DataFrame:
    """Catalogue rows whose name, category or SKU contains the term, in any case."""
    matches = (
        contains_ignoring_case("product_name", term)
        | contains_ignoring_case("category", term)
        | contains_ignoring_case("sku", term)
    )
    return product_ranking(chosen(products, category).filter(matches), sort_by)


def tier_summary(customers: DataFrame) -> DataFrame:
    return customers.groupBy("customer_tier", "is_registered_in_crm").agg(
        F.count("*").alias("customer_count"),
        F.sum("lifetime_gross_spend_idr").alias("total_gross_spend"),
        F.sum("lifetime_net_spend_idr").alias("total_net_spend"),
    )


def tier_share(customers: DataFrame) -> DataFrame:
    tiers = customers.groupBy("customer_tier").agg(F.count("*").alias("customer_count"))
    return with_share(tiers, "customer_count", "percentage")


def guest_audit(fact: DataFrame) -> DataFrame:
    """Registered against unregistered sales, with their share of revenue."""
    sides = fact.groupBy("is_registered_customer").agg(
        F.count("*").alias("total_items"),
        F.sum("gross_revenue_idr").alias("total_revenue"),
        F.sum("gross_profit_idr").alias("total_profit"),
    )
    # The flag has three values at most, so all sides fit into one row, and the fact is read once.
    together = sides.agg(F.collect_list(F.struct("*")).alias("sides"), F.sum("total_revenue").alias("total"))
    rows = together.select("total", F.inline("sides"))
    return rows.select(*sides.columns, percent_or_zero(F.col("total_revenue"), F.col("total"), 2).alias("percentage"))


def run_summary(customers: DataFrame, products: DataFrame, fact: DataFrame, daily: DataFrame) -> DataFrame:
    """Row counts of the marts and the two headline sums, in one row."""
    totals = daily.agg(
        F.round(F.sum("gross_revenue_idr")).cast("long").alias("total_gross_revenue"),
        F.round(F.sum("net_profit_idr")).cast("long").alias("total_net_profit"),
    )
    return totals.select(
        row_count(customers).alias("total_customers"),
        row_count(products).alias("total_products"),
        row_count(fact).alias("total_order_items"),
        "total_gross_revenue",
        "total_net_profit",
    )


def row_count(frame: DataFrame) -> Column:
    return frame.agg(F.count("*").alias("rows")).scalar()


def filter_values(daily: DataFrame) -> DataFrame:
    """The choices of both filters, from one pass over the mart."""
    pairs = F.array(
        F.struct(F.lit("category").alias("filter"), F.col("category").alias("value")),
        F.struct(F.lit("channel").alias("filter"), F.col("channel").alias("value")),
    )
    return daily.select(F.inline(pairs)).distinct()


def sales_totals(daily: DataFrame) -> DataFrame:
    def total(column: str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0))

    sums = daily.agg(
        total("gross_revenue_idr").alias("total_gross_revenue"),
        total("net_revenue_idr").alias("total_net_revenue"),
        total("gross_profit_idr").alias("total_gross_profit"),
        total("net_profit_idr").alias("total_net_profit"),
        total("total_orders").alias("total_orders"),
        total("completed_orders").alias("total_completed_orders"),
        total("total_units_sold").alias("total_units_sold"),
    )
    margin = percent_or_zero(F.col("total_net_profit"), F.col("total_net_revenue"), 2)
    return sums.withColumn("overall_net_margin_percentage", margin)


def guest_revenue(fact: DataFrame) -> DataFrame:
    """Revenue kept for unregistered buyers."""
    return fact.filter(~F.col("is_registered_customer")).agg(
        F.coalesce(F.sum("gross_revenue_idr"), F.lit(0)).alias("preserved_guest_revenue")
    )


def kpi_summary(daily: DataFrame, fact: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """All headline figures. ``total_orders`` adds up the daily groups; see kpi_exact_orders."""
    return sales_totals(daily).select(
        "*",
        guest_revenue(fact).scalar().alias("preserved_guest_revenue"),
        row_count(customers.filter("is_registered_in_crm")).alias("registered_customers_count"),
        row_count(products.filter("is_active")).alias("active_products_count"),
    )


def kpi_filtered(
    daily: DataFrame,
    fact: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    category: str = C.ALL,
    channel: str = C.ALL,
) -> DataFrame:
    """The headline figures under a filter; guest revenue is the pro-rata estimate."""
    return sales_totals(chosen(daily, category, channel)).select(
        "*",
        guest_revenue_prorata(daily, fact, category, channel).scalar().alias("preserved_guest_revenue"),
        row_count(customers.filter("is_registered_in_crm")).alias("registered_customers_count"),
        row_count(products.filter("is_active")).alias("active_products_count"),
    )


def guest_revenue_prorata(
    daily: DataFrame, fact: DataFrame, category: str = C.ALL, channel: str = C.ALL
) -> DataFrame:
    """All guest revenue times the selection's part of gross revenue, as a whole number."""
    in_category = F.lit(True) if category == C.ALL else F.col("category") == category
    in_channel = F.lit(True) if channel == C.ALL else F.col("channel") == channel
    sums = daily.agg(
        F.coalesce(sum_where(in_category & in_channel, F.col("gross_revenue_idr")), F.lit(0)).alias("part"),
        F.coalesce(F.sum("gross_revenue_idr"), F.lit(0)).alias("whole"),
    )
    share = F.when(F.col("whole") > 0, F.col("part").cast("double") / F.col("whole").cast("double")).otherwise(0.0)
    guests = guest_revenue(fact).scalar().cast("double")
    return sums.select(F.round(guests * share).cast("long").alias("preserved_guest_revenue"))


def guest_revenue_exact(
    fact: DataFrame, products: DataFrame, category: str = C.ALL, channel: str = C.ALL
) -> DataFrame:
    """Guest revenue of the selection, summed from the fact itself.

    Guest lines are added up per product first, so the catalogue lookup sees
    one row per product however often it was sold.
    """
    lines = chosen(fact, channel=channel).filter(~F.col("is_registered_customer"))
    per_product = lines.groupBy("product_id").agg(F.sum("gross_revenue_idr").alias("revenue"))
    if category != C.ALL:
        catalogue = chosen(products, category).select("product_id")
        per_product = per_product.join(catalogue, "product_id", "left_semi")
    return per_product.agg(F.coalesce(F.sum("revenue"), F.lit(0)).alias("preserved_guest_revenue"))


def kpi_exact_orders(fact: DataFrame) -> DataFrame:
    """Order counts that do not count an order once per category.

    Each order has exactly one line whose key was made from line number 1.
    Counting those lines counts the orders in one pass, without a distinct
    over all order ids.
    """
    opens_order = F.col("order_item_id") == dashed_md5(F.col("order_id"), F.lit(1))
    return fact.agg(
        count_where(opens_order).alias("total_orders"),
        count_where(opens_order & (F.col("order_status") == C.STATUS_COMPLETED)).alias("completed_orders"),
        count_where(opens_order & (F.col("order_status") == C.STATUS_CANCELLED)).alias("cancelled_orders"),
    )


def fulfillment_rate(daily: DataFrame, category: str = C.ALL, channel: str = C.ALL) -> DataFrame:
    return sales_totals(chosen(daily, category, channel)).select(
        "total_orders",
        "total_completed_orders",
        percent_or_zero(F.col("total_completed_orders"), F.col("total_orders"), 1).alias("fulfillment_rate"),
    )


def daily_trend(daily: DataFrame, category: str = C.ALL, channel: str = C.ALL) -> DataFrame:
    return (
        chosen(daily, category, channel)
        .groupBy("order_date")
        .agg(
            F.sum("gross_revenue_idr").alias("gross_revenue"),
            F.sum("net_profit_idr").alias("net_profit"),
            F.sum("total_orders").alias("orders"),
        )
        .orderBy(F.col("order_date").asc_nulls_last())
    )


def channel_share(daily: DataFrame) -> DataFrame:
    groups = daily.groupBy("channel").agg(
        F.sum("gross_revenue_idr").alias("revenue"), F.sum("total_orders").alias("orders")
    )
    labels = F.create_map(*[F.lit(x) for pair in C.CHANNEL_LABELS.items() for x in pair])
    named = with_share(groups, "revenue", "percentage").withColumn(
        "label", F.coalesce(F.try_element_at(labels, F.col("channel")), F.col("channel"))
    )
    return named.orderBy(F.col("revenue").desc_nulls_last())


def category_share(daily: DataFrame) -> DataFrame:
    groups = daily.groupBy("category").agg(
        F.sum("gross_revenue_idr").alias("revenue"), F.sum("total_orders").alias("orders")
    )
    return with_share(groups, "revenue", "percentage").orderBy(F.col("revenue").desc_nulls_last())


def line_sums() -> dict[str, Column]:
    """What the reconciliation asks about the lines."""
    return {"line_revenue": F.sum("gross_revenue_idr")}


def fact_sums() -> dict[str, Column]:
    """What it asks about the fact."""
    registered = F.col("is_registered_customer")
    return {
        "fact_revenue": F.sum("gross_revenue_idr"),
        "registered_revenue": F.sum(F.when(registered, F.col("gross_revenue_idr"))),
        "guest_revenue": F.sum(F.when(~registered, F.col("gross_revenue_idr"))),
    }


def reconciled(sums: DataFrame) -> DataFrame:
    zero = as_money(F.lit(0))
    parts = F.coalesce("registered_revenue", zero) + F.coalesce("guest_revenue", zero)
    return sums.withColumn(
        "is_reconciled", (F.col("line_revenue") == F.col("fact_revenue")) & (F.col("fact_revenue") == parts)
    )


def revenue_reconciliation(layer: DataFrame, fact: DataFrame) -> DataFrame:
    """No revenue gets lost between the lines, the fact and its two customer sides."""
    sides = fact.agg(*[total.alias(name) for name, total in fact_sums().items()])
    lines = layer.agg(*[total.alias(name) for name, total in line_sums().items()])
    return reconciled(sides.withColumn("line_revenue", lines.scalar()))


def written_reconciliation(spark: SparkSession, lines: Watch, fact: Watch) -> DataFrame:
    """The same from what was summed while both tables were written; neither is read."""
    found = fact.values | lines.values
    names = [*fact_sums(), *line_sums()]
    schema = ", ".join(f"{name} {MONEY_SUM}" for name in names)
    return reconciled(spark.createDataFrame([tuple(found.get(name) for name in names)], schema))


def run_metadata(report: DataFrame, generated_at: datetime) -> DataFrame:
    """What the data tests said, from the report that the run has stored."""
    tests = report.agg(
        count_where(F.col("passed")).alias("tests_passed"), F.count("*").alias("tests_total")
    )
    verdict = F.when(F.col("tests_passed") == F.col("tests_total"), "PASSED").otherwise("FAILED")
    return tests.select(
        "*", verdict.alias("quality_gate_status"), F.lit(generated_at).cast("timestamp").alias("last_run")
    )


def export_sections(
    marts: Mapping[str, DataFrame], report: DataFrame, generated_at: datetime
) -> dict[str, DataFrame]:
    """All sections of the downstream export."""
    customers, products = marts["dim_customers"], marts["dim_products"]
    fact, daily = marts["fact_order_items"], marts["fct_daily_sales"]
    side = F.when(F.col("is_registered_customer"), C.REGISTERED_LABEL).otherwise(C.GUEST_LABEL)
    origin = customers.sparkSession.range(1).select(
        F.lit(generated_at).cast("timestamp").alias("generated_at"), F.lit("marts").alias("source")
    )
    return {
        "generated": origin,
        "summary": kpi_summary(daily, fact, customers, products),
        "run_metadata": run_metadata(report, generated_at),
        "daily_sales": daily_sales_extract(daily),
        "products": product_ranking(products),
        "customer_tiers": tier_summary(customers),
        "kimball_audit": guest_audit(fact).withColumn("label", side),
    }


def export_json(
    marts: Mapping[str, DataFrame], report: DataFrame, folder: str, generated_at: datetime
) -> dict[str, T.StructType]:
    """Write each section as JSON lines below ``folder``; returns the sections with their schemas.

    Writing is distributed like any other output; files are numbered in the
    order of the section's sort.
    """
    sections = export_sections(marts, report, generated_at)
    for name, frame in sections.items():
        frame.write.mode("overwrite").json(f"{folder}/{name}")
    return {name: frame.schema for name, frame in sections.items()}
