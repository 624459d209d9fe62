"""The two fact tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung import constants as C
from lumbung.functions.amounts import as_money, count_where, percent, sum_where
from lumbung.functions.keys import daily_sales_key, order_item_key

DAILY_KEYS = ("order_date", "category", "payment_method", "channel")
# Tasks that the orders of one daily group are dealt to.
SPREAD = 8


def fact_order_items(layer: DataFrame) -> DataFrame:
    """Line fact. Registration was resolved per order, so this is a projection: no join, no shuffle."""
    registered = F.col("is_registered_customer")
    return layer.select(
        order_item_key().alias("order_item_id"),
        "order_id",
        F.when(registered, F.col("customer_id")).otherwise(F.lit(C.UNKNOWN_ID)).alias("customer_id"),
        F.col("customer_id").alias("raw_customer_id"),
        "is_registered_customer",
        "product_id",
        "ordered_at",
        "order_date",
        "order_status",
        "payment_method",
        "channel",
        "qty",
        "unit_price_idr",
        "discount_idr",
        "gross_revenue_idr",
        "cogs_idr",
        "gross_profit_idr",
        percent(F.col("gross_profit_idr"), F.col("gross_revenue_idr")).alias("profit_margin_percentage"),
    )


def fct_daily_sales(layer: DataFrame) -> DataFrame:
    """Daily totals in two steps: first per order inside the group, then per group.

    An order has one status, so after the first step each row is one distinct
    order of its group and the three distinct counts are plain counts. Lines move
    once, as they are, to one of ``SPREAD`` tasks of their group by their order:
    an exact count needs that. The second step ships one partial row per group and
    such task, so what it moves grows with the groups, and a group with a large
    part of all lines still has several tasks. Profits are taken from the sums,
    which is exact and saves two of ten decimal additions.
    """
    completed = F.col("order_status") == C.STATUS_COMPLETED
    lines = layer.select(*DAILY_KEYS, "order_id", "order_status", "qty", "gross_revenue_idr", "discount_idr", "cogs_idr")
    lines = lines.withColumn("_task", F.pmod(F.xxhash64("order_id"), F.lit(SPREAD)).cast("byte"))
    per_order = lines.repartition(*DAILY_KEYS, "_task").groupBy(*DAILY_KEYS, "_task", "order_id", "order_status").agg(
        F.sum("qty").alias("units"),
        F.sum("gross_revenue_idr").alias("revenue"),
        F.sum(as_money(F.col("discount_idr") * F.col("qty"))).alias("discount"),
        F.sum("cogs_idr").alias("cogs"),
    )
    named = F.col("order_id").isNotNull()
    per_group = per_order.groupBy(*DAILY_KEYS).agg(
        count_where(named).alias("total_orders"),
        count_where(named & completed).alias("completed_orders"),
        count_where(named & (F.col("order_status") == C.STATUS_CANCELLED)).alias("cancelled_orders"),
        F.sum("units").alias("total_units_sold"),
        F.sum("revenue").alias("gross_revenue_idr"),
        F.sum("discount").alias("total_discount_idr"),
        F.sum("cogs").alias("total_cogs_idr"),
        sum_where(completed, F.col("revenue")).alias("net_revenue_idr"),
        sum_where(completed, F.col("cogs")).alias("_net_cogs"),
    )
    net_profit = F.col("net_revenue_idr") - F.col("_net_cogs")
    return per_group.select(
        daily_sales_key().alias("daily_sales_id"),
        *DAILY_KEYS,
        "total_orders", "completed_orders", "cancelled_orders", "total_units_sold",
        "gross_revenue_idr", "total_discount_idr", "total_cogs_idr",
        (F.col("gross_revenue_idr") - F.col("total_cogs_idr")).alias("gross_profit_idr"),
        "net_revenue_idr",
        net_profit.alias("net_profit_idr"),
        percent(net_profit, F.col("net_revenue_idr")).alias("net_profit_margin_percentage"),
    )
