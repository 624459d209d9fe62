"""Customer metrics and the customer dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung import constants as C
from lumbung.functions.amounts import as_money, count_where, sum_where
from lumbung.schemas import MONEY


def int_customer_metrics(layer: DataFrame) -> DataFrame:
    """Lifetime figures per customer id as it stands in the orders.

    An order belongs to one customer and opens with one first line, so order
    counts are plain conditional counts: one pass, partial results per task,
    no distinct.
    """
    opens_order = (F.col("line_no") == 1) & F.col("order_id").isNotNull()
    completed = F.col("order_status") == C.STATUS_COMPLETED
    return layer.groupBy("customer_id").agg(
        count_where(opens_order).alias("total_orders"),
        count_where(opens_order & completed).alias("total_completed_orders"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.sum("gross_revenue_idr").alias("lifetime_gross_spend_idr"),
        sum_where(completed, F.col("gross_revenue_idr")).alias("lifetime_net_spend_idr"),
        sum_where(completed, F.col("gross_profit_idr")).alias("lifetime_gross_profit_idr"),
    )


def customer_tier(net_spend: Column) -> Column:
    return (
        F.when(net_spend >= C.TIER_PLATINUM_FROM, C.TIER_PLATINUM)
        .when(net_spend >= C.TIER_GOLD_FROM, C.TIER_GOLD)
        .when(net_spend >= C.TIER_SILVER_FROM, C.TIER_SILVER)
        .when(net_spend > 0, C.TIER_BRONZE)
        .otherwise(C.TIER_NONE)
    )


PROFILE = (
    "customer_id", "full_name", "email", "is_valid_email", "city", "signup_date", "customer_segment",
    "phone_number", "gender",
)


def unknown_member(spark: SparkSession) -> DataFrame:
    """The single row that orders of unregistered buyers point to; its metrics are zero by definition."""
    nothing, zero = F.lit(None), F.lit(0).cast("long")
    no_money = F.lit(0).cast(MONEY)
    return spark.range(1).select(
        F.lit(C.UNKNOWN_ID).alias("customer_id"),
        F.lit(C.UNKNOWN_NAME).alias("full_name"),
        nothing.cast("string").alias("email"),
        F.lit(False).alias("is_valid_email"),
        F.lit(C.UNKNOWN_CITY).alias("city"),
        F.lit(C.UNKNOWN_SIGNUP).cast("date").alias("signup_date"),
        F.lit(C.UNKNOWN_SEGMENT).alias("customer_segment"),
        nothing.cast("string").alias("phone_number"),
        F.lit(C.UNKNOWN_GENDER).alias("gender"),
        F.lit(False).alias("is_registered_in_crm"),
        zero.alias("total_orders"),
        zero.alias("total_completed_orders"),
        nothing.cast("date").alias("first_order_date"),
        nothing.cast("date").alias("last_order_date"),
        no_money.alias("lifetime_gross_spend_idr"),
        no_money.alias("lifetime_net_spend_idr"),
        no_money.alias("lifetime_gross_profit_idr"),
        F.lit(C.UNKNOWN_TIER).alias("customer_tier"),
    )


def dim_customers(customers: DataFrame, metrics: DataFrame) -> DataFrame:
    def known(metric: str) -> Column:
        return F.coalesce(F.col(metric), F.lit(0)).alias(metric)

    registered = customers.select(*PROFILE).join(metrics, "customer_id", "left").select(
        *PROFILE,
        F.lit(True).alias("is_registered_in_crm"),
        known("total_orders"),
        known("total_completed_orders"),
        "first_order_date",
        "last_order_date",
        known("lifetime_gross_spend_idr"),
        known("lifetime_net_spend_idr"),
        known("lifetime_gross_profit_idr"),
    )
    tiered = registered.withColumn("customer_tier", customer_tier(F.col("lifetime_net_spend_idr")))
    return tiered.unionByName(unknown_member(customers.sparkSession))
