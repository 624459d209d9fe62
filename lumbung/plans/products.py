"""Product sales and the product dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung import constants as C
from lumbung.functions.amounts import as_money, count_where, percent


def product_sales_metrics(layer: DataFrame) -> DataFrame:
    """Completed sales per product; one line opens each (order, product) pair, so no distinct is needed."""
    completed = layer.filter(F.col("order_status") == C.STATUS_COMPLETED)
    return completed.groupBy("product_id").agg(
        count_where(F.col("opens_product") & F.col("order_id").isNotNull()).alias("total_orders"),
        F.sum("qty").alias("total_units_sold"),
        F.sum("gross_revenue_idr").alias("total_revenue_generated_idr"),
        F.sum("gross_profit_idr").alias("total_profit_generated_idr"),
    )


def stock_status(stock: Column) -> Column:
    return (
        F.when(stock == 0, C.STOCK_OUT)
        .when(stock < C.STOCK_LOW_BELOW, C.STOCK_LOW)
        .otherwise(C.STOCK_HEALTHY)
    )


def dim_products(products: DataFrame, sales: DataFrame) -> DataFrame:
    def sold(metric: str, name: str) -> Column:
        return F.coalesce(F.col(metric), F.lit(0)).alias(name)

    margin = as_money(F.col("price_idr") - F.col("cost_idr"))
    return products.join(sales, "product_id", "left").select(
        "product_id", "sku", "product_name", "category", "price_idr", "cost_idr",
        margin.alias("unit_margin_idr"),
        percent(margin, F.col("price_idr")).alias("margin_percentage"),
        "stock_qty", "weight_gram", "is_active", "is_valid_pricing",
        sold("total_orders", "total_completed_orders"),
        sold("total_units_sold", "total_units_sold"),
        sold("total_revenue_generated_idr", "total_revenue_generated_idr"),
        sold("total_profit_generated_idr", "total_profit_generated_idr"),
        stock_status(F.col("stock_qty")).alias("stock_status"),
    )
