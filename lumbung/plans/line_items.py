"""Order documents to priced line items, the layer all marts are computed from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.constants import PART_FIELDS
from lumbung.functions.amounts import as_money, at_least, not_below_zero
from lumbung.functions.keys import order_item_key
from lumbung.operators.unnest import explode_items

# The layer: public columns except the key, which is made from two others when it is needed, and helpers.
LINE_ITEM_COLUMNS = (
    "order_id", "customer_id", "ordered_at", "order_date", "order_status", "payment_method",
    "channel", "product_id", "product_name", "category", "qty", "unit_price_idr", "discount_idr",
    "gross_revenue_idr", "cogs_idr", "gross_profit_idr",
)
HELPER_COLUMNS = ("line_no", "opens_product", "is_registered_customer")


def with_registration(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Flag orders whose buyer has a customer record.

    This runs per order, before the unnest: a fraction of the rows of a lookup
    per line. The customer id stays as it is, so buyers without a record do not
    pile up under one shared key. Spark broadcasts the ids when they are below
    its measured threshold; otherwise it joins by id and splits skewed ids.
    """
    known = customers.select("customer_id", F.lit(True).alias("_known"))
    return (
        orders.join(known, "customer_id", "left")
        .withColumn("is_registered_customer", F.col("_known").isNotNull())
        .drop("_known")
    )


def unnest_orders(orders: DataFrame) -> DataFrame:
    """Order lines with the order's own attributes, before any product is looked up."""
    carried = [
        c
        for c in ("order_id", "customer_id", "ordered_at", "order_date", "order_status", "payment_method", "channel",
                  "is_registered_customer", "items_jsonb", *PART_FIELDS)
        if c in orders.columns
    ]
    return explode_items(orders.select(*carried))


def price_lines(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Look up the catalogue and compute revenue, cost and profit per line."""
    catalogue = products.select("product_id", "product_name", "category", "price_idr", "cost_idr")
    joined = lines.join(catalogue, "product_id", "left")
    qty = at_least(F.col("qty"), 1)
    zero = as_money(F.lit(0))
    inputs = joined.select(
        *[c for c in joined.columns if c not in ("qty", "unit_price", "discount", "subtotal", "price_idr", "cost_idr")],
        qty.alias("qty"),
        F.coalesce("unit_price", "price_idr", zero).alias("unit_price_idr"),
        F.coalesce("discount", zero).alias("discount_idr"),
        F.coalesce("cost_idr", zero).alias("_unit_cost"),
    )
    amounts = inputs.withColumns(
        {
            "gross_revenue_idr": not_below_zero((F.col("unit_price_idr") - F.col("discount_idr")) * F.col("qty")),
            "cogs_idr": as_money(F.col("_unit_cost") * F.col("qty")),
        }
    ).drop("_unit_cost")
    return amounts.withColumn("gross_profit_idr", as_money(F.col("gross_revenue_idr") - F.col("cogs_idr")))


def line_item_layer(orders: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Line items plus helper columns. Write this once and compute every mart from it."""
    lines = price_lines(unnest_orders(with_registration(orders, customers)), products)
    return lines.select(*LINE_ITEM_COLUMNS, *HELPER_COLUMNS)


def int_order_items(layer: DataFrame) -> DataFrame:
    return layer.select(order_item_key().alias("order_item_id"), *LINE_ITEM_COLUMNS)
