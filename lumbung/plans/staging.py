"""Raw rows to typed, clean, unique rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.constants import PART_FIELDS, STATUS_MISSING
from lumbung.functions.amounts import at_least, exact_money
from lumbung.functions.text import has_email_format, lowered, raised, trimmed
from lumbung.operators.latest import latest_by
from lumbung.operators.unnest import part_column

VERSION = "_loaded_at"


def newest(raw: DataFrame, key: str) -> DataFrame:
    """Newest row per key. The key is trimmed first, so padded copies are copies too."""
    return latest_by(raw.withColumn(key, trimmed(key)), key, VERSION)


def stg_customers(raw: DataFrame) -> DataFrame:
    rows = newest(
        raw.select("customer_id", "full_name", "email", "city", "signup_date", "segment", "phone", "gender", VERSION),
        "customer_id",
    )
    valid = has_email_format("email")
    return rows.select(
        "customer_id",
        trimmed("full_name").alias("full_name"),
        trimmed("email").alias("raw_email"),
        F.when(valid, lowered("email")).alias("email"),
        valid.alias("is_valid_email"),
        trimmed("city").alias("city"),
        F.col("signup_date").cast("date").alias("signup_date"),
        lowered("segment").alias("customer_segment"),
        trimmed("phone").alias("phone_number"),
        raised("gender").alias("gender"),
        VERSION,
    )


def stg_products(raw: DataFrame) -> DataFrame:
    rows = newest(
        raw.select(
            "product_id", "sku", "product_name", "category", "price", "cost",
            "stock_qty", "weight_gram", "is_active", VERSION,
        ),
        "product_id",
    )
    price, cost, stock = exact_money(F.col("price")), exact_money(F.col("cost")), F.col("stock_qty").cast("int")
    return rows.select(
        "product_id",
        trimmed("sku").alias("sku"),
        trimmed("product_name").alias("product_name"),
        trimmed("category").alias("category"),
        price.alias("price_idr"),
        cost.alias("cost_idr"),
        at_least(stock, 0).alias("stock_qty"),
        stock.alias("raw_stock_qty"),
        F.col("weight_gram").cast("int").alias("weight_gram"),
        F.col("is_active").cast("boolean").alias("is_active"),
        F.coalesce((price > 0) & (cost > 0), F.lit(False)).alias("is_valid_pricing"),
        VERSION,
    )


# Filters on the raw column, so that the scan can use its statistics: whole documents have no part.
FIRST_PART, FURTHER_PART = "part IS NULL OR part = 0", "part > 0"


def newest_loads(rows: DataFrame) -> DataFrame:
    """order_id and newest load of every order that some load has cut into parts, without reading items.

    A first part is in every load. Which orders come in parts is asked first; where none do, nothing else is read.
    """
    loads = rows.select("order_id", "part", F.col(VERSION).alias("_newest"))
    cut = loads.filter(FURTHER_PART).select("order_id").distinct()
    return loads.filter(FIRST_PART).join(cut, "order_id", "left_semi").groupBy("order_id").agg(F.max("_newest").alias("_newest"))


def newest_orders(raw: DataFrame) -> DataFrame:
    """All parts of the newest load of each order, one row per order and part.

    Whole documents and first parts are read once and shuffled once, by order. Further parts are asked for with a
    filter that skips all row groups without any, so items are not read twice; they are shuffled by order and part,
    which spreads a very large order, and only they are compared with the newest load of their order. Both keep one
    row per key and task before the shuffle.
    """
    rows = raw.withColumn("order_id", trimmed("order_id"))
    if "part" not in raw.columns:
        return latest_by(rows, "order_id", VERSION)
    first = latest_by(rows.filter(FIRST_PART).withColumn("part", F.lit(0)), "order_id", VERSION)
    further = latest_by(rows.filter(FURTHER_PART), ("order_id", "part"), VERSION)
    further = further.join(newest_loads(rows), "order_id").filter(F.col(VERSION) == F.col("_newest"))
    return first.unionByName(further.drop("_newest"))


def stg_orders(raw: DataFrame) -> DataFrame:
    """One row per order, or per part of an order that comes in several documents (columns ``PART_FIELDS``)."""
    rows = newest_orders(
        raw.select(
            "order_id", "customer_id", "order_date", "status", "payment_method", "channel",
            "total_amount", "items", VERSION, *[c for c in PART_FIELDS if c in raw.columns],
        )
    )
    moment = F.col("order_date").cast("timestamp")
    return rows.select(
        "order_id",
        trimmed("customer_id").alias("customer_id"),
        moment.alias("ordered_at"),
        moment.cast("date").alias("order_date"),
        F.coalesce(lowered("status"), F.lit(STATUS_MISSING)).alias("order_status"),
        F.col("status").isNotNull().alias("is_status_present"),
        lowered("payment_method").alias("payment_method"),
        lowered("channel").alias("channel"),
        exact_money(F.col("total_amount")).alias("total_amount_idr"),
        F.col("items").alias("items_jsonb"),
        VERSION,
        *[part_column(rows, name).alias(name) for name in PART_FIELDS],
    )
