"""Surrogate keys: MD5 over parts joined with a dash; NULL as soon as one part is NULL."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumbung.constants import NO_CATEGORY


def dashed_md5(*parts: Column) -> Column:
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit("-"))
        pieces.append(part.cast("string"))
    return F.md5(F.concat(*pieces))


def order_item_key() -> Column:
    return dashed_md5(F.col("order_id"), F.col("line_no"))


def daily_sales_key() -> Column:
    return dashed_md5(
        F.col("order_date"),
        F.coalesce(F.col("category"), F.lit(NO_CATEGORY)),
        F.col("payment_method"),
        F.col("channel"),
    )
