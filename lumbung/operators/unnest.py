"""Nested order documents to numbered lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.constants import PART_FIELDS
from lumbung.functions.amounts import exact_money
from lumbung.schemas import ITEMS


def whole_number(value: Column) -> Column:
    """A decimal as an integer; a fraction fails the query."""
    number = value.cast("int")
    return F.when(number != value, F.raise_error(F.concat(F.lit("not a whole number: "), value.cast("string")))).otherwise(
        number
    )


def parse_items(items: Column) -> Column:
    """JSON text to an array of typed items, in line order.

    Line order is by product (missing products last), then by the remaining
    fields, so it does not depend on how the document happened to be written.
    Malformed JSON, malformed numbers, amounts with more than four decimals and
    fractions of a piece fail the query.
    """
    text = F.when(F.trim(items) != F.lit("null"), items)
    typed = F.transform(
        F.from_json(text, ITEMS, {"mode": "FAILFAST"}),
        lambda item: F.struct(
            item["product_id"].isNull().alias("without_product"),
            item["product_id"].alias("product_id"),
            whole_number(item["qty"]).alias("qty"),
            exact_money(item["unit_price"]).alias("unit_price"),
            exact_money(item["discount"]).alias("discount"),
            exact_money(item["subtotal"]).alias("subtotal"),
        ),
    )
    return F.sort_array(typed)


def items_checksum(items: Column) -> Column:
    """A number for the items of a document that does not depend on their order; checksums of parts add up."""
    fields = ("product_id", "qty", "unit_price", "discount", "subtotal")

    def of_one(item: Column) -> Column:
        text = F.concat_ws("|", *[F.coalesce(item[f].cast("string"), F.lit("")) for f in fields])
        return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")

    return F.aggregate(parse_items(items), F.lit(0).cast("long"), lambda total, item: total + of_one(item))


def explode_items(orders: DataFrame, items: str = "items_jsonb") -> DataFrame:
    """One row per item; orders without items disappear.

    Numbering happens while the document is still one row, so it needs neither
    a window nor a shuffle. Two helpers are added for later order counts:
    ``line_no`` is 1 on exactly one line of each order, and ``opens_product`` is
    true on exactly one line of each (order, product) pair. Counting those
    lines equals counting distinct orders.

    A document may be one part of an order. Numbers go on where the part before
    it ends, and its first line opens a product only if that part ended with
    another, so the lines do not depend on how an order was cut.
    """
    carried = [c for c in orders.columns if c not in (items, *PART_FIELDS)]
    parts = [part_column(orders, name).alias(f"_{name}") for name in PART_FIELDS if name != "part"]
    sorted_items = orders.select(*carried, *parts, parse_items(F.col(items)).alias("_items"))
    number = F.coalesce("_lines_before", F.lit(0))

    def with_marker(item: Column, position: Column) -> Column:
        before = F.when(position == 0, F.col("_product_before")).otherwise(
            F.get(F.col("_items"), position - 1)["product_id"]
        )
        return F.struct(
            item["product_id"].alias("product_id"),
            item["qty"].alias("qty"),
            item["unit_price"].alias("unit_price"),
            item["discount"].alias("discount"),
            item["subtotal"].alias("subtotal"),
            ((position + number == 0) | ~item["product_id"].eqNullSafe(before)).alias("opens_product"),
        )

    # The generator takes an expression, not a column: a column would make Spark derive a
    # "not empty" filter below and parse every document twice.
    lines = sorted_items.select(
        *carried, number.alias("_number"), F.posexplode(F.transform(F.col("_items"), with_marker)).alias("_position", "_line")
    )
    return lines.select(*carried, (F.col("_number") + F.col("_position") + 1).cast("int").alias("line_no"), "_line.*")


def part_column(documents: DataFrame, name: str) -> Column:
    """A column of documents that hold parts of orders; null where documents have no such column."""
    kind = PART_FIELDS[name]
    return F.col(name).cast(kind) if name in documents.columns else F.lit(None).cast(kind)
