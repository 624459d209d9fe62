"""Data tests. Each yields ``(check, target, failures)``; no failures means passed."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung import constants as C
from lumbung.functions.amounts import count_where
from lumbung.functions.text import has_email_format
from lumbung.operators.watch import Watch
from lumbung.plans.staging import VERSION
from lumbung.schemas import ITEM_TEXT
from lumbung.sources.exports import ROW_SHAPE
from lumbung.sources.tables import settle


OUTCOME = "check string, target string, failures long"


class QualityGateError(RuntimeError):
    """At least one data test failed; nothing was published."""


@dataclass(frozen=True)
class RowTest:
    """Rows of ``table`` that meet ``violation`` are failures."""

    table: str
    check: str
    column: str
    violation: Column


@dataclass(frozen=True)
class UniqueTest:
    """Values of ``column`` that occur more than once are failures; NULLs are left out."""

    table: str
    column: str


@dataclass(frozen=True)
class ParentTest:
    """Rows whose ``column`` has no partner in the parent table are failures; NULLs are left out."""

    table: str
    column: str
    parent: str
    parent_column: str


NOT_NULL = {
    "dim_customers": ("customer_id",),
    "dim_products": ("product_id", "price_idr"),
    "fact_order_items": ("order_item_id", "order_id", "customer_id", "product_id", "qty"),
    "fct_daily_sales": ("daily_sales_id", "order_date"),
}
UNIQUE = (
    UniqueTest("dim_customers", "customer_id"),
    UniqueTest("dim_products", "product_id"),
    UniqueTest("fact_order_items", "order_item_id"),
    UniqueTest("fct_daily_sales", "daily_sales_id"),
)
PARENTS = (
    ParentTest("fact_order_items", "customer_id", "dim_customers", "customer_id"),
    ParentTest("fact_order_items", "product_id", "dim_products", "product_id"),
)


def not_null_tests() -> list[RowTest]:
    return [RowTest(t, "not_null", c, F.col(c).isNull()) for t, columns in NOT_NULL.items() for c in columns]


def negative_revenue_test(table: str = "fact_order_items") -> RowTest:
    violation = (F.col("gross_revenue_idr") < 0) | (F.col("cogs_idr") < 0)
    return RowTest(table, "no_negative_revenue", "gross_revenue_idr", violation)


def order_date_test(as_of: date, table: str = "fact_order_items") -> RowTest:
    """Orders after tomorrow or before the shop existed. ``as_of`` is today, given by the caller."""
    too_late = F.col("order_date") > F.date_add(F.lit(as_of), 1)
    too_early = F.col("order_date") < F.lit(C.EARLIEST_ORDER_DATE).cast("date")
    return RowTest(table, "valid_order_dates", "order_date", too_late | too_early)


def stock_test(table: str = "dim_products") -> RowTest:
    return RowTest(table, "no_negative_stock", "stock_qty", F.col("stock_qty") < 0)


def row_failures(tables: Mapping[str, DataFrame], tests: Iterable[RowTest]) -> DataFrame:
    """All row tests of a table share one scan, which reads only the tested columns."""
    by_table: dict[str, list[RowTest]] = {}
    for test in tests:
        by_table.setdefault(test.table, []).append(test)
    results = []
    for table, group in by_table.items():
        counts = tables[table].agg(*[count_where(t.violation).alias(f"n{i}") for i, t in enumerate(group)])
        rows = F.array(*[outcome(t.check, f"{table}.{t.column}", F.col(f"n{i}")) for i, t in enumerate(group)])
        results.append(counts.select(F.inline(rows)))
    return stack(results)


def row_watches(tests: Iterable[RowTest]) -> dict[str, Watch]:
    """One watch per table that counts the violating rows of its tests while the table is written."""
    counts: dict[str, dict[str, Column]] = {}
    for test in tests:
        counts.setdefault(test.table, {})[metric(test)] = count_where(test.violation)
    return {table: Watch(metrics) for table, metrics in counts.items()}


def metric(test: RowTest) -> str:
    return f"{test.check}:{test.column}"


def written_row_failures(spark: SparkSession, tests: Iterable[RowTest], watches: Mapping[str, Watch]) -> DataFrame:
    """The outcomes of row tests from what was counted while the tables were written; no table is read."""
    found = {table: watch.values for table, watch in watches.items()}
    rows = [(t.check, f"{t.table}.{t.column}", found[t.table].get(metric(t), 0)) for t in tests]
    return spark.createDataFrame(rows, OUTCOME)


def unique_failures(tables: Mapping[str, DataFrame], tests: Iterable[UniqueTest]) -> DataFrame:
    results = []
    for t in tests:
        # Eight bytes of each key are counted first; only keys whose hash repeats are compared as they are. The repeated
        # hashes are written, so that Spark knows their size: a few are sent to the keys, which then stay where they are.
        keys = tables[t.table].filter(F.col(t.column).isNotNull()).select(t.column, F.xxhash64(t.column).alias("hash"))
        again = settle(keys.groupBy("hash").count().filter("count > 1").select("hash"), "repeated_hashes")
        repeated = keys.join(again, "hash", "left_semi").groupBy(t.column).count().filter("count > 1")
        results.append(single("unique", f"{t.table}.{t.column}", repeated.agg(F.count("*").alias("n"))))
    return stack(results)


def parent_failures(tables: Mapping[str, DataFrame], tests: Iterable[ParentTest]) -> DataFrame:
    """Child keys are counted first, so a key with very many rows reaches the join as one row."""
    results = []
    for t in tests:
        keys = (
            tables[t.table].filter(F.col(t.column).isNotNull())
            .groupBy(F.col(t.column).alias("key")).agg(F.count("*").alias("rows"))
        )
        parents = tables[t.parent].select(F.col(t.parent_column).alias("key"))
        orphans = keys.join(parents, "key", "left_anti").agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"))
        results.append(single("relationships", f"{t.table}.{t.column}", orphans))
    return stack(results)


def row_tests(as_of: date) -> list[RowTest]:
    return [*not_null_tests(), negative_revenue_test(), order_date_test(as_of), stock_test()]


def mart_report(marts: Mapping[str, DataFrame], as_of: date, watches: Mapping[str, Watch] | None = None) -> DataFrame:
    """All 19 tests on the four marts, with their verdict.

    With the ``row_watches`` under which the marts were written, the row tests read no mart again.
    """
    spark, tests = marts["fact_order_items"].sparkSession, row_tests(as_of)
    by_row = written_row_failures(spark, tests, watches) if watches else row_failures(marts, tests)
    outcomes = stack([by_row, unique_failures(marts, UNIQUE), parent_failures(marts, PARENTS)])
    return outcomes.withColumn("passed", F.col("failures") == 0)


# What identifies a violating row, besides the tested columns.
ROW_COLUMNS = {
    "no_negative_revenue": ("order_item_id", "order_id", "product_id", "qty", "gross_revenue_idr", "cogs_idr"),
    "valid_order_dates": ("order_item_id", "order_id", "order_date"),
    "no_negative_stock": ("product_id", "sku", "product_name", "stock_qty"),
}


def violating_rows(tables: Mapping[str, DataFrame], test: RowTest | UniqueTest | ParentTest) -> DataFrame:
    """The rows that a failed test has counted (for repeated and orphaned keys: the key and its number of rows)."""
    table = tables[test.table]
    if isinstance(test, RowTest):
        named = [c for c in ROW_COLUMNS.get(test.check, table.columns) if c in table.columns]
        return table.filter(test.violation).select(*named)
    rows = table.filter(F.col(test.column).isNotNull()).groupBy(test.column).agg(F.count("*").alias("n_rows"))
    if isinstance(test, UniqueTest):
        return rows.filter("n_rows > 1")
    parents = tables[test.parent].select(F.col(test.parent_column).alias(test.column))
    return rows.join(parents, test.column, "left_anti")


def mart_tests(as_of: date) -> dict[tuple[str, str], RowTest | UniqueTest | ParentTest]:
    """All 19 tests by the check and the target of their outcome."""
    return (
        {(t.check, f"{t.table}.{t.column}"): t for t in row_tests(as_of)}
        | {("unique", f"{t.table}.{t.column}"): t for t in UNIQUE}
        | {("relationships", f"{t.table}.{t.column}"): t for t in PARENTS}
    )


def write_violations(marts: Mapping[str, DataFrame], report: DataFrame, as_of: date, folder: str) -> None:
    """The violating rows of every failed test as JSON lines below ``folder``, one folder per test."""
    tests = mart_tests(as_of)
    for failed in report.filter(~F.col("passed")).collect():  # one row per test
        rows = violating_rows(marts, tests[failed["check"], failed["target"]])
        rows.write.mode("overwrite").json(f"{folder}/{failed['check']}-{failed['target']}")


def require_passed(report: DataFrame) -> None:
    """Stop when a test failed. The report has one row per test, so reading it here is safe."""
    failed = report.filter(~F.col("passed")).collect()
    if failed:
        listed = ", ".join(sorted(f"{r['check']} on {r['target']}: {r['failures']}" for r in failed))
        raise QualityGateError(listed)


def raw_watches(exports: Iterable[str], documents: Iterable[str]) -> dict[str, Watch]:
    """What a load counts while it writes the raw tables: rows, and rows of exports with too few or too many values."""
    rows = {"rows": F.count(F.lit(1))}
    ragged = {f"{shape}_rows": count_where(F.col(ROW_SHAPE) == shape) for shape in ("short", "long")}
    return {name: Watch(rows | ragged) for name in exports} | {name: Watch(rows) for name in documents}


def load_report(spark: SparkSession, watches: Mapping[str, Watch]) -> DataFrame:
    """``raw_counts`` from what was counted while the raw tables were written.

    Rows of the wrong length are loaded; they are reported with their number and don't stop a run.
    """
    outcomes = []
    for name, watch in watches.items():
        found = watch.values
        rows = found.get("rows", 0)
        outcomes.append(("non_empty", f"raw.{name}", rows, int(rows == 0), rows > 0))
        outcomes += [(m, f"raw.{name}", rows, found.get(m, 0), True) for m in watch.metrics if m != "rows"]
    return spark.createDataFrame(outcomes, "check string, target string, rows long, failures long, passed boolean")


def raw_counts(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of the raw tables; an empty one is a failure."""
    counted = [
        frame.agg(F.count("*").alias("rows")).select(
            F.lit("non_empty").alias("check"),
            F.lit(f"raw.{name}").alias("target"),
            "rows",
            F.when(F.col("rows") == 0, F.lit(1)).otherwise(F.lit(0)).cast("long").alias("failures"),
        )
        for name, frame in raw.items()
    ]
    return stack(counted).withColumn("passed", F.col("failures") == 0)


def document_violations(raw_orders: DataFrame) -> DataFrame:
    """What a validator in warn mode would report per rule; the documents themselves are kept.

    Numbers in items are checked as text: anything that is not a number of the
    required kind counts, so bad quantities are visible before a cast fails.
    """
    items = F.from_json("items", ITEM_TEXT)

    def any_item(bad) -> Column:
        return F.coalesce(F.exists(F.col("parsed"), bad), F.lit(False))

    def no_number(field: str):
        return lambda item: item[field].isNotNull() & item[field].try_cast("double").isNull()

    rules = {
        "required.order_id": F.col("order_id").isNull(),
        "required.customer_id": F.col("customer_id").isNull(),
        "required.order_date": F.col("order_date").isNull(),
        "required.status": F.col("status").isNull(),
        "required.items": F.col("parsed").isNull(),
        "enum.status": F.col("status").isNotNull() & ~F.col("status").isin(*C.ORDER_STATUSES),
        "items.required.product_id": any_item(lambda item: item["product_id"].isNull()),
        "items.required.qty": any_item(lambda item: item["qty"].isNull()),
        "items.required.unit_price": any_item(lambda item: item["unit_price"].isNull()),
        "items.type.qty": any_item(lambda item: item["qty"].isNotNull() & item["qty"].try_cast("int").isNull()),
        "items.type.unit_price": any_item(no_number("unit_price")),
        "items.type.discount": any_item(no_number("discount")),
    }
    names = list(rules)
    part = F.coalesce("part", F.lit(0)) if "part" in raw_orders.columns else F.lit(0)
    load = VERSION if VERSION in raw_orders.columns else F.lit(None).alias(VERSION)
    flags = [F.coalesce(rule, F.lit(False)).alias(f"f{i}") for i, rule in enumerate(rules.values())]
    judged = raw_orders.withColumn("parsed", items).select("order_id", load, part.alias("part"), *flags)
    first = judged.filter("part = 0")
    counts = first.agg(*[count_where(F.col(f"f{i}")).alias(f"n{i}") for i in range(len(names))])
    if "part" in raw_orders.columns:
        # A document in parts counts once: further parts only add what their first part does not show, for items.
        by_items = [i for i, name in enumerate(names) if name.startswith("items.")]
        keys = ["order_id", VERSION]
        further = judged.filter("part > 0").groupBy(*keys).agg(*[F.bool_or(f"f{i}").alias(f"g{i}") for i in by_items])
        known = first.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(*[F.bool_or(f"f{i}").alias(f"f{i}") for i in by_items])
        both = further.join(known, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left")
        fresh = [count_where(F.col(f"g{i}") & ~F.coalesce(f"f{i}", F.lit(False))).alias(f"m{i}") for i in by_items]
        counts = counts.crossJoin(both.agg(*fresh)).select(
            *[(F.col(f"n{i}") + F.col(f"m{i}") if i in by_items else F.col(f"n{i}")).alias(f"n{i}") for i in range(len(names))]
        )
    rows = F.array(*[outcome("document", name, F.col(f"n{i}")) for i, name in enumerate(names)])
    return counts.select(F.inline(rows))


def dirty_profile(raw_customers: DataFrame, raw_products: DataFrame, raw_orders: DataFrame) -> DataFrame:
    """How much dirt of each known kind the raw tables hold."""
    customers = raw_customers.agg(count_where(~has_email_format("email")).alias("n0"))
    products = raw_products.agg(
        count_where(F.col("price").cast("double") == 0).alias("n0"),
        count_where(F.col("stock_qty").cast("int") < 0).alias("n1"),
    )
    missing_status = raw_orders.agg(count_where(F.col("status").isNull()).alias("n"))
    # Both key profiles count per key first: no key, however frequent, is handled as a list of rows.
    buyers = raw_orders.groupBy(F.trim("customer_id").alias("key")).agg(F.count("*").alias("rows"))
    known = raw_customers.select(F.trim("customer_id").alias("key"))
    orphans = buyers.join(known, "key", "left_anti").agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"))
    order_ids = raw_orders.groupBy(F.trim("order_id").alias("key")).agg(F.count("*").alias("rows"))
    copies = order_ids.agg(F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("n"))
    return stack(
        [
            single("invalid_email", "raw.customers", customers.select(F.col("n0").alias("n"))),
            products.select(
                F.inline(
                    F.array(
                        outcome("zero_price", "raw.products", F.col("n0")),
                        outcome("negative_stock", "raw.products", F.col("n1")),
                    )
                )
            ),
            single("null_status", "raw.orders", missing_status),
            single("orphan_customer", "raw.orders", orphans),
            single("duplicate_order", "raw.orders", copies),
        ]
    )


def accepted_values(frame: DataFrame, table: str, accepted: Mapping[str, tuple[str, ...]]) -> DataFrame:
    """Rows whose value is not on the list; NULLs are left out."""
    tests = [
        RowTest(table, "accepted_values", column, F.col(column).isNotNull() & ~F.col(column).isin(*values))
        for column, values in accepted.items()
    ]
    return row_failures({table: frame}, tests)


def status_and_payment_values(orders: DataFrame, table: str = "stg_orders") -> DataFrame:
    return accepted_values(
        orders, table, {"order_status": C.ORDER_STATUSES, "payment_method": C.PAYMENT_METHODS}
    )


def outcome(check: str, target: str, failures: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"), F.lit(target).alias("target"), failures.cast("long").alias("failures")
    )


def single(check: str, target: str, counted: DataFrame) -> DataFrame:
    """A one-row count, column ``n``, as an outcome."""
    return counted.select(
        F.lit(check).alias("check"), F.lit(target).alias("target"), F.col("n").cast("long").alias("failures")
    )


def stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
