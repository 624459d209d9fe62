"""The daily run: landing area to published marts."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date, datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from lumbung.constants import CUSTOMER_EXPORT, ORDER_COLLECTION, PRODUCT_EXPORT
from lumbung.operators.watch import Watch
from lumbung.plans import customers, line_items, products, quality, reports, sales, staging
from lumbung.session import prepare, size_shuffles
from lumbung.sources import exports, landing
from lumbung.sources.tables import log_failure, publish, refresh, remove, retire, run_folder, settle, table_path, together

PUBLISHED = "published"
STEPS = "steps"
LAYER = "line_items"
RAW = (("customers", "products"), ("orders",))
SKIPPED = "skipped"


@dataclass(frozen=True)
class Outcome:
    status: str
    run_id: str | None = None


def mart_watches(as_of: date) -> dict[str, Watch]:
    """What the run counts while it writes: the row tests of the marts, and revenue for the reconciliation."""
    watches = quality.row_watches(quality.row_tests(as_of))
    watches["fact_order_items"].metrics |= reports.fact_sums()
    return watches | {LAYER: Watch(reports.line_sums())}


def build_marts(
    raw: Mapping[str, DataFrame],
    folder: str,
    watches: Mapping[str, Watch] | None = None,
    place: Callable[[str], str] | None = None,
) -> dict[str, DataFrame]:
    """Raw tables to four mart tables, below ``folder`` or where ``place`` says.

    Clean customers, clean products and line items are written once each, below
    ``folder``/steps, because several marts read them; every mart then reads only
    the columns it needs. Each mart is handed back as read from its table. ``watches``
    go along with the writes of the tables they are named after.
    """
    watching = (watches or {}).get
    place = place or (lambda name: f"{folder}/{name}")
    spark = raw["orders"].sparkSession
    steps = f"{folder}/{STEPS}"
    clean = together(
        spark,
        {
            "customers": lambda: settle(staging.stg_customers(raw["customers"]), "stg_customers", steps),
            "products": lambda: settle(staging.stg_products(raw["products"]), "stg_products", steps),
        },
    )
    clean_orders = staging.stg_orders(raw["orders"])
    lines = line_items.line_item_layer(clean_orders, clean["products"], clean["customers"])
    layer = settle(lines, LAYER, steps, watching(LAYER))
    metrics = customers.int_customer_metrics(layer)
    sold = products.product_sales_metrics(layer)
    return together(
        spark,
        {
            "dim_customers": lambda: refresh(
                customers.dim_customers(clean["customers"], metrics), place("dim_customers"), watch=watching("dim_customers")
            ),
            "dim_products": lambda: refresh(
                products.dim_products(clean["products"], sold), place("dim_products"), watch=watching("dim_products")
            ),
            # Sorted by date over files, a hot day by order: reads of some days skip the other files.
            "fact_order_items": lambda: refresh(
                sales.fact_order_items(layer), place("fact_order_items"), "order_date", "order_id",
                watch=watching("fact_order_items"),
            ),
            "fct_daily_sales": lambda: refresh(
                sales.fct_daily_sales(layer), place("fct_daily_sales"), "order_date", watch=watching("fct_daily_sales")
            ),
        },
    )


def load_raw(
    spark: SparkSession,
    landing_root: str,
    folder: str,
    loaded_at: datetime,
    watches: Mapping[str, Watch] | None = None,
    multiline: bool = True,
) -> dict[str, DataFrame] | None:
    """Newest exports and all order documents into raw tables below ``folder``.

    Every run has a folder of its own, so a load that fails half-way leaves
    those of earlier runs as they are. None when an export is missing or empty: there is nothing to run on.
    """
    newest = [landing.newest_export(spark, f"{landing_root}/{d}", d) for d in (CUSTOMER_EXPORT, PRODUCT_EXPORT)]
    if not all(export and export[1] for export in newest):
        return None
    size_shuffles(spark, landing.stored_bytes(spark, f"{landing_root}/{ORDER_COLLECTION}"))
    (customers_name, _), (products_name, _) = newest
    read = {
        "customers": exports.read_customers(spark, f"{landing_root}/{CUSTOMER_EXPORT}", customers_name, loaded_at, multiline),
        "products": exports.read_products(spark, f"{landing_root}/{PRODUCT_EXPORT}", products_name, loaded_at, multiline),
        "orders": exports.read_orders(spark, f"{landing_root}/{ORDER_COLLECTION}", loaded_at),
    }
    return together(
        spark,
        {
            name: partial(refresh, frame, f"{folder}/raw/{name}", watch=(watches or {}).get(name))
            for name, frame in read.items()
        },
    )


def run(
    spark: SparkSession,
    landing_root: str,
    warehouse: str,
    as_of: date,
    loaded_at: datetime,
    multiline: bool = True,
    keep_runs: int | None = None,
) -> Outcome:
    """One full refresh. Marts become visible only after all data tests have passed.

    Without ``multiline`` exports are read in splits, for files without line breaks
    inside quotes. With ``keep_runs`` so many published runs stay, this one
    included, and older ones are removed after publication.

    Below the run's folder lie its raw tables, the counts of the load
    (``load_report``), the validator's warnings about documents
    (``document_warnings``), the test outcomes (``dq_report``),
    the reconciliation of revenue (``reconciliation``) and a summary
    (``run_summary``). If tests fail, ``violations`` has the rows. Rows are counted
    and revenue is summed by the jobs that write the tables. The marts are partitions
    of one table each (``tables.table_path``). Intermediate tables go after publication.
    """
    prepare(spark)
    run_id = f"{loaded_at:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    folder = run_folder(warehouse, run_id)
    counted, watched = quality.raw_watches(*RAW), mart_watches(as_of)
    raw = load_raw(spark, landing_root, folder, loaded_at, counted, multiline)
    if raw is None:
        return Outcome(SKIPPED)
    loaded = refresh(quality.load_report(spark, counted), f"{folder}/load_report")
    stop_if_failed(spark, warehouse, run_id, loaded, loaded_at)
    refresh(quality.document_violations(raw["orders"]), f"{folder}/document_warnings")
    marts = build_marts(raw, folder, watched, partial(table_path, warehouse, run_id))
    lines = watched.pop(LAYER)
    refresh(reports.written_reconciliation(spark, lines, watched["fact_order_items"]), f"{folder}/reconciliation")
    report = refresh(quality.mart_report(marts, as_of, watched), f"{folder}/dq_report")
    quality.write_violations(marts, report, as_of, f"{folder}/violations")
    stop_if_failed(spark, warehouse, run_id, report, loaded_at)
    summary = reports.run_summary(
        marts["dim_customers"], marts["dim_products"], marts["fact_order_items"], marts["fct_daily_sales"]
    )
    refresh(summary, f"{folder}/run_summary")
    publish(spark, warehouse, run_id, loaded_at.isoformat())
    remove(spark, f"{folder}/{STEPS}")
    if keep_runs:
        retire(spark, warehouse, keep_runs)
    return Outcome(PUBLISHED, run_id)


def stop_if_failed(spark: SparkSession, warehouse: str, run_id: str, report: DataFrame, loaded_at: datetime) -> None:
    """End a run whose report has failures; the log of failures lets a later run remove its folder."""
    try:
        quality.require_passed(report)
    except quality.QualityGateError:
        log_failure(spark, warehouse, run_id, loaded_at.isoformat())
        raise
