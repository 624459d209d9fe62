import json
from datetime import date, datetime
from decimal import Decimal

import pytest

from lumbung.plans import customers, line_items, products, quality, reports, sales, staging
from lumbung.plans.customers import customer_tier
from lumbung.plans.products import stock_status
from lumbung.sources.tables import settle

AS_OF = date(2026, 9, 10)


def line(product, qty, price, discount=0):
    return {"product_id": product, "qty": qty, "unit_price": price, "discount": discount}


@pytest.fixture(scope="module")
def marts(raw_customers, raw_products, raw_orders):
    """A small shop: two customers, one of them without orders, and a guest."""
    clean_customers = staging.stg_customers(raw_customers(("C1", {}), ("C2", {})))
    clean_products = staging.stg_products(
        raw_products(
            ("P1", {}),
            ("P2", {"category": "Buku", "stock_qty": "0", "product_name": "Novel", "sku": "bk-7"}),
            ("P3", {"stock_qty": "-2", "price": "0", "is_active": "False"}),
        )
    )
    orders = [
        ("O1", {"items": [line("P1", 2, 3_000_000), line("P2", 1, 100)]}),
        ("O2", {"status": "cancelled", "channel": "kiosk", "items": [line("P1", 1, 1000)]}),
        ("O3", {"customer_id": "G7", "order_date": "2026-09-04T00:00:00+00:00", "items": [line("P1", 1, 2000)]}),
    ]
    layer = line_items.line_item_layer(
        staging.stg_orders(raw_orders(*[(k, {**o, "items": json.dumps(o["items"])}) for k, o in orders])),
        clean_products,
        clean_customers,
    )
    layer = settle(layer, "line_items")
    built = {
        "line_items": layer,
        "dim_customers": customers.dim_customers(clean_customers, customers.int_customer_metrics(layer)),
        "dim_products": products.dim_products(clean_products, products.product_sales_metrics(layer)),
        "fact_order_items": sales.fact_order_items(layer),
        "fct_daily_sales": sales.fct_daily_sales(layer),
    }
    return {name: settle(frame, name) for name, frame in built.items()}


@pytest.mark.parametrize(
    ("spend", "tier"),
    [
        (0, "No Purchases"), (-1, "No Purchases"), (1, "Bronze"), (4_999_999, "Bronze"), (5_000_000, "Silver"),
        (19_999_999, "Silver"), (20_000_000, "Gold"), (50_000_000, "Platinum"),
    ],
)
def test_tiers(spark, spend, tier):
    frame = spark.createDataFrame([(spend,)], "s long")
    assert frame.select(customer_tier(frame.s).alias("t")).first().t == tier


@pytest.mark.parametrize(("stock", "label"), [(0, "Out of Stock"), (1, "Low Stock"), (19, "Low Stock"), (20, "Healthy")])
def test_stock_labels(spark, stock, label):
    frame = spark.createDataFrame([(stock,)], "s int")
    assert frame.select(stock_status(frame.s).alias("t")).first().t == label


def test_customer_dimension(marts):
    rows = {r.customer_id: r for r in marts["dim_customers"].collect()}
    assert set(rows) == {"C1", "C2", "UNKNOWN"}
    assert (rows["C1"].total_orders, rows["C1"].total_completed_orders, rows["C1"].customer_tier) == (2, 1, "Silver")
    assert (rows["C2"].total_orders, rows["C2"].lifetime_net_spend_idr, rows["C2"].customer_tier) == (0, 0, "No Purchases")
    unknown = rows["UNKNOWN"]
    assert (unknown.is_registered_in_crm, unknown.customer_tier, unknown.lifetime_gross_spend_idr, unknown.email) == (
        False, "Guest / Unregistered", 0, None,
    )
    assert len(marts["dim_customers"].columns) == 18


def test_product_dimension(marts):
    rows = {r.product_id: r for r in marts["dim_products"].collect()}
    assert (rows["P1"].total_completed_orders, rows["P1"].total_units_sold) == (2, 3)
    assert (rows["P1"].margin_percentage, rows["P3"].margin_percentage) == (Decimal("40.00"), None)
    assert (rows["P2"].stock_status, rows["P3"].stock_status, rows["P3"].total_revenue_generated_idr) == (
        "Out of Stock", "Out of Stock", 0,
    )


def test_fact_needs_no_shuffle_of_its_own(marts):
    assert "Exchange" not in sales.fact_order_items(marts["line_items"])._jdf.queryExecution().executedPlan().toString()


def test_reconciliation(marts):
    row = reports.revenue_reconciliation(marts["line_items"], marts["fact_order_items"]).first()
    assert row.is_reconciled and row.fact_revenue == Decimal(6_003_100) and row.guest_revenue == Decimal(2000)


def test_guest_audit(marts):
    rows = {r.is_registered_customer: r for r in reports.guest_audit(marts["fact_order_items"]).collect()}
    assert (rows[True].total_items, rows[False].total_items) == (3, 1)
    assert (rows[True].percentage, rows[False].percentage) == (Decimal("99.97"), Decimal("0.03"))


def test_order_counts_are_not_additive_over_categories(marts):
    kpi = reports.kpi_summary(marts["fct_daily_sales"], marts["fact_order_items"], marts["dim_customers"], marts["dim_products"])
    row = kpi.first()
    assert (row.total_orders, row.registered_customers_count, row.active_products_count) == (4, 2, 2)
    assert row.preserved_guest_revenue == Decimal(2000)
    assert reports.kpi_exact_orders(marts["fact_order_items"]).first().total_orders == 3


def test_filters(marts):
    daily, fact = marts["fct_daily_sales"], marts["fact_order_items"]
    filtered = reports.kpi_filtered(daily, fact, marts["dim_customers"], marts["dim_products"], category="Buku")
    assert filtered.first().total_gross_revenue == Decimal(100)
    nothing = reports.kpi_filtered(daily, fact, marts["dim_customers"], marts["dim_products"], category="none").first()
    assert (nothing.total_gross_revenue, nothing.overall_net_margin_percentage, nothing.preserved_guest_revenue) == (0, 0, 0)
    exact = reports.guest_revenue_exact(fact, marts["dim_products"], "Makanan").first()
    assert exact.preserved_guest_revenue == Decimal(2000)
    assert reports.fulfillment_rate(daily).first().fulfillment_rate == Decimal("75.0")


def test_trend_is_sorted(marts):
    rows = reports.daily_trend(marts["fct_daily_sales"]).collect()
    assert [str(r.order_date) for r in rows] == ["2026-09-03", "2026-09-04"]


def test_channel_labels(marts):
    rows = reports.channel_share(marts["fct_daily_sales"]).collect()
    assert [(r.channel, r.label) for r in rows] == [("website", "Website"), ("kiosk", "kiosk")]
    assert sum(r.percentage for r in rows) == Decimal("100.0")


@pytest.mark.parametrize(
    ("sort_by", "first"), [("revenue", "P1"), ("margin", "P1"), ("units", "P1")],
)
def test_ranking(marts, sort_by, first):
    rows = reports.product_ranking(marts["dim_products"], sort_by).collect()
    assert rows[0].product_id == first and rows[-1].product_id == "P3"


@pytest.mark.parametrize(("term", "found"), [("NOV", {"P2"}), ("buk", {"P2"}), ("BK-", {"P2"}), ("", {"P1", "P2", "P3"}), ("xyz", set())])
def test_inventory_search(marts, term, found):
    assert {r.product_id for r in reports.inventory_search(marts["dim_products"], term).collect()} == found


def test_inventory_category_filter(marts):
    rows = reports.inventory_search(marts["dim_products"], "", category="Makanan").collect()
    assert {r.product_id for r in rows} == {"P1", "P3"}


def test_export_has_all_sections(spark, marts, tmp_path):
    schemas = reports.export_json(marts, quality.mart_report(marts, AS_OF), str(tmp_path), datetime(2026, 9, 10))
    read = {name: spark.read.schema(s).json(f"{tmp_path}/{name}") for name, s in schemas.items()}
    assert set(read) == {
        "generated", "summary", "run_metadata", "daily_sales", "products", "customer_tiers", "kimball_audit",
    }
    assert read["daily_sales"].count() == 4
    assert read["run_metadata"].first().tests_passed == 19
    labels = {r.is_registered_customer: r.label for r in read["kimball_audit"].collect()}
    assert labels[True].startswith("Registered") and labels[False].startswith("Guest")


# ---------------------------------------------------------------- data tests


def test_clean_marts_pass(marts):
    report = quality.mart_report(marts, AS_OF).collect()
    assert len(report) == 19 and all(r.passed for r in report)


def planted(spark, marts, table, **values):
    """The mart with one more row, a copy of its first row with ``values`` changed."""
    frame = marts[table]
    row = frame.first().asDict() | values
    return {**marts, table: frame.union(spark.createDataFrame([tuple(row[c] for c in frame.columns)], frame.schema))}


@pytest.mark.parametrize(
    ("table", "values", "failed"),
    [
        ("dim_customers", {"customer_id": None}, "not_null on dim_customers.customer_id"),
        ("dim_customers", {}, "unique on dim_customers.customer_id"),
        ("dim_products", {"product_id": "P9", "price_idr": None}, "not_null on dim_products.price_idr"),
        ("dim_products", {"product_id": "P9", "stock_qty": -1}, "no_negative_stock on dim_products.stock_qty"),
        ("fact_order_items", {}, "unique on fact_order_items.order_item_id"),
        ("fact_order_items", {"order_item_id": "x", "customer_id": "C9"}, "relationships on fact_order_items.customer_id"),
        ("fact_order_items", {"order_item_id": "x", "product_id": "P9"}, "relationships on fact_order_items.product_id"),
        ("fact_order_items", {"order_item_id": "x", "cogs_idr": Decimal(-1)}, "no_negative_revenue"),
        ("fact_order_items", {"order_item_id": "x", "order_date": date(2026, 9, 12)}, "valid_order_dates"),
        ("fact_order_items", {"order_item_id": "x", "order_date": date(2019, 12, 31)}, "valid_order_dates"),
        ("fct_daily_sales", {"daily_sales_id": None}, "not_null on fct_daily_sales.daily_sales_id"),
    ],
)
def test_planted_violations_stop_the_gate(spark, marts, table, values, failed):
    report = quality.mart_report(planted(spark, marts, table, **values), AS_OF)
    with pytest.raises(quality.QualityGateError, match=f"{failed}.*: 1"):
        quality.require_passed(report)


def test_tomorrow_is_still_accepted(spark, marts):
    frame = planted(spark, marts, "fact_order_items", order_item_id="x", order_date=date(2026, 9, 11))
    quality.require_passed(quality.row_failures(frame, [quality.order_date_test(AS_OF)]).selectExpr("*", "failures = 0 as passed"))


def test_document_violations(raw_orders):
    rows = quality.document_violations(
        raw_orders(
            ("O1", {"status": "returned", "items": '[{"product_id":"P1","qty":"x","unit_price":1}]'}),
            (None, {"items": '[{"qty":1,"unit_price":"y"},{"product_id":"P1"}]'}),
            ("O3", {"status": None, "items": None}),
        )
    ).collect()
    assert {r.target: r.failures for r in rows if r.failures} == {
        "required.order_id": 1, "required.status": 1, "required.items": 1, "enum.status": 1,
        "items.required.product_id": 1, "items.required.qty": 1, "items.required.unit_price": 1,
        "items.type.qty": 1, "items.type.unit_price": 1,
    }


def test_accepted_values(raw_orders):
    rows = quality.status_and_payment_values(
        staging.stg_orders(raw_orders(("O1", {"status": "returned"}), ("O2", {"payment_method": "qris"}), ("O3", {})))
    ).collect()
    assert {r.target: r.failures for r in rows} == {"stg_orders.order_status": 1, "stg_orders.payment_method": 1}


def test_empty_raw_table_fails(raw_customers):
    full = raw_customers(("C1", {}))
    report = quality.raw_counts({"customers": full, "orders": full.limit(0)})
    with pytest.raises(quality.QualityGateError, match="raw.orders"):
        quality.require_passed(report)
