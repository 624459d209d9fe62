import hashlib
import json
from collections import Counter
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lumbung.operators.unnest import explode_items
from lumbung.plans.customers import int_customer_metrics
from lumbung.plans.line_items import int_order_items, line_item_layer
from lumbung.plans.products import product_sales_metrics
from lumbung.plans.sales import fact_order_items, fct_daily_sales
from lumbung.plans.staging import stg_customers, stg_orders, stg_products


def item(product="P1", qty=2, unit_price=1000, discount=0, **more):
    return {"product_id": product, "qty": qty, "unit_price": unit_price, "discount": discount, **more}


@pytest.fixture(scope="module")
def layer(raw_customers, raw_products, raw_orders):
    def build(*orders):
        return line_item_layer(
            stg_orders(raw_orders(*[(k, {**o, "items": json.dumps(o.get("items", []))}) for k, o in orders])),
            stg_products(raw_products(("P1", {}), ("P2", {"category": "Buku", "price": "500", "cost": "0"}))),
            stg_customers(raw_customers(("C1", {}), ("C2", {}))),
        )

    return build


def only(frame):
    rows = frame.collect()
    assert len(rows) == 1
    return rows[0]


def test_line_amounts(layer):
    row = only(int_order_items(layer(("O1", {"items": [item(qty=3, unit_price=1000, discount=100.5)]}))))
    assert (row.gross_revenue_idr, row.cogs_idr, row.gross_profit_idr) == (
        Decimal("2698.5"), Decimal("1800"), Decimal("898.5"),
    )
    assert row.order_item_id == hashlib.md5(b"O1-1").hexdigest()
    assert (row.product_name, row.category) == ("Kopi", "Makanan")


@pytest.mark.parametrize("qty", [-3, 0, None])
def test_quantities_below_one_count_as_one(layer, qty):
    row = only(layer(("O1", {"items": [item(qty=qty)]})))
    assert (row.qty, row.gross_revenue_idr) == (1, Decimal(1000))


def test_missing_price_takes_the_catalogue_price(layer):
    row = only(layer(("O1", {"items": [item(unit_price=None, qty=1)]})))
    assert row.unit_price_idr == Decimal(1000)


def test_zero_price_stays_zero(layer):
    frame = layer(("O1", {"items": [item(unit_price=0, discount=50, qty=2)]}))
    row = only(frame)
    assert (row.unit_price_idr, row.gross_revenue_idr, row.gross_profit_idr) == (0, 0, Decimal(-1200))
    assert only(fact_order_items(frame)).profit_margin_percentage is None


def test_discount_above_price_gives_no_revenue_but_counts_as_discount(layer):
    frame = layer(("O1", {"items": [item(unit_price=5000, discount=20000, qty=2)]}))
    assert only(frame).gross_revenue_idr == 0
    assert only(fct_daily_sales(frame)).total_discount_idr == Decimal(40000)


def test_unknown_product(layer):
    rows = layer(("O1", {"items": [item("P9", unit_price=None, qty=4)]}), ("O2", {"items": [item("P9", qty=1)]})).collect()
    by_order = {r.order_id: r for r in rows}
    assert (by_order["O1"].category, by_order["O1"].unit_price_idr, by_order["O1"].cogs_idr) == (None, 0, 0)
    assert by_order["O2"].gross_profit_idr == Decimal(1000)


@pytest.mark.parametrize("items", ["[]", None, "null", " null "])
def test_orders_without_items_have_no_lines(raw_orders, raw_products, raw_customers, items):
    frame = line_item_layer(
        stg_orders(raw_orders(("O1", {"items": items}))),
        stg_products(raw_products(("P1", {}))),
        stg_customers(raw_customers(("C1", {}))),
    )
    assert frame.count() == 0


@pytest.mark.parametrize(
    "text",
    [
        '[{"product_id":"P1","qty":2.5}]',
        '[{"product_id":"P1","qty":"two"}]',
        '[{"product_id":"P1","qty":99999999999}]',
        '[{"product_id":"P1","unit_price":"free"}]',
        '[1, 2]',
        "not json",
    ],
)
def test_malformed_items_fail(raw_orders, raw_products, raw_customers, text):
    frame = line_item_layer(
        stg_orders(raw_orders(("O1", {"items": text}))),
        stg_products(raw_products(("P1", {}))),
        stg_customers(raw_customers(("C1", {}))),
    )
    with pytest.raises(Exception, match="CAST_OVERFLOW|MALFORMED_RECORD|not a whole number"):
        frame.collect()


def test_numbers_spelled_as_text_are_numbers(layer):
    row = only(layer(("O1", {"items": [item(qty="3", unit_price="10.5")]})))
    assert (row.qty, row.gross_revenue_idr) == (3, Decimal("31.5"))


def test_numbering_does_not_depend_on_document_order(layer):
    items = [item("P2", 5), item("P1", 2), item(None, 1), item("P1", 1), item("P1", 1, unit_price=None)]
    views = [
        [
            (r.line_no, r.product_id, r.qty, r.unit_price_idr)
            for r in sorted(layer(("O1", {"items": order})).collect(), key=lambda r: r.line_no)
        ]
        for order in (items, items[::-1])
    ]
    assert views[0] == views[1]
    assert [(n, p) for n, p, _, _ in views[0]] == [(1, "P1"), (2, "P1"), (3, "P1"), (4, "P2"), (5, None)]


def test_duplicate_documents_do_not_double_lines(layer):
    assert layer(("O1", {"items": [item()]}), ("O1", {"items": [item()]})).count() == 1


def test_guests_map_to_the_unknown_member(layer):
    fact = fact_order_items(
        layer(("O1", {"items": [item()]}), ("O2", {"customer_id": "X9", "items": [item()]}),
              ("O3", {"customer_id": None, "items": [item()]}))
    )
    got = {r.order_id: (r.customer_id, r.raw_customer_id, r.is_registered_customer) for r in fact.collect()}
    assert got == {"O1": ("C1", "C1", True), "O2": ("UNKNOWN", "X9", False), "O3": ("UNKNOWN", None, False)}


def test_daily_key(layer):
    rows = fct_daily_sales(
        layer(("O1", {"items": [item("P9")]}), ("O2", {"payment_method": None, "items": [item()]}))
    ).collect()
    keys = {r.category: r.daily_sales_id for r in rows}
    assert keys[None] == hashlib.md5(b"2026-09-03-None-cod-website").hexdigest()
    assert keys["Makanan"] is None


@pytest.mark.parametrize(
    ("part", "whole", "expected"),
    [
        ("12.345", "100", "12.35"),  # an exact tie goes away from zero
        ("-12.345", "100", "-12.35"),
        ("1.005", "100", "1.01"),  # 1.00 in floating point
        ("2", "3", "66.67"),
        ("5", "0", None),
        (None, "5", None),
    ],
)
def test_percentages_are_exact(spark, part, whole, expected):
    from pyspark.sql import functions as F

    from lumbung.functions.amounts import as_money, percent

    value = spark.range(1).select(percent(as_money(F.lit(part)), as_money(F.lit(whole))).alias("p")).first().p
    assert value == (None if expected is None else Decimal(expected))


def test_every_document_is_parsed_once(layer):
    plan = layer(("O1", {"items": [item()]}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_numbering_needs_no_window(layer):
    plan = layer(("O1", {"items": [item()]}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 3  # the three deduplications


def test_order_counts_need_no_distinct(layer):
    frame = layer(("O1", {"items": [item()]}))
    for counted in (int_customer_metrics(frame), product_sales_metrics(frame), fct_daily_sales(frame)):
        assert "Expand" not in counted._jdf.queryExecution().executedPlan().toString()


LINES = st.lists(
    st.tuples(st.sampled_from(["P1", "P2", "P9", None]), st.sampled_from([-1, 1, 2, None]), st.sampled_from([0, 10, None])),
    max_size=6,
)
ORDERS = st.lists(
    st.tuples(st.sampled_from(["C1", "C2", "X1", None]), st.sampled_from(["completed", "cancelled", "pending", None]), LINES),
    min_size=1, max_size=8,
)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(ORDERS)
def test_counts_against_brute_force(layer, orders):
    """Marker-based and two-step counts equal distinct counts over plain Python sets."""
    documents = [
        (f"O{i}", {"customer_id": c, "status": s, "items": [item(p, q, price) for p, q, price in lines]})
        for i, (c, s, lines) in enumerate(orders)
    ]
    frame = layer(*documents)
    category = {"P1": "Makanan", "P2": "Buku"}

    customers, products, groups = {}, {}, {}
    units = Counter()
    for key, order in documents:
        for line in order["items"]:
            qty = max(line["qty"] or 1, 1)
            customers.setdefault(order["customer_id"], set()).add((key, order["status"] == "completed"))
            groups.setdefault(category.get(line["product_id"]), set()).add((key, order["status"]))
            units[category.get(line["product_id"])] += qty
            if order["status"] == "completed":
                products.setdefault(line["product_id"], set()).add(key)

    got = {r.customer_id: (r.total_orders, r.total_completed_orders) for r in int_customer_metrics(frame).collect()}
    assert got == {c: (len(o), sum(done for _, done in o)) for c, o in customers.items()}
    assert {r.product_id: r.total_orders for r in product_sales_metrics(frame).collect()} == {
        p: len(o) for p, o in products.items()
    }
    daily = {
        r.category: (r.total_orders, r.completed_orders, r.cancelled_orders, r.total_units_sold)
        for r in fct_daily_sales(frame).collect()
    }
    assert daily == {
        c: (len(o), sum(s == "completed" for _, s in o), sum(s == "cancelled" for _, s in o), units[c])
        for c, o in groups.items()
    }


def test_public_columns(layer):
    assert "line_no" not in int_order_items(layer(("O1", {}))).columns
    assert len(int_order_items(layer(("O1", {}))).columns) == 17


@pytest.mark.parametrize(
    ("item", "message"),
    [
        ('{"product_id": "P1", "qty": 1, "unit_price": 1.00005}', "more than four decimals"),
        ('{"product_id": "P1", "qty": 1, "unit_price": 1, "discount": 0.00001}', "more than four decimals"),
        ('{"product_id": "P1", "qty": 1.00001, "unit_price": 1}', "not a whole number"),
    ],
)
def test_numbers_that_do_not_fit_are_never_rounded(spark, item, message):
    orders = spark.createDataFrame([("O1", f"[{item}]")], "order_id string, items_jsonb string")
    with pytest.raises(Exception, match=message):
        explode_items(orders).collect()
