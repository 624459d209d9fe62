import pytest

from lumbung.functions.text import has_email_format
from lumbung.operators.latest import latest_by
from lumbung.plans.staging import stg_customers, stg_orders, stg_products
from tests.conftest import NEW, OLD


@pytest.mark.parametrize(
    ("email", "valid"),
    [
        ("budi.santoso@gmail.com", True),
        ("dewi_a@startup.co.id", True),
        ("user.name+tag@domain.org", True),
        ("   budi@gmail.com", True),
        ("BUDI@GMAIL.COM", True),
        ("budi@@gmail.com", False),
        ("budi_tanpa_at.com", False),
        ("budi@domain", False),
        ("budi@gmail.com\n", False),
        ("", False),
        (None, False),
    ],
)
def test_email_format(spark, email, valid):
    frame = spark.createDataFrame([(email,)], "email string")
    assert frame.select(has_email_format("email").alias("v")).first().v is valid


def test_customer_hygiene(raw_customers):
    row = stg_customers(
        raw_customers(("C1", {"full_name": "  Budi ", "email": " Budi@Mail.com", "segment": " VIP ", "gender": " m"}))
    ).first()
    assert (row.full_name, row.raw_email, row.email, row.is_valid_email) == ("Budi", "Budi@Mail.com", "budi@mail.com", True)
    assert (row.customer_segment, row.gender, str(row.signup_date)) == ("vip", "M", "2024-05-01")


def test_invalid_email_is_dropped_but_kept_raw(raw_customers):
    row = stg_customers(raw_customers(("C1", {"email": "budi@@mail.com"}))).first()
    assert (row.email, row.raw_email, row.is_valid_email) == (None, "budi@@mail.com", False)


def test_empty_gender_stays_empty(raw_customers):
    assert stg_customers(raw_customers(("C1", {"gender": ""}))).first().gender == ""


def test_later_load_wins(raw_customers):
    rows = stg_customers(
        raw_customers(("C1", {"city": "Old", "_loaded_at": OLD}), ("C1", {"city": "New"}), ("C2", {}))
    ).collect()
    assert {r.customer_id: r.city for r in rows} == {"C1": "New", "C2": "Bandung"}


def test_padded_copies_are_copies(raw_customers):
    rows = stg_customers(raw_customers((" C1", {}), ("C1 ", {"_loaded_at": OLD}))).collect()
    assert [r.customer_id for r in rows] == ["C1"]


def test_equal_versions_are_decided_the_same_way_in_any_order(spark):
    data = [("k", NEW, "b"), ("k", NEW, "a"), ("k", NEW, None)]
    for rows in (data, data[::-1]):
        frame = spark.createDataFrame(rows, "id string, v timestamp, x string").repartition(3)
        assert latest_by(frame, "id", "v").first().x == "a"


def test_dedup_limits_rows_before_the_shuffle(raw_orders):
    plan = stg_orders(raw_orders(("O1", {})))._jdf.queryExecution().executedPlan().toString()
    below_exchange = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in below_exchange


def test_hot_key_leaves_one_row_per_task_before_the_shuffle(spark):
    from pyspark.sql import functions as F

    frame = spark.range(0, 30_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("key"),
        F.col("id").alias("version"),
    )
    result = latest_by(frame, "key", "version")
    assert result.count() == 20_001
    assert result.filter("key = 'hot'").first().version == 29_997


def test_product_hygiene(raw_products):
    rows = {
        r.product_id: r
        for r in stg_products(
            raw_products(
                ("P1", {"stock_qty": "-5", "is_active": "False"}),
                ("P2", {"price": "0"}),
                ("P3", {"stock_qty": None}),
                ("P4", {"stock_qty": "150", "price": None}),
            )
        ).collect()
    }
    assert (rows["P1"].stock_qty, rows["P1"].raw_stock_qty, rows["P1"].is_active) == (0, -5, False)
    assert rows["P2"].is_valid_pricing is False and rows["P1"].is_valid_pricing is True
    assert (rows["P3"].stock_qty, rows["P3"].raw_stock_qty) == (0, None)
    assert rows["P4"].is_valid_pricing is False and rows["P4"].stock_qty == 150


@pytest.mark.parametrize("bad", [{"price": "abc"}, {"stock_qty": "1.5"}, {"is_active": "perhaps"}])
def test_malformed_product_values_fail(raw_products, bad):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stg_products(raw_products(("P1", bad))).collect()


def test_order_hygiene(raw_orders):
    rows = {
        r.order_id: r
        for r in stg_orders(
            raw_orders(
                ("O1", {"status": None}),
                ("O2", {"status": " Completed", "payment_method": " E-Wallet ", "channel": "Website"}),
                ("O3", {"order_date": "2026-09-03T02:00:00+07:00"}),
            )
        ).collect()
    }
    assert (rows["O1"].order_status, rows["O1"].is_status_present) == ("unknown", False)
    assert (rows["O2"].order_status, rows["O2"].payment_method, rows["O2"].channel) == ("completed", "e-wallet", "website")
    assert str(rows["O3"].order_date) == "2026-09-02"
    assert str(rows["O3"].ordered_at) == "2026-09-02 19:00:00"


def test_malformed_order_date_fails(raw_orders):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stg_orders(raw_orders(("O1", {"order_date": "yesterday"}))).collect()


@pytest.mark.parametrize("field", ["price", "cost"])
def test_amounts_are_never_rounded(raw_products, field):
    assert stg_products(raw_products(("P1", {field: "1.0005"}))).count() == 1
    with pytest.raises(Exception, match="more than four decimals"):
        stg_products(raw_products(("P1", {field: "1.00005"}))).collect()
