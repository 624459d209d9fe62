import json
import os
import tracemalloc
from datetime import date, datetime

import pytest

from pyspark.sql import functions as F

from lumbung.plans import daily_run, quality
from lumbung.sources import exports, landing
from lumbung.sources.tables import (
    MARTS, current_run, log_failure, name_marts, publish, read_published, refresh, retire, run_folder, superseded, table_path,
)

AS_OF = date(2026, 9, 10)
LOADED_AT = datetime(2026, 9, 4, 6, 0)
CUSTOMERS = 'customer_id,full_name,email,city,signup_date,segment,phone,gender\nC1,"Budi, ""Bo""",b@mail.com,Solo,2024-01-01,VIP,+62,\nC1,Budi,b@mail.com,Solo,2024-01-01,VIP,+62,m\n'
PRODUCTS = "sku,product_id,product_name,category,price,cost,stock_qty,weight_gram,is_active\nS1,P1,Kopi,Makanan,1000,600,5,100,True\n"
ORDER = {
    "order_id": "O1", "customer_id": "C1", "order_date": "2026-09-03T02:00:00+07:00", "status": "completed",
    "payment_method": "COD", "channel": "website", "total_amount": 1900.5,
    "items": [{"product_id": "P1", "qty": 2, "unit_price": 1000.25, "discount": 50.0, "subtotal": 1900.5}],
    "_generated_at": "2026-09-03",
}


@pytest.fixture
def shop(tmp_path):
    root = tmp_path / "landing"
    for name in ("customers", "products", "orders"):
        (root / name).mkdir(parents=True)
    (root / "customers" / "customers_20260904.csv").write_text(CUSTOMERS)
    (root / "customers" / "customers_20260903.csv").write_text(CUSTOMERS.splitlines()[0] + "\n")
    (root / "products" / "products_20260904.csv").write_text(PRODUCTS)
    (root / "orders" / "part.json").write_text(json.dumps(ORDER) + "\n")
    return root


def run(spark, shop, tmp_path):
    return daily_run.run(spark, str(shop), str(tmp_path / "warehouse"), AS_OF, LOADED_AT)


def test_newest_export_is_found_by_name(spark, shop):
    (shop / "customers" / "customers_20260905.csv").mkdir()
    (shop / "customers" / "customers_20260905.csv" / "part-0.csv").write_text(CUSTOMERS)
    (shop / "customers" / "notes.txt").write_text("not an export")
    folder = str(shop / "customers")
    assert landing.newest_export(spark, folder, "customers") == ("customers_20260905.csv", True)
    (shop / "customers" / "customers_20260906.csv").mkdir()
    (shop / "customers" / "customers_20260906.csv" / "_SUCCESS").write_text("not data")
    (shop / "customers" / "customers_20260906.csv" / "part-0.csv").write_text("")
    assert landing.newest_export(spark, folder, "customers") == ("customers_20260906.csv", False)
    assert landing.newest_export(spark, folder, "products") is None
    assert landing.newest_exports(spark, {"customers": folder, "products": folder}).count() == 1


def test_many_old_exports_need_no_memory(spark, tmp_path):
    folder = tmp_path / "customers"
    folder.mkdir()
    for i in range(10_000):
        os.close(os.open(folder / f"customers_{19000000 + i}.csv", os.O_CREAT))
    (folder / "customers_20260904.csv").write_text(CUSTOMERS)
    tracemalloc.start()
    assert landing.newest_export(spark, str(folder), "customers") == ("customers_20260904.csv", True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1_000_000


def test_csv_is_matched_by_header_name_and_keeps_empty_text(spark, shop):
    rows = exports.read_customers(spark, str(shop / "customers"), "customers_20260904.csv", LOADED_AT).collect()
    assert (rows[0].full_name, rows[0].gender, rows[0]._source_file) == ('Budi, "Bo"', "", "customers_20260904.csv")
    product = exports.read_products(spark, str(shop / "products"), "products_20260904.csv", LOADED_AT).first()
    assert (product.product_id, product.sku, product.price) == ("P1", "S1", "1000")


def test_missing_csv_fields_are_null(spark, shop):
    (shop / "customers" / "customers_20260906.csv").write_text("customer_id,email\nC1,\n")
    row = exports.read_customers(spark, str(shop / "customers"), "customers_20260906.csv", LOADED_AT).first()
    assert (row.email, row.city) == ("", None)


def test_quoted_line_breaks_on_request(spark, shop):
    (shop / "customers" / "customers_20260907.csv").write_text('customer_id,city\nC1,"So\nlo"\n')
    rows = exports.read_csv_export(
        spark, str(shop / "customers"), "customers_20260907.csv", ("customer_id", "city"), LOADED_AT, multiline=True
    ).collect()
    assert [(r.customer_id, r.city) for r in rows] == [("C1", "So\nlo")]


def part_files(shop, *texts):
    folder = shop / "customers" / "customers_20260908.csv"
    folder.mkdir()
    for i, text in enumerate(texts):
        (folder / f"part-{i}.csv").write_text(text)


def read_parts(spark, shop, **options):
    fields = ("customer_id", "full_name", "city")
    folder = str(shop / "customers")
    return exports.read_csv_export(spark, folder, "customers_20260908.csv", fields, LOADED_AT, **options).collect()


HEADER = "customer_id,full_name,city\n"


RAGGED = {
    "C1,Budi\n": ("C1", "Budi", None, "short"),
    "C1\n": ("C1", None, None, "short"),
    "C1,\n": ("C1", "", None, "short"),
    '"C,1","Bu ""di"", x"\n': ("C,1", 'Bu "di", x', None, "short"),
    "C1,Budi,Solo,more\n": ("C1", "Budi", "Solo", "long"),
    "C1,Budi,,\n": ("C1", "Budi", "", "long"),
    'C1,,"",""\n': ("C1", "", "", "long"),
}


@pytest.mark.parametrize("text", RAGGED)
@pytest.mark.parametrize("multiline", [True, False])
def test_short_rows_end_in_nulls_and_long_rows_are_cut(spark, shop, text, multiline):
    part_files(shop, HEADER + "C2,Siti,Solo\n\n" + text + "C3,,\n")
    found = {r.customer_id: r for r in read_parts(spark, shop, multiline=multiline)}
    row = found.pop(RAGGED[text][0])
    assert (row.customer_id, row.full_name, row.city, row._row_shape) == RAGGED[text]
    assert [(r.full_name, r.city, r._row_shape) for r in found.values()] == [("Siti", "Solo", None), ("", "", None)]


def test_files_are_split_without_multiline(spark, shop):
    part_files(shop, HEADER + "".join(f"C{i},Budi,Solo\n" for i in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
        fields, folder = ("customer_id", "full_name", "city"), str(shop / "customers")
        whole, split = (
            exports.read_csv_export(spark, folder, "customers_20260908.csv", fields, LOADED_AT, multiline) for multiline in (True, False)
        )
        assert whole.select(F.spark_partition_id()).distinct().count() == 1
        assert split.select(F.spark_partition_id()).distinct().count() > 4
        assert split.exceptAll(whole).count() == 0 and split.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_run_reports_ragged_rows_and_goes_on(spark, shop, tmp_path):
    (shop / "customers" / "customers_20260909.csv").write_text(CUSTOMERS + "C8,Ani\nC9,Eko,e@mail.com,Solo,2024-01-01,VIP,+62,m,more,more\n")
    outcome = daily_run.run(spark, str(shop), str(tmp_path / "warehouse"), AS_OF, LOADED_AT, multiline=False)
    assert outcome.status == daily_run.PUBLISHED
    found = {(r.check, r.target): (r.rows, r.failures, r.passed) for r in read_published(spark, str(tmp_path / "warehouse"), "load_report").collect()}
    assert found["short_rows", "raw.customers"] == found["long_rows", "raw.customers"] == (4, 1, True)
    assert found["short_rows", "raw.products"] == (1, 0, True) and found["non_empty", "raw.orders"] == (1, 0, True)


def test_parts_with_another_header_stop_the_read(spark, shop):
    part_files(shop, HEADER + "C1,Budi,Solo\n", "city,customer_id,full_name\nSolo,C2,Siti\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_parts(spark, shop)


def test_quoted_line_breaks_need_whole_files(spark, shop):
    part_files(shop, HEADER + 'C1,"Bu\ndi",Solo\n')
    assert [tuple(r)[:3] for r in read_parts(spark, shop)] == [("C1", "Bu\ndi", "Solo")]
    assert [(r._row_shape, r.city) for r in read_parts(spark, shop, multiline=False)] == [("short", None)] * 2


def test_documents_keep_items_as_text(spark, shop):
    (shop / "orders" / "more.json").write_text('{"order_id":"O2"}\n')
    rows = {r.order_id: r for r in exports.read_orders(spark, str(shop / "orders"), LOADED_AT).collect()}
    assert json.loads(rows["O1"]["items"]) == ORDER["items"]
    assert rows["O2"]["items"] == "[]" and rows["O2"].status is None


def test_malformed_documents_fail(spark, shop):
    (shop / "orders" / "more.json").write_text("{broken\n")
    with pytest.raises(Exception, match="MALFORMED"):
        exports.read_orders(spark, str(shop / "orders"), LOADED_AT).collect()


def test_run_publishes_marts(spark, shop, tmp_path):
    outcome = run(spark, shop, tmp_path)
    assert outcome.status == daily_run.PUBLISHED
    warehouse = str(tmp_path / "warehouse")
    assert current_run(spark, warehouse) == outcome.run_id
    fact = read_published(spark, warehouse, "fact_order_items").first()
    assert (fact.customer_id, str(fact.order_date), float(fact.gross_revenue_idr)) == ("C1", "2026-09-02", 1900.5)
    assert read_published(spark, warehouse, "dim_customers").count() == 2
    assert read_published(spark, warehouse, "fct_daily_sales").count() == 1
    assert read_published(spark, warehouse, "dq_report").filter("not passed").count() == 0


def test_second_run_replaces_the_first(spark, shop, tmp_path):
    run(spark, shop, tmp_path)
    (shop / "orders" / "part.json").write_text(json.dumps({**ORDER, "order_id": "O7"}) + "\n")
    daily_run.run(spark, str(shop), str(tmp_path / "warehouse"), AS_OF, datetime(2026, 9, 5))
    assert [r.order_id for r in read_published(spark, str(tmp_path / "warehouse"), "fact_order_items").collect()] == ["O7"]


def test_failing_tests_keep_the_published_marts(spark, shop, tmp_path):
    first = run(spark, shop, tmp_path)
    bad = {**ORDER, "order_id": "O8", "order_date": "2031-01-01T00:00:00+00:00"}
    (shop / "orders" / "bad.json").write_text(json.dumps(bad) + "\n")
    with pytest.raises(quality.QualityGateError, match="valid_order_dates"):
        run(spark, shop, tmp_path)
    assert current_run(spark, str(tmp_path / "warehouse")) == first.run_id
    found = [p for p in (tmp_path / "warehouse" / "runs").glob("*/violations/*")]
    assert [p.name for p in found] == ["valid_order_dates-fact_order_items.order_date"]
    rows = spark.read.json(str(found[0])).collect()
    assert [(r.order_id, r.order_date) for r in rows] == [("O8", "2031-01-01")]


def test_a_run_keeps_its_raw_tables_warnings_and_summary(spark, shop, tmp_path):
    outcome = run(spark, shop, tmp_path)
    folder = tmp_path / "warehouse" / "runs" / outcome.run_id
    assert {p.name for p in folder.iterdir()} == {
        "raw", "document_warnings", "dq_report", "run_summary",
        "reconciliation", "load_report",
    }  # no steps, no violations
    assert spark.read.parquet(str(folder / "run_summary")).first().total_order_items == 1
    assert spark.read.parquet(str(folder / "document_warnings")).count() == 12


def test_a_load_that_fails_leaves_earlier_raw_tables(spark, shop, tmp_path):
    first = run(spark, shop, tmp_path)
    (shop / "orders" / "bad.json").write_text("{broken\n")
    with pytest.raises(Exception, match="MALFORMED"):
        run(spark, shop, tmp_path)
    raw = f"{tmp_path}/warehouse/runs/{first.run_id}/raw"
    assert [spark.read.parquet(f"{raw}/{t}").count() for t in ("customers", "products", "orders")] == [2, 1, 1]


def test_a_missing_orders_folder_is_reported_by_the_gate(spark, shop, tmp_path):
    (shop / "orders").rename(tmp_path / "elsewhere")
    with pytest.raises(quality.QualityGateError, match="raw.orders"):
        run(spark, shop, tmp_path)


def test_empty_export_skips_the_run(spark, shop, tmp_path):
    (shop / "products" / "products_20260905.csv").write_text("")
    assert run(spark, shop, tmp_path).status == daily_run.SKIPPED
    assert current_run(spark, str(tmp_path / "warehouse")) is None


def test_missing_exports_skip_the_run(spark, tmp_path):
    assert run(spark, tmp_path / "nowhere", tmp_path).status == daily_run.SKIPPED


def test_no_orders_stop_the_run(spark, shop, tmp_path):
    (shop / "orders" / "part.json").write_text("")
    with pytest.raises(quality.QualityGateError, match="raw.orders"):
        run(spark, shop, tmp_path)


def test_nothing_published(spark, tmp_path):
    with pytest.raises(LookupError):
        read_published(spark, str(tmp_path), "dim_customers")


def test_refresh_replaces_and_clusters(spark, tmp_path):
    path = str(tmp_path / "t")
    refresh(spark.range(100), path)
    again = refresh(spark.range(10), path, "id")
    assert sorted(r.id for r in again.collect()) == list(range(10))


def test_documents_from_another_reader(spark, shop):
    """Nested arrays, as a document store's reader delivers them, end up as the same raw rows."""
    nested = spark.createDataFrame(
        [("O1", "C1", "2026-09-03T02:00:00+07:00", "completed", "COD", "website", 1900.5, [("P1", 2, 1000.25)]),
         ("O2", "C1", None, None, None, None, None, None)],
        "order_id string, customer_id string, order_date string, status string, payment_method string, channel string, "
        "total_amount double, items array<struct<product_id:string,qty:int,unit_price:double>>",
    )
    rows = {r.order_id: r for r in exports.raw_orders_from(nested, LOADED_AT, "store").collect()}
    assert json.loads(rows["O1"]["items"]) == [{"product_id": "P1", "qty": 2, "unit_price": 1000.25}]
    assert (rows["O2"]["items"], rows["O1"]._source_system) == ("[]", "store")


def test_only_the_newest_runs_stay(spark, shop, tmp_path):
    warehouse = str(tmp_path / "warehouse")
    ids = [
        daily_run.run(spark, str(shop), warehouse, AS_OF, datetime(2026, 9, day), keep_runs=2).run_id for day in (4, 5, 6)
    ]
    assert {p.name for p in (tmp_path / "warehouse" / "runs").iterdir()} == set(ids[1:])
    for mart in (tmp_path / "warehouse" / "marts").iterdir():
        assert {p.name for p in mart.iterdir()} == {f"run_id={run_id}" for run_id in ids[1:]}
    assert current_run(spark, warehouse) == ids[2]


def test_retention_leaves_runs_that_are_read_or_written(spark, tmp_path):
    warehouse = str(tmp_path)
    for run_id in ("r1", "r2", "r3", "failed-old", "failed-new", "running"):
        refresh(spark.range(5), f"{run_folder(warehouse, run_id)}/t")
    for day, run_id in enumerate(("r1", "r2", "r3"), 1):
        publish(spark, warehouse, run_id, f"2026-09-0{2 * day}T00:00:00")
    log_failure(spark, warehouse, "failed-old", "2026-09-03T00:00:00")
    log_failure(spark, warehouse, "failed-new", "2026-09-05T00:00:00")
    reading = read_published(spark, warehouse, "t")
    assert superseded(spark, warehouse, 4) == []
    assert retire(spark, warehouse, 2) == ["failed-old", "r1"]
    assert reading.count() == 5 and current_run(spark, warehouse) == "r3"
    assert {p.name for p in (tmp_path / "runs").iterdir()} == {"r2", "r3", "failed-new", "running"}
    assert retire(spark, warehouse, 2) == [] and retire(spark, warehouse, 1) == ["failed-new", "r2"]
    with pytest.raises(ValueError):
        retire(spark, warehouse, 0)


def test_marts_by_name_move_together(spark, tmp_path):
    """Views made once follow the log: all marts of a run become visible with one row, none before."""
    warehouse = str(tmp_path / "w")

    def write(run_id, rows):
        for name in MARTS:
            refresh(spark.range(rows), table_path(warehouse, run_id, name))

    def seen():
        return {spark.table(f"shop_{name}").count() for name in MARTS}

    write("20260904T060000-1e5", 5)
    publish(spark, warehouse, "20260904T060000-1e5", "2026-09-04T00:00:00")
    name_marts(spark, warehouse, "shop_")
    assert seen() == {5} and spark.table("shop_dim_products").columns == ["id"]
    write("20260905T060000-2e7", 7)
    assert seen() == {5}
    publish(spark, warehouse, "20260905T060000-2e7", "2026-09-05T00:00:00")
    assert seen() == {7}
    frame = spark.table("shop_fct_daily_sales")
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan and "run_id" in plan and "Subquery" in plan


def test_a_run_can_be_read_by_name(spark, shop, tmp_path):
    run(spark, shop, tmp_path)
    name_marts(spark, str(tmp_path / "warehouse"), "daily_")
    assert spark.sql("SELECT sum(gross_revenue_idr) AS s FROM daily_fact_order_items").first().s == 1900.5
