"""Headline timings, one JSON line.

Every query runs to the end with all its output columns computed and thrown
away. ``line_items``, ``*_recomputed`` and ``run_*`` start from raw data; the mart
queries start from the written line items, as in the daily run.
"""

from __future__ import annotations

import json
import os
import time

from checks.queries import land
from checks.rawdata import AS_OF, LOADED_AT, Layers
from lumbung.plans import customers, daily_run, products, quality, reports, sales
from lumbung.session import build_session, fresh_folder


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    x = Layers(spark, folder)
    seconds: dict[str, float] = {}
    setup: dict[str, float] = {}

    def timed(name, work, into=seconds):
        start = time.perf_counter()
        work()
        into[name] = round(time.perf_counter() - start, 3)

    def through(build):
        return lambda: build().write.mode("overwrite").format("noop").save()

    def recomputed():
        return x.compute_line_items()

    timed("raw_orders", lambda: x.raw_orders, setup)
    timed("landing", lambda: setup.update(root=land(x)), setup)
    root = setup.pop("root")
    timed("warm_up", through(recomputed), setup)

    timed("stg_orders", through(lambda: x.stg_orders))
    timed("line_items", through(recomputed))
    timed("line_items_written", lambda: x.line_items)
    timed("int_customer_metrics", through(lambda: customers.int_customer_metrics(x.line_items)))
    timed("fct_daily_sales", through(x.compute_daily))
    timed("fct_daily_sales_recomputed", through(lambda: sales.fct_daily_sales(recomputed())))
    timed("dim_customers", through(x.compute_dim_customers))
    timed("dim_customers_recomputed",
          through(lambda: customers.dim_customers(x.stg_customers, customers.int_customer_metrics(recomputed()))))
    timed("dim_products", through(x.compute_dim_products))
    timed("dim_products_recomputed",
          through(lambda: products.dim_products(x.stg_products, products.product_sales_metrics(recomputed()))))
    timed("fact_order_items", through(x.compute_fact))
    timed("marts_written", lambda: x.marts)
    timed("kpi_summary", through(lambda: reports.kpi_summary(x.daily, x.fact, x.dim_customers, x.dim_products)))
    timed("channel_share", through(lambda: reports.channel_share(x.daily)))
    timed("guest_audit", through(lambda: reports.guest_audit(x.fact)))
    timed("product_ranking", through(lambda: reports.product_ranking(x.dim_products)))
    timed("dq_report", through(lambda: quality.mart_report(x.marts, AS_OF, x.watches(*x.marts))))

    # late-night orders fall before the earliest accepted date, and the gate then rightly stops the run.
    warehouse = fresh_folder(spark, "warehouse")
    run: dict[str, dict] = {}
    counted, watched = quality.raw_watches(*daily_run.RAW), daily_run.mart_watches(AS_OF)
    timed("run_extract_load", lambda: run.update(raw=daily_run.load_raw(spark, root, warehouse, LOADED_AT, counted)))
    timed("run_raw_gate", lambda: quality.require_passed(quality.load_report(spark, counted)))
    timed("run_models", lambda: run.update(marts=daily_run.build_marts(run["raw"], f"{warehouse}/marts", watched)))
    lines = watched.pop(daily_run.LAYER)
    timed("run_reconciliation", through(lambda: reports.written_reconciliation(spark, lines, watched["fact_order_items"])))
    timed("run_data_tests", lambda: quality.mart_report(run["marts"], AS_OF, watched).collect())
    marts = run["marts"]
    timed("run_summary", through(lambda: reports.run_summary(
        marts["dim_customers"], marts["dim_products"], marts["fact_order_items"], marts["fct_daily_sales"])))

    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "setup": setup,
                "sf": float(os.path.basename(folder.rstrip("/")).removeprefix("sf")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
