"""Benchmark: load raw files, refresh staging, refresh marts.  Prints one JSON line.

BENCH_SF_DIR names the test tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores.
The raw files are written before the clock starts.  Each step is timed from its stored input to its
stored result, as the pipeline runs it; the second pass is reported, the first one under "cold".
"""

from __future__ import annotations

import datetime as dt
import json
import os
import time
from collections.abc import Callable

from checks import adapter
from checks.queries import AS_OF, landed_csv, landed_json
from lakemart.plans import marts, staging
from lakemart.plans.refresh import counts
from lakemart.session import get_session
from lakemart.sources.lake import Lake
from lakemart.sources.loads import load_raw
from lakemart.workspace import delete, fresh_path, scratch

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
NOW = dt.datetime(2024, 3, 1)


def run(lake: Lake, files: dict[str, str]) -> dict[str, float]:
    times: dict[str, float] = {}

    def timed(name: str, step: Callable[[], object]) -> None:
        started = time.perf_counter()
        step()
        times[name] = round(time.perf_counter() - started, 3)

    for name, path in files.items():
        timed(f"load_{name}", lambda: load_raw(lake, f"raw_{name}", path))
    raw = {name: lake.table(lake.raw, f"raw_{name}") for name in files}
    timed("stg_orders", lambda: lake.publish(lake.stg, "stg_orders", staging.stg_orders(raw["orders"], NOW)))
    timed("stg_customers", lambda: lake.publish(lake.stg, "stg_customers", staging.stg_customers(raw["customers"], AS_OF, NOW)))
    timed("stg_products", lambda: lake.publish(lake.stg, "stg_products", staging.stg_products(raw["products"], NOW)))
    timed("stg_web_events", lambda: lake.publish(lake.stg, "stg_web_events", staging.stg_web_events(raw["web_events"], NOW)))
    orders, customers, products = (lake.table(lake.stg, f"stg_{t}") for t in ("orders", "customers", "products"))
    timed("mart_sales", lambda: lake.publish(lake.marts, "mart_sales", marts.mart_sales(orders, products), ["order_month"]))
    timed("mart_customer_rfm", lambda: lake.publish(lake.marts, "mart_customer_rfm", marts.mart_customer_rfm(orders, customers, AS_OF)))
    timed("mart_product", lambda: lake.publish(lake.marts, "mart_product", marts.mart_product(products, orders)))
    timed("mart_anomalies", lambda: lake.publish(lake.marts, "mart_anomalies", marts.mart_anomalies(orders)))
    timed("layer_counts", lambda: counts(lake, lake.marts).collect())
    return times


def main() -> None:
    spark = get_session("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    files = {name: (landed_json if name in adapter.DOCUMENTS else landed_csv)(spark, SF_DIR, name) for name in adapter.SQL}
    passes = []
    for prefix in ("cold_", "warm_"):
        lake = Lake(spark, fresh_path(spark, "bench"), prefix)
        lake.create()
        with scratch(spark):
            passes.append(run(lake, files))
        delete(spark, lake.root)
    for path in files.values():
        delete(spark, path)
    cold, warm = passes
    print(json.dumps({
        "metric": "raw files to marts, wall time", "value": round(sum(warm.values()), 3), "unit": "sec", "queries": warm,
        "cold": cold, "cold_value": round(sum(cold.values()), 3), "sf": SF_DIR.rsplit("sf", 1)[-1], "cpus": int(CPUS),
    }))


if __name__ == "__main__":
    main()
