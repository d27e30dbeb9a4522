"""Rebuild of the staging and mart layers (C11); any scheduler can start it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from lakemart.operators.sets import layer_counts
from lakemart.plans import marts, staging
from lakemart.session import sized_for
from lakemart.sources.lake import Lake
from lakemart.workspace import scratch


def refresh_staging(lake: Lake, as_of: dt.date | None = None, now: dt.datetime | None = None,
                    partition_orders: bool = False) -> dict[str, int]:
    """Staging from raw.

    ``partition_orders`` lays staged orders out by month, for readers that select months; it costs one
    more shuffle of the largest table, and the marts read the whole history anyway.
    """
    raw = {name: lake.table(lake.raw, f"raw_{name}") for name in ("orders", "customers", "products", "web_events")}
    months = ["order_month"] if partition_orders else None
    with sized_for(lake.spark, lake.bytes(lake.raw)):
        return {
            "stg_orders": lake.publish(lake.stg, "stg_orders", staging.stg_orders(raw["orders"], now), months),
            "stg_customers": lake.publish(lake.stg, "stg_customers", staging.stg_customers(raw["customers"], as_of, now)),
            "stg_products": lake.publish(lake.stg, "stg_products", staging.stg_products(raw["products"], now)),
            "stg_web_events": lake.publish(lake.stg, "stg_web_events", staging.stg_web_events(raw["web_events"], now)),
        }


def refresh_marts(lake: Lake, as_of: dt.date | None = None) -> dict[str, int]:
    """Marts from staging; run it after ``refresh_staging``."""
    orders, customers, products = (lake.table(lake.stg, t) for t in ("stg_orders", "stg_customers", "stg_products"))
    with scratch(lake.spark), sized_for(lake.spark, lake.bytes(lake.stg)):
        return {
            "mart_sales": lake.publish(lake.marts, "mart_sales", marts.mart_sales(orders, products), ["order_month"]),
            "mart_customer_rfm": lake.publish(lake.marts, "mart_customer_rfm", marts.mart_customer_rfm(orders, customers, as_of)),
            "mart_product": lake.publish(lake.marts, "mart_product", marts.mart_product(products, orders)),
            "mart_anomalies": lake.publish(lake.marts, "mart_anomalies", marts.anomalies_of_sales(lake.table(lake.marts, "mart_sales"))),
        }


def counts(lake: Lake, layer: str) -> DataFrame:
    """Row count of every table in a layer."""
    return layer_counts({name: lake.table(layer, name) for name in lake.tables(layer)})
