"""Staging tables: raw rows cleaned, cast, derived and reduced to the latest per key.

Typed columns come first and keys are filtered on them, then rows are deduplicated: every output
column takes part in the tie-break, so the result is the same on every run.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions import casts, dates, measures, text
from lakemart.operators.dedup import latest_per_key
from lakemart.sources.schemas import DOCUMENT_COLUMN


def clean_orders(raw: DataFrame) -> DataFrame:
    """Typed orders with derived columns, before deduplication; rows without id or readable date drop out."""
    return derived_orders(typed_orders(raw))


def typed_orders(raw: DataFrame) -> DataFrame:
    """Orders with the columns that come from the raw ones; rows without id or readable date drop out."""
    c = F.col
    return raw.select(
        "order_id",
        "customer_id",
        "product_id",
        casts.try_date(c("order_date")).alias("order_date"),
        text.lower_trim(c("order_status")).alias("order_status"),
        casts.try_number(c("quantity")).alias("quantity"),
        casts.try_decimal(c("unit_price"), 10, 2).alias("unit_price"),
        casts.try_decimal(c("discount_pct"), 5, 2).alias("discount_pct"),
        text.upper_trim(c("shipping_city")).alias("shipping_city"),
        text.upper_trim(c("shipping_country")).alias("shipping_country"),
        "_loaded_at",
        "_source_file",
        "_run_id",
    ).filter(c("order_id").isNotNull() & c("order_date").isNotNull())


def derived_orders(typed: DataFrame) -> DataFrame:
    """Typed orders with the columns that follow from the others of a row."""
    c = F.col
    return typed.select(
        "order_id", "customer_id", "product_id", "order_date", "order_status", "quantity", "unit_price", "discount_pct",
        measures.line_revenue(c("quantity"), c("unit_price"), c("discount_pct")).alias("line_revenue"),
        measures.is_discounted(c("discount_pct")).alias("is_discounted"),
        "shipping_city", "shipping_country",
        dates.month_start(c("order_date")).alias("order_month"),
        dates.day_of_week(c("order_date")).alias("order_day_of_week"),
        "_loaded_at", "_source_file", "_run_id",
    )


def clean_customers(raw: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Typed customers with derived columns, before deduplication."""
    c = F.col
    signup = casts.try_date(c("signup_date"))
    return raw.filter(c("customer_id").isNotNull()).select(
        "customer_id",
        text.initcap_trim(c("customer_name")).alias("customer_name"),
        text.lower_trim(c("email")).alias("email"),
        F.trim("phone").alias("phone"),
        *[text.initcap_trim(c(name)).alias(name) for name in ("city", "country", "segment")],
        signup.alias("signup_date"),
        dates.days_between(signup, dates.today(as_of)).alias("customer_age_days"),
        measures.is_incomplete(c("email")).alias("is_incomplete"),
        "_loaded_at",
    )


def clean_products(raw: DataFrame) -> DataFrame:
    """Typed products from the stored documents, before deduplication."""
    c = F.col
    fields = {
        **{name: "string" for name in ("product_id", "product_name", "category", "sub_category", "supplier")},
        "unit_cost": "decimal(10,2)", "unit_price": "decimal(10,2)", "stock_qty": "int", "is_active": "boolean",
    }
    typed = _fields(raw, fields).filter(c("product_id").isNotNull())
    return typed.select(
        *fields,
        measures.gross_margin(c("unit_price"), c("unit_cost")).alias("gross_margin_amount"),
        measures.gross_margin_pct(c("unit_price"), c("unit_cost")).alias("gross_margin_pct"),
        measures.stock_status(c("stock_qty")).alias("stock_status"),
        "_loaded_at",
    )


def clean_web_events(raw: DataFrame) -> DataFrame:
    """Typed web events from the stored documents, before deduplication."""
    c = F.col
    names = ("event_id", "session_id", "customer_id", "event_type", "event_ts", "page", "product_id", "device", "browser", "country")
    typed = _fields(raw, {name: "string" for name in names}).filter(c("event_id").isNotNull())
    typed = typed.withColumn("event_ts", casts.try_timestamp(c("event_ts")))
    return typed.select(
        *names,
        c("customer_id").isNull().alias("is_anonymous"),
        dates.truncate("hour", c("event_ts")).alias("event_hour"),
        dates.truncate("day", c("event_ts")).alias("event_date"),
        "_loaded_at",
    )


def stg_orders(raw: DataFrame, now: dt.datetime | None = None) -> DataFrame:
    """C1; what follows from other columns of a row breaks no tie, so it is derived afterwards, not sorted and shuffled."""
    return derived_orders(latest_per_key(typed_orders(raw), ["order_id"], "_loaded_at")).withColumn("_stg_updated_at", dates.now(now))


def stg_customers(raw: DataFrame, as_of: dt.date | None = None, now: dt.datetime | None = None) -> DataFrame:
    """C2"""
    return _staged(clean_customers(raw, as_of), "customer_id", now)


def stg_products(raw: DataFrame, now: dt.datetime | None = None) -> DataFrame:
    """C3"""
    return _staged(clean_products(raw), "product_id", now)


def stg_web_events(raw: DataFrame, now: dt.datetime | None = None) -> DataFrame:
    """C4"""
    return _staged(clean_web_events(raw), "event_id", now)


def _fields(raw: DataFrame, fields: dict[str, str]) -> DataFrame:
    document = F.col(DOCUMENT_COLUMN)
    return raw.select(*[casts.variant_field(document, name, type_).alias(name) for name, type_ in fields.items()], "_loaded_at")


def _staged(cleaned: DataFrame, key: str, now: dt.datetime | None) -> DataFrame:
    return latest_per_key(cleaned, [key], "_loaded_at").withColumn("_stg_updated_at", dates.now(now))
