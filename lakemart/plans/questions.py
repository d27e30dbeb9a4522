"""Questions that the marts answer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.operators.aggregates import count_rows


def at_risk_customers(rfm: DataFrame) -> DataFrame:
    """Q1: customers about to stop buying."""
    return rfm.filter(F.col("customer_segment_rfm") == "At Risk").select("customer_id", "customer_name", "email", "recency_days", "total_spent", "rfm_cell")


def top_margin_products(product: DataFrame, k: int = 10) -> DataFrame:
    """Q2"""
    return _top(product, "gross_margin_pct", k).select("product_id", "product_name", "category", "gross_margin_pct")


def anomaly_days(anomalies: DataFrame) -> DataFrame:
    """Q3"""
    return anomalies.filter("is_anomaly").select("order_date", "daily_revenue", "z_score", "anomaly_type")


def revenue_by_day_category_country(sales: DataFrame) -> DataFrame:
    """Q4"""
    return sales.groupBy("order_date", "category", "shipping_country").agg(F.sum("total_revenue").alias("revenue"))


def top_products_by_revenue(product: DataFrame, k: int = 10) -> DataFrame:
    """Q5, O4"""
    return _top(product, "total_revenue", k).select("product_id", "product_name", "category", "total_revenue", "total_units_sold")


def rfm_segment_sizes(rfm: DataFrame) -> DataFrame:
    """Q6"""
    return rfm.groupBy("customer_segment_rfm").agg(count_rows().alias("customers"))


def _top(product: DataFrame, measure: str, k: int) -> DataFrame:
    return product.orderBy(F.col(measure).desc_nulls_last(), "product_id").limit(k)
