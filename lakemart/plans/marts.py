"""Mart tables over staging.

Staged orders have one row per ``order_id`` and staged products one per ``product_id``; distinct order
counts are therefore plain counts, and fact aggregation runs before a join where that shrinks it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions import dates, measures
from lakemart.operators import aggregates, joins
from lakemart.operators.anomalies import zscore_iqr
from lakemart.operators.ranking import SINGLE_TASK_ROWS, Order, ntile_global, rank_within
from lakemart.workspace import Stored

# Order states that the marts look at.
COMPLETED, RETURNED = "completed", "returned"

SALES_KEYS = ["order_date", "category", "sub_category", "shipping_country"]
REACH_KEYS = ["order_month", "category", "shipping_country"]
PRODUCT_COLUMNS = ["product_id", "product_name", "category", "sub_category", "supplier", "unit_cost", "unit_price",
                   "gross_margin_pct", "stock_status", "stock_qty"]
CUSTOMER_COLUMNS = ["customer_name", "email", "segment", "city", "country", "signup_date"]


def completed(orders: DataFrame) -> DataFrame:
    """P5"""
    return orders.filter(F.col("order_status") == COMPLETED)


def mart_sales(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Completed orders per day, category and country, with margin and discount rates.

    Orders of unknown products count with category NULL, but not in the profit.  Distinct customers are
    counted in two steps, first spread over customer ids, so that a hot group is no hot task.  Month, day
    of week and status follow from the other keys and are added afterwards, not shuffled.
    """
    c = F.col
    lines = joins.enrich(completed(orders), products.select("product_id", "category", "sub_category", "unit_cost"), "product_id")
    discounted = aggregates.count_matching(c("is_discounted"))
    revenue = F.sum("line_revenue")
    profit = F.sum(c("line_revenue") - c("unit_cost") * c("quantity"))
    sales = lines.groupBy(*SALES_KEYS).agg(
        F.count("order_id").alias("total_orders"),
        F.count_distinct("customer_id").alias("unique_customers"),
        revenue.alias("total_revenue"),
        measures.mean_amount(c("line_revenue")).alias("avg_order_value"),
        F.sum("quantity").alias("total_units_sold"),
        discounted.alias("discounted_orders"),
        measures.safe_pct(discounted, aggregates.count_rows()).alias("discount_rate_pct"),
        profit.alias("total_gross_profit"),
        measures.safe_pct(profit, revenue).alias("gross_profit_margin_pct"),
    )
    return sales.select(
        "order_date",
        dates.month_start(c("order_date")).alias("order_month"),
        dates.day_of_week(c("order_date")).alias("order_day_of_week"),
        "category", "sub_category", "shipping_country",
        F.lit(COMPLETED).alias("order_status"),
        *[name for name in sales.columns if name not in SALES_KEYS],
    )


def mart_reach(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Sketches of the customers behind each month, category and country of ``mart_sales``.

    Distinct customers of groups don't add up; these sketches do (``aggregates.merged_distinct``), so the reach of a month,
    of a country or of both is estimated from the mart without the orders.
    """
    lines = joins.enrich(completed(orders), products.select("product_id", "category", "sub_category"), "product_id")
    lines = lines.withColumn("order_month", dates.month_start(F.col("order_date")))
    return aggregates.distinct_sketches(lines, REACH_KEYS, {"customers": "customer_id"})


def customer_orders(orders: DataFrame) -> DataFrame:
    """Completed orders per customer."""
    return completed(orders).groupBy("customer_id").agg(
        F.max("order_date").alias("last_order_date"),
        F.min("order_date").alias("first_order_date"),
        F.count("order_id").alias("order_count"),
        F.sum("line_revenue").alias("total_spent"),
        measures.mean_amount(F.col("line_revenue")).alias("avg_order_value"),
    )


def rfm_orders(best_is_high: bool = False) -> dict[str, Order]:
    """Sort order behind each score.  By default 1 is best: latest, most orders, most spent."""
    return {
        "recency_score": Order("recency_days", descending=best_is_high),
        "frequency_score": Order("order_count", descending=not best_is_high),
        "monetary_score": Order("total_spent", descending=not best_is_high),
    }


def mart_customer_rfm(orders: DataFrame, customers: DataFrame, as_of: dt.date | None = None, tiles: int = 5,
                      best_is_high: bool = False, single_task_rows: int = SINGLE_TASK_ROWS) -> DataFrame:
    """Recency, frequency and monetary scores of known customers with completed orders.

    The scores come from rank positions over all customers.  The aggregated customers are therefore
    stored first: orders are read once, and the stored size decides how tiles are computed.  Scores are
    1 = best while the segment rules take high scores as good; ``best_is_high`` turns the scores round.
    """
    return rfm_of_totals(customer_orders(orders), customers, as_of, tiles, best_is_high, single_task_rows)


def rfm_of_totals(totals: DataFrame, customers: DataFrame, as_of: dt.date | None = None, tiles: int = 5,
                  best_is_high: bool = False, single_task_rows: int = SINGLE_TASK_ROWS) -> DataFrame:
    """C6 from the totals that ``customer_orders`` makes."""
    c = F.col
    known = joins.keep_known(totals, customers.select("customer_id", *CUSTOMER_COLUMNS), "customer_id")
    known = known.withColumn("recency_days", dates.days_between(c("last_order_date"), dates.today(as_of)))
    stored = Stored(known, "rfm")
    scores = rfm_orders(best_is_high)
    scored = ntile_global(stored.df, tiles, scores, "customer_id", stored.rows, single_task_rows, known_unique=True)
    return scored.select(
        "customer_id", *CUSTOMER_COLUMNS, "last_order_date", "first_order_date", "order_count", "total_spent",
        "avg_order_value", "recency_days", *scores,
        measures.rfm_average(*[c(s) for s in scores]).alias("rfm_avg_score"),
        measures.rfm_cell(*[c(s) for s in scores]).alias("rfm_cell"),
        measures.rfm_segment(*[c(s) for s in scores]).alias("customer_segment_rfm"),
    )


def mart_product(products: DataFrame, orders: DataFrame, single_task_rows: int = SINGLE_TASK_ROWS) -> DataFrame:
    """Every product with sales over orders of any status, return rate and revenue rank in its category.

    A product without orders has no revenue, which ranks before every amount.
    """
    return product_of_totals(products, product_orders(orders), single_task_rows)


def product_orders(orders: DataFrame) -> DataFrame:
    """Orders of any status per product."""
    return orders.groupBy("product_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("quantity").alias("total_units_sold"),
        F.sum("line_revenue").alias("total_revenue"),
        measures.mean_amount(F.col("line_revenue")).alias("avg_order_value"),
        aggregates.count_matching(F.col("order_status") == RETURNED).alias("returned_orders"),
    )


def product_of_totals(products: DataFrame, totals: DataFrame, single_task_rows: int = SINGLE_TASK_ROWS) -> DataFrame:
    """C7 from the totals that ``product_orders`` makes."""
    c = F.col
    sold = joins.with_totals(products.select(*PRODUCT_COLUMNS), totals, "product_id", ["total_orders", "returned_orders"])
    sold = sold.withColumn("return_rate_pct", measures.safe_pct(c("returned_orders"), c("total_orders")))
    ranked = rank_within(sold, "category", Order("total_revenue", descending=True), "revenue_rank_in_category",
                         products.select("category"), single_task_rows)
    return ranked.select(
        *PRODUCT_COLUMNS, "total_orders", "total_units_sold", "total_revenue", "avg_order_value", "returned_orders",
        "return_rate_pct", "revenue_rank_in_category",
    )


def daily_revenue(orders: DataFrame) -> DataFrame:
    """Completed orders per day: at most one row per calendar day, whatever the number of orders."""
    return completed(orders).groupBy("order_date").agg(
        F.sum("line_revenue").alias("daily_revenue"),
        F.count("order_id").alias("daily_orders"),
    )


def mart_anomalies(orders: DataFrame, z: float = 2.0, k: float = 1.5) -> DataFrame:
    """Days whose revenue is unusual in the whole history, in date order."""
    return anomalous_days(daily_revenue(orders), z, k)


def anomalies_of_sales(sales: DataFrame, z: float = 2.0, k: float = 1.5) -> DataFrame:
    """C8 from mart_sales, which has the same revenue and orders per day: orders are not read again."""
    daily = sales.groupBy("order_date").agg(
        F.sum("total_revenue").cast("decimal(28,2)").alias("daily_revenue"), F.sum("total_orders").alias("daily_orders")
    )
    return anomalous_days(daily, z, k)


def anomalous_days(daily: DataFrame, z: float, k: float) -> DataFrame:
    return zscore_iqr(daily, "daily_revenue", z, k, also={"all_orders": F.sum("daily_orders")}).orderBy("order_date")
