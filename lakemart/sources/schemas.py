"""Declared raw tables and the run log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Business columns of the delimited raw tables in file order, with their greatest length.
ORDER_COLUMNS = {
    "order_id": 50, "customer_id": 50, "product_id": 50, "order_date": 50, "order_status": 30,
    "quantity": 20, "unit_price": 20, "discount_pct": 20, "shipping_city": 100, "shipping_country": 100,
}
CUSTOMER_COLUMNS = {
    "customer_id": 50, "customer_name": 200, "email": 200, "phone": 50,
    "city": 100, "country": 100, "segment": 50, "signup_date": 50,
}
DELIMITED = {"raw_orders": ORDER_COLUMNS, "raw_customers": CUSTOMER_COLUMNS}

#: Raw tables that keep each JSON object whole.
DOCUMENTS = ("raw_products", "raw_web_events")
DOCUMENT_COLUMN = "raw_data"

RAW_TABLES = (*DELIMITED, *DOCUMENTS)
RUN_LOG, REJECTS = "pipeline_run_log", "raw_rejects"

LINEAGE = T.StructType([
    T.StructField("_loaded_at", T.TimestampNTZType()),
    T.StructField("_source_file", T.StringType()),
    T.StructField("_run_id", T.StringType()),
])

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("table_name", T.StringType(), False),
    T.StructField("source_file", T.StringType()),
    T.StructField("rows_loaded", T.LongType()),
    T.StructField("rows_failed", T.LongType()),
    T.StructField("load_status", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("started_at", T.TimestampNTZType()),
    T.StructField("completed_at", T.TimestampNTZType()),
    T.StructField("loaded_by", T.StringType()),
])

REJECTS_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("record", T.StringType()),
    T.StructField("reason", T.StringType(), False),
    *LINEAGE.fields,
])
#: Columns of a row under inspection: the text that could not be read, and what is wrong with the row.
MALFORMED, REASON = "_malformed", "_reason"


def business_schema(table: str) -> T.StructType:
    """Columns of a raw table as they arrive: strings, or one variant."""
    if table in DELIMITED:
        return T.StructType([T.StructField(c, T.StringType()) for c in DELIMITED[table]])
    return T.StructType([T.StructField(DOCUMENT_COLUMN, T.VariantType())])


def raw_schema(table: str) -> T.StructType:
    """Columns of a raw table as stored, with lineage."""
    return T.StructType([*business_schema(table).fields, *LINEAGE.fields])


def length_violations(df: DataFrame, lengths: dict[str, int]) -> DataFrame:
    """Per column, how many values are longer than declared; one row, one pass."""
    def too_long(column: str, limit: int) -> Column:
        return F.count_if(F.length(column) > limit).alias(column)

    return df.agg(*[too_long(c, n) for c, n in lengths.items()])


def reason(table: str, lengths: dict[str, int] | None = None, casts: dict[str, str] | None = None) -> Column:
    """What is wrong with a row: it could not be read, or the first column that is too long or is no such type; else NULL.

    ``lengths`` replaces the declared ones; ``casts`` names columns that must be of a type where they are not NULL.
    """
    lengths = DELIMITED.get(table, {}) if lengths is None else lengths
    wrong = F.when(F.col(MALFORMED).isNotNull(), F.lit("malformed"))
    for column, limit in lengths.items():
        wrong = wrong.when(F.length(column) > limit, F.lit(f"length of {column}"))
    for column, kind in (casts or {}).items():
        wrong = wrong.when(F.col(column).isNotNull() & F.col(column).try_cast(kind).isNull(), F.lit(f"no {kind} in {column}"))
    return wrong
