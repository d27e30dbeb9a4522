"""Registered queries: every operator over the whole test tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import adapter
from lakemart.functions import casts, dates, measures, text
from lakemart.operators import aggregates, joins
from lakemart.operators.anomalies import spread, zscore_iqr
from lakemart.operators.dedup import latest_per_key
from lakemart.operators.ranking import Order, ntile_global, rank_within
from lakemart.operators.selection import exact_percentiles
from lakemart.operators.sets import layer_counts
from lakemart.plans import marts, questions, refresh, staging
from lakemart.plans.incremental import refresh_marts_from
from lakemart.sources import readers, schemas, sinks
from lakemart.sources.lake import Lake
from lakemart.sources.loads import load_raw, read_raw
from lakemart.streaming.hourly import add_events, compact_hourly, hourly_events, read_hourly, stream_hourly_events
from lakemart.streaming.loads import latest_table, stream_latest, stream_raw
from lakemart.workspace import Stored, delete, file_names, fresh_path, move, unsorted_writes, write_counted

AS_OF = dt.date(2001, 12, 31)
LOADED = dt.datetime(2001, 12, 31, 7, 0)
#: Below the size of the test tables and of their categories, so that the checks take the distributed ranking.
SMALL_TASK, SMALL_GROUP = 1000, 300

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


# Staged tables without the wall-clock column.

def orders(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stg_orders(adapter.raw(spark, sf, "orders")).drop("_stg_updated_at")


def customers(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stg_customers(adapter.raw(spark, sf, "customers"), AS_OF).drop("_stg_updated_at")


def products(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stg_products(adapter.raw(spark, sf, "products")).drop("_stg_updated_at")


def web_events(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stg_web_events(adapter.raw(spark, sf, "web_events")).drop("_stg_updated_at")


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Doubles that depend on the order of summation, at four digits."""
    return df.withColumns({c: F.round(c, 4) + 0.0 for c in columns})


# C1-C4

@query
def stg_orders(spark, sf):
    return orders(spark, sf)


@query
def stg_customers(spark, sf):
    return customers(spark, sf)


@query
def stg_products(spark, sf):
    return products(spark, sf)


@query
def stg_web_events(spark, sf):
    return web_events(spark, sf)


# C5-C8

@query
def mart_sales(spark, sf):
    return marts.mart_sales(orders(spark, sf), products(spark, sf))


@query
def mart_customer_rfm(spark, sf):
    return marts.mart_customer_rfm(orders(spark, sf), customers(spark, sf), AS_OF)


@query
def mart_customer_rfm_turned(spark, sf):
    return marts.mart_customer_rfm(orders(spark, sf), customers(spark, sf), AS_OF, best_is_high=True, single_task_rows=SMALL_TASK)


@query
def mart_product(spark, sf):
    return marts.mart_product(products(spark, sf), orders(spark, sf))


@query
def mart_anomalies(spark, sf):
    return rounded(marts.mart_anomalies(orders(spark, sf)), "mean_rev", "stddev_rev", "iqr_lower_bound", "iqr_upper_bound")


# I1-I19

def landed_csv(spark: SparkSession, sf: str, name: str, compression: str = "none") -> str:
    path = fresh_path(spark, f"{name}-csv")
    sinks.write_csv(adapter.flat(spark, sf, name).drop("_loaded_at"), path, compression)
    return path


def landed_json(spark: SparkSession, sf: str, name: str, compression: str = "none") -> str:
    path = fresh_path(spark, f"{name}-json")
    sinks.write_json(adapter.flat(spark, sf, name).drop("_loaded_at"), path, compression)
    return path


def new_lake(spark: SparkSession) -> Lake:
    lake = Lake(spark, fresh_path(spark, "lake"), f"lake_{uuid.uuid4().hex[:12]}_")
    lake.create()
    return lake


@query
def load_csv_orders(spark, sf):
    lake = new_lake(spark)
    load_raw(lake, "raw_orders", landed_csv(spark, sf, "orders"))
    return lake.table(lake.raw, "raw_orders").select(*schemas.ORDER_COLUMNS)


@query
def load_csv_customers(spark, sf):
    lake = new_lake(spark)
    load_raw(lake, "raw_customers", landed_csv(spark, sf, "customers", "gzip"), spread=8)
    return lake.table(lake.raw, "raw_customers").select(*schemas.CUSTOMER_COLUMNS)


@query
def load_json_products(spark, sf):
    lake = new_lake(spark)
    load_raw(lake, "raw_products", landed_json(spark, sf, "products", "gzip"))
    return product_fields(lake)


def product_fields(lake):
    fields = {c: "string" for c in ("product_id", "product_name", "category", "sub_category", "supplier")}
    fields |= {"unit_cost": "decimal(10,2)", "unit_price": "decimal(10,2)", "stock_qty": "int", "is_active": "boolean"}
    raw = lake.table(lake.raw, "raw_products")
    return raw.select(*[casts.variant_field(F.col("raw_data"), c, t).alias(c) for c, t in fields.items()])


@query
def load_json_events(spark, sf):
    lake = new_lake(spark)
    load_raw(lake, "raw_web_events", landed_json(spark, sf, "web_events"))
    return event_fields(lake)


def event_fields(lake):
    fields = ("event_id", "session_id", "customer_id", "event_type", "event_ts", "page", "product_id", "device", "browser", "country")
    raw = lake.table(lake.raw, "raw_web_events")
    return raw.select(*[casts.variant_field(F.col("raw_data"), c).alias(c) for c in fields])


@query
def lineage_columns(spark, sf):
    rows = read_raw(new_lake(spark), "raw_customers", landed_csv(spark, sf, "customers"), "run-1", loaded_at=dt.datetime(2001, 1, 3))
    is_csv = F.col("_source_file").endswith(".csv")
    return rows.groupBy("_loaded_at", "_run_id").agg(aggregates.count_rows().alias("row_count"), F.count_if(is_csv).alias("from_csv"))


@query
def run_log(spark, sf):
    lake = new_lake(spark)
    load_raw(lake, "raw_customers", landed_csv(spark, sf, "customers"))
    load_raw(lake, "raw_products", landed_json(spark, sf, "products"))
    return lake.runs().select("table_name", "rows_loaded", "rows_failed", "load_status")


@query
def load_rejects(spark, sf):
    """What a load sets aside: long values of customers, and events whose line was cut off."""
    lake = new_lake(spark)
    load_raw(lake, "raw_customers", landed_csv(spark, sf, "customers"), quarantine=True, lengths={"customer_name": 200, "city": 14, "email": 20}, casts={"signup_date": "date"})
    path = landed_json(spark, sf, "web_events")
    lines = spark.read.text(path)
    cut = lines.where(F.col("value").contains('"event_type":"error"')).select(F.regexp_replace("value", r"\}$", "").alias("value"))
    cut.write.mode("append").text(path)
    load_raw(lake, "raw_web_events", path, quarantine=True)
    set_aside = lake.rejects().groupBy("table_name", "reason").agg(aggregates.count_rows().alias("rejected"))
    return set_aside.join(lake.runs().select("table_name", "rows_loaded", "rows_failed"), "table_name")


@query
def length_violations(spark, sf):
    return schemas.length_violations(adapter.flat(spark, sf, "customers"), {"customer_id": 3, "customer_name": 200, "city": 14, "email": 20})


@query
def pipeline_counts(spark, sf):
    lake = new_lake(spark)
    for name in ("orders", "customers"):
        load_raw(lake, f"raw_{name}", landed_csv(spark, sf, name))
    for name in ("products", "web_events"):
        load_raw(lake, f"raw_{name}", landed_json(spark, sf, name))
    refresh.refresh_staging(lake, AS_OF)
    refresh.refresh_marts(lake, AS_OF)
    return refresh.counts(lake, lake.stg).unionByName(refresh.counts(lake, lake.marts))


# F, I4, P

@query
def null_if_tokens(spark, sf):
    return readers.blank_to_null(adapter.flat(spark, sf, "customers").select("customer_id", "email", "signup_date"), ("", "unknown"))


@query
def try_casts(spark, sf):
    c = F.col
    return adapter.flat(spark, sf, "orders").select(
        "order_id",
        casts.try_date(c("order_date")).alias("order_date"),
        casts.try_number(c("quantity")).alias("quantity"),
        casts.try_decimal(c("unit_price"), 10, 2).alias("unit_price"),
        casts.try_decimal(c("discount_pct"), 5, 2).alias("discount_pct"),
        casts.try_timestamp(c("order_date")).alias("order_ts"),
    )


@query
def text_clean(spark, sf):
    c = F.col
    return adapter.flat(spark, sf, "orders").select(
        "order_id",
        text.lower_trim(c("order_status")).alias("order_status"),
        text.upper_trim(c("shipping_city")).alias("shipping_city"),
        F.trim("shipping_city").alias("trimmed_city"),
        F.concat("customer_id", F.lit("/"), "product_id", casts.as_text(F.length("order_status"))).alias("joined"),
    )


@query
def initcap_words(spark, sf):
    return adapter.flat(spark, sf, "customers").select("customer_id", *[text.initcap_trim(F.col(c)).alias(c) for c in ("customer_name", "city", "country")])


@query
def variant_fields(spark, sf):
    get = lambda name, type_="string", safe=False: casts.variant_field(F.col("raw_data"), name, type_, safe)
    return adapter.raw(spark, sf, "products").select(
        get("product_id").alias("product_id"),
        get("unit_cost", "decimal(10,2)").alias("unit_cost"),
        get("stock_qty", "int").alias("stock_qty"),
        get("is_active", "boolean").alias("is_active"),
        get("product_name", "int", safe=True).alias("name_as_number"),
        get("no_such_field").alias("missing"),
    )


@query
def date_parts(spark, sf):
    c = F.col
    orders = adapter.flat(spark, sf, "orders").withColumn("order_date", casts.try_date(c("order_date")))
    return orders.select(
        "order_id",
        dates.month_start(c("order_date")).alias("order_month"),
        dates.day_of_week(c("order_date")).alias("order_day_of_week"),
        dates.days_between(c("order_date"), dates.today(AS_OF)).alias("age_days"),
        dates.truncate("day", c("_loaded_at")).alias("loaded_day"),
        dates.truncate("hour", c("_loaded_at")).alias("loaded_hour"),
    )


@query
def stock_bands(spark, sf):
    return adapter.flat(spark, sf, "products").select("product_id", "stock_qty", measures.stock_status(F.col("stock_qty")).alias("stock_status"))


@query
def safe_pct(spark, sf):
    returned = aggregates.count_matching(F.col("order_status") == "returned")
    sold = F.sum("quantity")
    return orders(spark, sf).groupBy("product_id").agg(
        measures.safe_pct(returned, aggregates.count_rows()).alias("return_pct"),
        measures.safe_pct(returned, F.nullif(F.coalesce(sold, F.lit(0)) - F.coalesce(sold, F.lit(0)), F.lit(0))).alias("undefined_pct"),
    )


# W1-W3

@query
def latest_per_key_customers(spark, sf):
    return latest_per_key(adapter.flat(spark, sf, "customers"), ["customer_id"], "_loaded_at")


@query
def ntile_global_orders(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate"))
    scores = {"by_price": Order("o_totalprice", descending=True), "by_date": Order("o_orderdate")}
    stored = Stored(o, "ntile")
    return ntile_global(stored.df, 7, scores, "o_orderkey", stored.rows, SMALL_TASK)


@query
def rank_nulls_first(spark, sf):
    sold = joins.with_totals(
        products(spark, sf).select("product_id", "category"),
        orders(spark, sf).groupBy("product_id").agg(F.sum("quantity").alias("units")), "product_id", [],
    )
    return rank_within(sold, "category", Order("units", descending=True), "units_rank", single_task_rows=SMALL_GROUP)


# J1-J4

@query
def left_join_fact_dim(spark, sf):
    lines = joins.enrich(orders(spark, sf), products(spark, sf).select("product_id", "category", "unit_cost"), "product_id")
    return lines.groupBy("category").agg(
        aggregates.count_rows().alias("lines"), F.sum("line_revenue").alias("revenue"), F.sum(F.col("unit_cost") * F.col("quantity")).alias("cost"),
    )


@query
def inner_join_stats(spark, sf):
    stats = orders(spark, sf).groupBy("customer_id").agg(F.min("order_date").alias("first_order"), F.max("order_date").alias("last_order"))
    return joins.keep_known(stats, customers(spark, sf).select("customer_id", "segment"), "customer_id")


@query
def left_join_dim_fact(spark, sf):
    totals = orders(spark, sf).groupBy("product_id").agg(aggregates.count_rows().alias("lines"), F.sum("quantity").alias("units"))
    return joins.with_totals(products(spark, sf).select("product_id", "supplier"), totals, "product_id", ["lines"])


@query
def cross_join_stats(spark, sf):
    per_country = orders(spark, sf).groupBy("shipping_country").agg(F.sum("line_revenue").alias("revenue"))
    return joins.with_statistics(per_country, per_country.agg(F.sum("revenue").alias("all_revenue"), F.max("revenue").alias("max_revenue")))


# A

@query
def multi_distinct(spark, sf):
    cleaned = staging.clean_orders(adapter.raw(spark, sf, "orders"))
    return aggregates.distinct_counts(cleaned, ["shipping_country"], {"order_ids": "order_id", "customers": "customer_id", "products": "product_id"})


@query
def merged_reach(spark, sf):
    """Customers of each country from the stored sketches of its months and categories, beside the exact count."""
    lake = new_lake(spark)
    lines = orders(spark, sf)
    lake.publish(lake.marts, "mart_reach", marts.mart_reach(lines, products(spark, sf)))
    estimated = aggregates.merged_distinct(lake.table(lake.marts, "mart_reach"), ["shipping_country"], ["customers"])
    exact = aggregates.distinct_counts(marts.completed(lines), ["shipping_country"], {"unique_customers": "customer_id"})
    both = exact.join(estimated.withColumnRenamed("shipping_country", "_country"), F.col("shipping_country").eqNullSafe(F.col("_country")), "left")
    near = F.abs(F.col("customers") - F.col("unique_customers")) <= 0.04 * F.col("unique_customers")
    return both.select("shipping_country", "unique_customers", near.alias("within_4_pct"))


@query
def conditional_distinct(spark, sf):
    c = F.col
    cleaned = staging.clean_orders(adapter.raw(spark, sf, "orders"))
    return cleaned.groupBy("product_id").agg(
        F.count_distinct("order_id").alias("total_orders"),
        aggregates.count_distinct_where(c("order_status") == "returned", c("order_id")).alias("returned_orders"),
    )


@query
def count_if(spark, sf):
    return orders(spark, sf).groupBy("order_month").agg(aggregates.count_matching(F.col("is_discounted")).alias("discounted"), aggregates.count_rows().alias("lines"))


@query
def mean_amounts(spark, sf):
    return orders(spark, sf).groupBy("order_date", "shipping_country").agg(measures.mean_amount(F.col("line_revenue")).alias("mean_revenue"))


@query
def percentile_cont(spark, sf):
    daily = marts.daily_revenue(orders(spark, sf))
    return daily.agg(*[(F.round(aggregates.quantile(F.col("daily_revenue"), q), 4) + 0.0).alias(f"p{int(q * 100)}") for q in (0.1, 0.25, 0.5, 0.75, 0.9)])


@query
def percentile_order_lines(spark, sf):
    """Over every order line: a value for each, not a row a day."""
    fractions = {f"p{int(q * 100)}": q for q in (0.01, 0.25, 0.5, 0.75, 0.99)}
    return rounded(exact_percentiles(orders(spark, sf), "line_revenue", fractions, SMALL_GROUP), *fractions)


@query
def stddev_daily(spark, sf):
    stats = spread(marts.daily_revenue(orders(spark, sf)), "daily_revenue").select("mean_rev", "stddev_rev")
    return rounded(stats, "mean_rev", "stddev_rev")


@query
def zscore_iqr_events(spark, sf):
    hourly = hourly_events(web_events(spark, sf)).groupBy("event_hour").agg(F.sum("events").alias("events"))
    flagged = zscore_iqr(hourly, "events", z=1.5, k=0.5)
    return rounded(flagged, "mean_rev", "stddev_rev", "iqr_lower_bound", "iqr_upper_bound")


@query
def layer_row_counts(spark, sf):
    return layer_counts({f"stg_{t.__name__}": t(spark, sf) for t in (orders, customers, products, web_events)})


# Q1-Q6

@query
def at_risk_customers(spark, sf):
    return questions.at_risk_customers(mart_customer_rfm(spark, sf))


@query
def top_margin_products(spark, sf):
    return questions.top_margin_products(mart_product(spark, sf))


@query
def anomaly_days(spark, sf):
    return questions.anomaly_days(marts.mart_anomalies(orders(spark, sf)))


@query
def revenue_by_day_category_country(spark, sf):
    return questions.revenue_by_day_category_country(mart_sales(spark, sf))


@query
def top_products_by_revenue(spark, sf):
    return questions.top_products_by_revenue(mart_product(spark, sf))


@query
def rfm_segment_sizes(spark, sf):
    return questions.rfm_segment_sizes(mart_customer_rfm(spark, sf))


# S1-S3

@query
def events_hourly(spark, sf):
    return hourly_events(web_events(spark, sf))


@query
def stream_raw_load(spark, sf):
    lake = new_lake(spark)
    stream_raw(lake, "raw_orders", landed_csv(spark, sf, "orders"), fresh_path(spark, "ckpt"), files_per_batch=2).awaitTermination()
    return lake.table(lake.raw, "raw_orders").select(*schemas.ORDER_COLUMNS)


#: Rows of a file that a stream finds, about: so many are written by one task.
FILE_ROWS = 500_000


def landed_files(spark: SparkSession, sf: str, table: str, fewest: int) -> int:
    """Files for a stream over the rows made of ``table``; a larger table makes more files, not larger ones."""
    rows = spark.read.parquet(f"{sf}/{table}.parquet").count()
    return fewest * max(1, -(-rows // (fewest * FILE_ROWS)))


def dealt(raw: DataFrame, drops: int) -> list[str]:
    """Folders with the rows dealt one by one, in files of ``FILE_ROWS`` at most; a drop without rows has none.

    Each task writes to all of them: dealing by a shuffle would send every row as a whole once more.
    """
    path = fresh_path(raw.sparkSession, "dealt")
    with unsorted_writes(raw.sparkSession, drops):
        rows = raw.withColumn("drop", F.pmod(F.monotonically_increasing_id(), F.lit(drops)))
        write_counted(rows, path, partition_by=["drop"], maxRecordsPerFile=str(FILE_ROWS))
    return [f"{path}/{name}" for name in file_names(raw.sparkSession, path) if name.startswith("drop=")]


@query
def stream_load_dedup(spark, sf):
    """Two drops that hold every other row; the stream is called when each has come, and goes on from its checkpoint."""
    raw, lake, arrived, checkpoint = adapter.raw(spark, sf, "orders"), new_lake(spark), fresh_path(spark, "arrived"), fresh_path(spark, "ckpt")
    write_counted(raw.limit(0), f"{arrived}/none")
    arriving = spark.readStream.schema(raw.schema).parquet(f"{arrived}/*")
    table = latest_table(lake, "stg_orders", "order_id")
    for drop, landed in enumerate(dealt(raw, 2) or [f"{arrived}/none"]):
        move(spark, landed, f"{arrived}/{drop}")
        stream_latest(arriving, staging.typed_orders, table, checkpoint, LOADED, staging.derived_orders).awaitTermination()
    delete(spark, arrived)  # all rows are in the log
    return lake.table(lake.stg, "stg_orders")


@query
def stream_events_hourly(spark, sf):
    """Later events first, a few files at a time, so that most batches hold events older than those before."""
    events = adapter.raw(spark, sf, "web_events")
    falling = events.orderBy(F.desc(casts.variant_field(F.col("raw_data"), "event_ts")))
    files = landed_files(spark, sf, "events", 8)
    landed = Stored(falling.hint("rebalance").repartition(files), "landed")
    arriving = spark.readStream.schema(landed.df.schema).option("maxFilesPerTrigger", files // 4).parquet(landed.path)
    path = fresh_path(spark, "hourly")
    stream_hourly_events(staging.clean_web_events(arriving), path, fresh_path(spark, "ckpt")).awaitTermination()
    return read_hourly(spark, path)


#: About so many characters of documents go into one array.
ARRAY_CHARS = 32 << 20


def landed_array(spark, sf, name: str, indent: int | None) -> str:
    return written_array(adapter.raw(spark, sf, name), indent)


def written_array(raw: DataFrame, indent: int | None, path: str | None = None) -> str:
    """Raw documents as files of one JSON array each, elements indented or all on one line; larger inputs make more files."""
    spark = raw.sparkSession
    lines = raw.select(F.to_json("raw_data").alias("line"), F.monotonically_increasing_id().alias("id"))
    spaces = "\n" + " " * (indent or 0) if indent else ""
    inner = F.regexp_replace(F.regexp_replace("line", r"^\{", "{" + "\n" + " " * 2 * (indent or 1)), r"\}$", spaces + "}") if indent else F.col("line")
    joined = F.concat(F.lit("[" + spaces), F.array_join(F.collect_list(inner), "," + spaces), F.lit("\n]" if indent else "]"))
    path = path or fresh_path(spark, "arrays")
    chars = lines.agg(F.sum(F.length(inner) + F.lit(2 + len(spaces)))).first()[0] or 0
    files = max(8, -(-chars // ARRAY_CHARS))
    # With its own id in the hash, a line that repeats goes to all files.
    lines.groupBy(F.pmod(F.xxhash64("line", "id"), F.lit(files)).alias("part")).agg(joined.alias("value")).select("value").write.option("maxRecordsPerFile", 1).text(path)
    return path


@query
def load_json_array_products(spark, sf):
    lake = new_lake(spark)
    load_raw(lake, "raw_products", landed_array(spark, sf, "products", 2))
    return product_fields(lake)


@query
def load_json_array_events(spark, sf):
    lake = new_lake(spark)
    load_raw(lake, "raw_web_events", landed_array(spark, sf, "web_events", None))
    return event_fields(lake)


@query
def stream_raw_load_documents(spark, sf):
    lake = new_lake(spark)
    stream_raw(lake, "raw_web_events", landed_array(spark, sf, "web_events", None), fresh_path(spark, "ckpt"), files_per_batch=3).awaitTermination()
    return event_fields(lake)


@query
def load_json_mixed_layouts(spark, sf):
    """One drop of lines, compact arrays and indented arrays."""
    lake = new_lake(spark)
    raw, third = adapter.raw(spark, sf, "web_events"), F.pmod(F.xxhash64(F.to_json("raw_data")), F.lit(3))
    drop = fresh_path(spark, "mixed")
    written_array(raw.where(third == 0), None, f"{drop}/compact")
    written_array(raw.where(third == 1), 2, f"{drop}/indented")
    raw.where(third == 2).select(F.to_json("raw_data")).write.text(f"{drop}/lines")
    load_raw(lake, "raw_web_events", f"{drop}/*", array_files=True)
    return event_fields(lake)


@query
def stream_json_array_products(spark, sf):
    """Indented arrays as a stream."""
    lake = new_lake(spark)
    stream_raw(lake, "raw_products", landed_array(spark, sf, "products", 2), fresh_path(spark, "ckpt"), files_per_batch=3, array_files=True).awaitTermination()
    return product_fields(lake)


# C11 from changes, C1-C8 as published

def once(build: Callable[[SparkSession, str], Lake]) -> Callable[[SparkSession, str], Lake]:
    """The lake of one session and folder of tables, built once for all queries that look at it."""
    built: dict[tuple[str, str], Lake] = {}

    def lake(spark: SparkSession, sf: str) -> Lake:
        of = spark.sparkContext.applicationId, sf
        if of not in built:
            built[of] = build(spark, sf)
        return built[of]

    return lake


@once
def grown_lake(spark, sf) -> Lake:
    """A lake whose marts were made from some orders, and refreshed when the others and changed products had come."""
    lake = new_lake(spark)
    eighth = F.pmod(F.xxhash64("order_id", "_loaded_at", "quantity"), F.lit(8))
    path = fresh_path(spark, "arrivals")
    arrivals = adapter.raw(spark, sf, "orders").withColumn("_arrival", F.when(eighth <= 4, 0).when(eighth <= 6, 1).otherwise(2))
    write_counted(arrivals, path, partition_by=["_arrival"])  # joined once for all three
    raw = spark.read.schema(arrivals.schema).parquet(path)
    parts = [staging.typed_orders(raw.where(F.col("_arrival") == i)) for i in range(3)]
    table = latest_table(lake, "stg_orders", "order_id")
    lake.publish(lake.stg, "stg_customers", customers(spark, sf))
    first = adapter.raw(spark, sf, "products").where("_loaded_at < '2001-01-02'")
    lake.publish(lake.stg, "stg_products", staging.stg_products(first).where(F.crc32(F.col("product_id").cast("binary")) % 9 != 0))
    table.add(parts[0], "first", staging.derived_orders)
    refresh_marts_from(lake, table, AS_OF)
    table.add(parts[1], "second", staging.derived_orders)
    table.compact()
    table.add(parts[2], "third", staging.derived_orders)
    delete(spark, path)  # all arrivals are in the log
    lake.publish(lake.stg, "stg_products", products(spark, sf))
    refresh_marts_from(lake, table, AS_OF)
    return lake


@query
def grown_mart_sales(spark, sf):
    lake = grown_lake(spark, sf)
    return lake.table(lake.marts, "mart_sales")


@query
def grown_mart_customer_rfm(spark, sf):
    lake = grown_lake(spark, sf)
    return lake.table(lake.marts, "mart_customer_rfm")


@query
def grown_mart_product(spark, sf):
    lake = grown_lake(spark, sf)
    return lake.table(lake.marts, "mart_product")


@query
def grown_mart_anomalies(spark, sf):
    lake = grown_lake(spark, sf)
    return rounded(lake.table(lake.marts, "mart_anomalies"), "mean_rev", "stddev_rev", "iqr_lower_bound", "iqr_upper_bound")


@once
def published_lake(spark, sf) -> Lake:
    """Staging as made from the raw shapes, and a refresh of all marts."""
    lake = new_lake(spark)
    for name, table in {"stg_orders": orders, "stg_customers": customers, "stg_products": products}.items():
        lake.publish(lake.stg, name, table(spark, sf))
    refresh.refresh_marts(lake, AS_OF)
    return lake


@query
def published_stg_orders(spark, sf):
    lake = published_lake(spark, sf)
    return lake.table(lake.stg, "stg_orders")


@query
def published_mart_customer_rfm(spark, sf):
    lake = published_lake(spark, sf)
    return lake.table(lake.marts, "mart_customer_rfm")


@query
def published_mart_product(spark, sf):
    lake = published_lake(spark, sf)
    return lake.table(lake.marts, "mart_product")


@query
def published_mart_anomalies(spark, sf):
    lake = published_lake(spark, sf)
    return rounded(lake.table(lake.marts, "mart_anomalies"), "mean_rev", "stddev_rev", "iqr_lower_bound", "iqr_upper_bound")


@query
def compacted_events_hourly(spark, sf):
    """Counts over a compacted state and later batches, some of which bring events again."""
    events = staging.clean_web_events(adapter.raw(spark, sf, "web_events"))
    early = events.where("_loaded_at < '2024-02-02'")
    path = fresh_path(spark, "hourly")
    add_events(spark, early.where(F.hash("event_id") > 0), path, 0)
    compact_hourly(spark, path)
    add_events(spark, early.where(F.hash("event_id") <= 0), path, 1)
    add_events(spark, events.where("_loaded_at >= '2024-02-02'"), path, 2)
    return read_hourly(spark, path)


@query
def published_mart_sales(spark, sf):
    """The mart as readers see it, in the column order of the contract."""
    lake = new_lake(spark)
    made = mart_sales(spark, sf)
    lake.publish(lake.marts, "mart_sales", made, ["order_month"])
    published = lake.table(lake.marts, "mart_sales")
    if published.columns != made.columns:
        raise ValueError(f"published as {published.columns}")
    return published
