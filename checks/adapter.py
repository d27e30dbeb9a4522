"""The four raw shapes derived from the test tables, as SQL that Spark and DuckDB both run.

They follow FIXTURES.md, but leave no row out: parts that shall have no orders and products that shall be
missing lose their id instead of their rows.  A second load repeats some rows with other values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_ORDERS = """
select
  case when (l_orderkey + l_partkey) % 101 = 0 then null else concat('O', cast(l_orderkey as varchar(20)), '-', cast(l_linenumber as varchar(20))) end as order_id,
  concat('C', cast(o_custkey as varchar(20))) as customer_id,
  case when l_partkey % 37 = 5 then null else concat('P', cast(l_partkey as varchar(20))) end as product_id,
  case when (l_orderkey + l_partkey) % 97 = 0 then 'not-a-date' else substr(cast(o_orderdate as varchar(30)), 1, 10) end as order_date,
  case when l_returnflag = 'R' then ' Returned ' when o_orderstatus = 'P' then 'PENDING'
       when l_returnflag = 'N' and o_orderstatus = 'O' then 'cancelled' else 'Completed' end as order_status,
  case when (l_orderkey * 3 + l_partkey) % 89 = 0 then 'n/a' else cast(cast(l_quantity as int) as varchar(20)) end as quantity,
  cast(cast(p_retailprice as decimal(10,2)) as varchar(20)) as unit_price,
  case when l_linenumber = 4 then null else cast(cast(round(l_discount * 100) as int) as varchar(20)) end as discount_pct,
  concat(' ', lower(n_name), ' city ') as shipping_city,
  lower(n_name) as shipping_country,
  l_shipdate as _loaded_at
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey join part on l_partkey = p_partkey
"""

RAW_CUSTOMERS = """
select
  concat('C', cast(c_custkey as varchar(20))) as customer_id,
  concat(' ', lower(replace(c_name, '#', '-x')), ' ') as customer_name,
  case when c_custkey % 17 = 0 then null when c_custkey % 19 = 0 then '' else concat(' User', cast(c_custkey as varchar(20)), '@Example.COM') end as email,
  concat(' 555-', cast(10000 + c_custkey + v.d * 50000 as varchar(20)), ' ') as phone,
  concat(lower(n_name), '-on-sea') as city,
  lower(replace(n_name, '_', ' ')) as country,
  lower(c_mktsegment) as segment,
  case when c_custkey % 23 = 0 then 'unknown' else concat('1994-', case when c_custkey % 2 = 0 then '03' else '11' end, '-', cast(10 + c_custkey % 19 as varchar(20))) end as signup_date,
  v.loaded as _loaded_at
from (select *, timestamp '2001-01-01 00:00:00' as loaded, 0 as d from customer
        union all select *, timestamp '2001-01-02 00:00:00' as loaded, 1 as d from customer where c_custkey % 10 = 0) v
  join nation on c_nationkey = n_nationkey
"""

RAW_PRODUCTS_FLAT = """
select
  case when p_partkey % 50 = 0 then null else concat('P', cast(p_partkey as varchar(20))) end as product_id, p_name as product_name, p_type as category, p_brand as sub_category,
  concat('Supplier ', cast(p_partkey % 7 as varchar(20))) as supplier,
  cast(p_retailprice as decimal(10,2)) - cast(100 + (p_partkey % 13) * 25 as decimal(10,2)) as unit_cost,
  cast(p_retailprice as decimal(10,2)) as unit_price,
  case when v.d = 1 then 0 else p_size - 1 end as stock_qty,
  p_partkey % 20 <> 0 as is_active,
  v.loaded as _loaded_at
from (select *, timestamp '2001-01-01 00:00:00' as loaded, 0 as d from part
        union all select *, timestamp '2001-01-02 00:00:00' as loaded, 1 as d from part where p_partkey % 10 = 1) v
"""

RAW_WEB_EVENTS_FLAT = """
select
  concat('E', cast(event_id as varchar(20))) as event_id,
  concat('S', cast(user_id as varchar(20)), '-', substr(cast(ts as varchar(40)), 1, 10)) as session_id,
  case when event_id % 6 = 0 then null else concat('C', cast(user_id as varchar(20))) end as customer_id,
  event_type,
  case when event_id % 211 = 0 then 'bad' else substr(cast(ts as varchar(40)), 1, 19) end as event_ts,
  case event_type when 'view' then '/products' when 'purchase' then '/checkout' when 'signup' then '/account' else '/home' end as page,
  case when event_type = 'purchase' then concat('P', cast(event_id % 200 as varchar(20))) else null end as product_id,
  case (event_id + v.d) % 3 when 0 then 'mobile' when 1 then 'desktop' else 'tablet' end as device,
  case event_id % 4 when 0 then 'Chrome' when 1 then 'Safari' when 2 then 'Firefox' else 'Edge' end as browser,
  concat('N', cast(user_id % 25 as varchar(20))) as country,
  v.loaded as _loaded_at
from (select *, timestamp '2024-02-01 00:00:00' as loaded, 0 as d from events
        union all select *, timestamp '2024-02-02 00:00:00' as loaded, 1 as d from events where event_id % 50 = 3) v
"""

SQL = {"orders": RAW_ORDERS, "customers": RAW_CUSTOMERS, "products": RAW_PRODUCTS_FLAT, "web_events": RAW_WEB_EVENTS_FLAT}
TABLES = {
    "orders": ("lineitem", "orders", "customer", "nation", "part"),
    "customers": ("customer", "nation"),
    "products": ("part",),
    "web_events": ("events",),
}
DOCUMENTS = ("products", "web_events")


#: The joins of the orders, and the same as Spark, which keeps the written order, shall run them: lines meet their part while they are
#: narrow and then their order, whose country is known by then.  They are shuffled twice, not three times, and lie by order at the end.
AS_WRITTEN = """from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey join part on l_partkey = p_partkey"""
NARROW_FIRST = """from lineitem join part on l_partkey = p_partkey
  join (orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey) on l_orderkey = o_orderkey"""


def flat(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Raw rows as plain columns with their load time."""
    for table in TABLES[name]:
        spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)
    return spark.sql(SQL[name].replace(AS_WRITTEN, NARROW_FIRST)).withColumn("_loaded_at", F.col("_loaded_at").cast("timestamp_ntz"))


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Raw rows as the raw table holds them, JSON NULLs included."""
    df = flat(spark, sf_dir, name)
    if name in DOCUMENTS:
        fields = F.struct(*[c for c in df.columns if c != "_loaded_at"])
        df = df.select(F.parse_json(F.to_json(fields, {"ignoreNullFields": "false"})).alias("raw_data"), "_loaded_at")
    return df.withColumns({"_source_file": F.lit(f"raw_{name}"), "_run_id": F.lit("adapter")})
