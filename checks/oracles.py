"""The registered queries once more as SQL for DuckDB, self-contained on the test tables.

Rounded quotients are computed on whole cents: DuckDB divides decimals as doubles, where a tie may
round either way.
"""

from __future__ import annotations

from checks import adapter

AS_OF = "date '2001-12-31'"
DELIMITERS = r"""\s!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>"""


def cents(amount: str) -> str:
    return f"cast(({amount}) * 100 as hugeint)"


def ratio(num: str, den: str) -> str:
    """``num / den`` half up as a number of cents, on whole numbers of either sign."""
    return (
        f"(case when ({den}) = 0 then null else cast(cast(sign(({num})) * sign(({den})) * "
        f"((200 * abs(({num})) + abs(({den}))) // (2 * abs(({den})))) as decimal(20,0)) * 0.01 as decimal(18,2)) end)"
    )


def pct(num: str, den: str) -> str:
    return ratio(f"cast(({num}) as hugeint) * 100", f"cast(({den}) as hugeint)")


def mean(amount: str) -> str:
    total = f"sum({cents(amount)})"
    return (
        f"(case when count({amount}) = 0 then null else cast(cast(sign({total}) * "
        f"((2 * abs({total}) + count({amount})) // (2 * count({amount}))) as decimal(20,0)) * 0.01 as decimal(18,2)) end)"
    )


def latest(key: str, columns: list[str]) -> str:
    order = ", ".join(f"{c} desc nulls first" for c in ["_loaded_at", *[c for c in columns if c not in (key, "_loaded_at")]])
    return f"qualify row_number() over (partition by {key} order by {order}) = 1"


def initcap(text: str) -> str:
    parts = f"regexp_extract_all(lower(trim({text})), '[{DELIMITERS}]|[^{DELIMITERS}]+')"
    return f"array_to_string(list_transform({parts}, lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), '')"


def to_date(text: str) -> str:
    return f"cast(try_strptime({text}, '%Y-%m-%d') as date)"


STOCK = "case when stock_qty = 0 then 'Out of Stock' when stock_qty < 20 then 'Low Stock' else 'In Stock' end"

ORDERS = ["order_id", "customer_id", "product_id", "order_date", "order_status", "quantity", "unit_price", "discount_pct", "line_revenue",
          "is_discounted", "shipping_city", "shipping_country", "order_month", "order_day_of_week", "_loaded_at", "_source_file", "_run_id"]
CUSTOMERS = ["customer_id", "customer_name", "email", "phone", "city", "country", "segment", "signup_date", "customer_age_days", "is_incomplete", "_loaded_at"]
PRODUCTS = ["product_id", "product_name", "category", "sub_category", "supplier", "unit_cost", "unit_price", "stock_qty", "is_active",
            "gross_margin_amount", "gross_margin_pct", "stock_status", "_loaded_at"]
EVENTS = ["event_id", "session_id", "customer_id", "event_type", "event_ts", "page", "product_id", "device", "browser", "country",
          "is_anonymous", "event_hour", "event_date", "_loaded_at"]

# name -> (names it reads, SQL)
PARTS: dict[str, tuple[list[str], str]] = {
    "raw_orders": ([], adapter.RAW_ORDERS),
    "raw_customers": ([], adapter.RAW_CUSTOMERS),
    "raw_products": ([], adapter.RAW_PRODUCTS_FLAT),
    "raw_web_events": ([], adapter.RAW_WEB_EVENTS_FLAT),
    "typed_orders": (["raw_orders"], f"""
        select order_id, customer_id, product_id, {to_date('order_date')} as order_date, lower(trim(order_status)) as order_status,
          try_cast(quantity as decimal(18,0)) as quantity, try_cast(unit_price as decimal(10,2)) as unit_price,
          try_cast(discount_pct as decimal(5,2)) as discount_pct, upper(trim(shipping_city)) as shipping_city,
          upper(trim(shipping_country)) as shipping_country, _loaded_at
        from raw_orders"""),
    "clean_orders": (["typed_orders"], """
        select order_id, customer_id, product_id, order_date, order_status, quantity, unit_price, discount_pct,
          cast(round(quantity * unit_price * (100 - coalesce(discount_pct, 0)) * 0.01, 2) as decimal(18,2)) as line_revenue,
          coalesce(discount_pct > 0, false) as is_discounted, shipping_city, shipping_country,
          cast(date_trunc('month', order_date) as date) as order_month, cast(dayofweek(order_date) as integer) as order_day_of_week,
          _loaded_at, 'raw_orders' as _source_file, 'adapter' as _run_id
        from typed_orders where order_id is not null and order_date is not null"""),
    "stg_orders": (["clean_orders"], f"select * from clean_orders {latest('order_id', ORDERS)}"),
    "clean_customers": (["raw_customers"], f"""
        select customer_id, {initcap('customer_name')} as customer_name, lower(trim(email)) as email, trim(phone) as phone,
          {initcap('city')} as city, {initcap('country')} as country, {initcap('segment')} as segment,
          {to_date('signup_date')} as signup_date, cast(datediff('day', {to_date('signup_date')}, {AS_OF}) as integer) as customer_age_days,
          (email is null or email = '') as is_incomplete, _loaded_at
        from raw_customers where customer_id is not null"""),
    "stg_customers": (["clean_customers"], f"select * from clean_customers {latest('customer_id', CUSTOMERS)}"),
    "clean_products": (["raw_products"], f"""
        select product_id, product_name, category, sub_category, supplier, cast(unit_cost as decimal(10,2)) as unit_cost, unit_price,
          stock_qty, is_active, cast(unit_price - unit_cost as decimal(12,2)) as gross_margin_amount,
          {ratio(f"{cents('unit_price - unit_cost')} * 100", cents('unit_price'))} as gross_margin_pct, {STOCK} as stock_status, _loaded_at
        from raw_products where product_id is not null"""),
    "stg_products": (["clean_products"], f"select * from clean_products {latest('product_id', PRODUCTS)}"),
    "clean_web_events": (["raw_web_events"], """
        select event_id, session_id, customer_id, event_type, try_cast(event_ts as timestamp) as event_ts, page, product_id, device, browser, country,
          customer_id is null as is_anonymous, date_trunc('hour', try_cast(event_ts as timestamp)) as event_hour,
          cast(date_trunc('day', try_cast(event_ts as timestamp)) as timestamp) as event_date, _loaded_at
        from raw_web_events where event_id is not null"""),
    "stg_web_events": (["clean_web_events"], f"select * from clean_web_events {latest('event_id', EVENTS)}"),
    "completed": (["stg_orders"], "select * from stg_orders where order_status = 'completed'"),
    "mart_sales": (["completed", "stg_products"], f"""
        select order_date, order_month, order_day_of_week, category, sub_category, shipping_country, order_status,
          count(distinct order_id) as total_orders, count(distinct customer_id) as unique_customers,
          cast(sum(line_revenue) as decimal(28,2)) as total_revenue, {mean('line_revenue')} as avg_order_value,
          cast(sum(quantity) as decimal(28,0)) as total_units_sold,
          cast(sum(case when is_discounted then 1 else 0 end) as bigint) as discounted_orders,
          {pct('sum(case when is_discounted then 1 else 0 end)', 'count(*)')} as discount_rate_pct,
          cast(sum(line_revenue - unit_cost * quantity) as decimal(38,2)) as total_gross_profit,
          {pct(f"sum({cents('line_revenue - unit_cost * quantity')})", f"sum({cents('line_revenue')})")} as gross_profit_margin_pct
        from completed left join (select product_id, category, sub_category, unit_cost from stg_products) p using (product_id)
        group by all"""),
    "customer_orders": (["completed"], f"""
        select customer_id, max(order_date) as last_order_date, min(order_date) as first_order_date, count(distinct order_id) as order_count,
          cast(sum(line_revenue) as decimal(28,2)) as total_spent, {mean('line_revenue')} as avg_order_value
        from completed group by customer_id"""),
    "known": (["customer_orders", "stg_customers"], f"""
        select customer_id, customer_name, email, segment, city, country, signup_date, last_order_date, first_order_date, order_count,
          total_spent, avg_order_value, cast(datediff('day', last_order_date, {AS_OF}) as integer) as recency_days
        from customer_orders join stg_customers using (customer_id)"""),
    "mart_product": (["stg_products", "stg_orders"], f"""
        select p.product_id, product_name, category, sub_category, supplier, p.unit_cost, p.unit_price, gross_margin_pct, stock_status, stock_qty,
          count(distinct order_id) as total_orders, cast(sum(quantity) as decimal(28,0)) as total_units_sold,
          cast(sum(line_revenue) as decimal(28,2)) as total_revenue, {mean('line_revenue')} as avg_order_value,
          count(distinct case when order_status = 'returned' then order_id end) as returned_orders,
          {pct("count(distinct case when order_status = 'returned' then order_id end)", "count(distinct order_id)")} as return_rate_pct,
          cast(rank() over (partition by category order by sum(line_revenue) desc nulls first) as integer) as revenue_rank_in_category
        from stg_products p left join stg_orders o on p.product_id = o.product_id
        group by 1, 2, 3, 4, 5, 6, 7, 8, 9, 10"""),
    "daily": (["completed"], """
        select order_date, cast(sum(line_revenue) as decimal(28,2)) as daily_revenue, count(distinct order_id) as daily_orders
        from completed group by order_date"""),
}


def rfm(directions: tuple[str, str, str]) -> str:
    """Scores by sort direction of recency, frequency and monetary value."""
    recency, frequency, monetary = directions
    nulls = {"asc": "nulls last", "desc": "nulls first"}
    segments = """case when r >= 4 and f >= 4 and m >= 4 then 'Champions' when r >= 3 and f >= 3 then 'Loyal Customers'
          when r >= 4 and f <= 2 then 'New Customers' when r >= 3 and f <= 2 and m >= 3 then 'Potential Loyalists'
          when r <= 2 and f >= 3 and m >= 3 then 'At Risk' when r <= 2 and f >= 4 and m >= 4 then 'Cant Lose Them'
          when r <= 2 and f <= 2 then 'Lost' else 'Needs Attention' end"""
    return f"""
        select * exclude (r, f, m), cast(r as integer) as recency_score, cast(f as integer) as frequency_score, cast(m as integer) as monetary_score,
          cast(((2 * 100 * (r + f + m) + 3) // 6) * 0.01 as decimal(5,2)) as rfm_avg_score,
          concat(cast(r as varchar), cast(f as varchar), cast(m as varchar)) as rfm_cell, {segments} as customer_segment_rfm
        from (select *, ntile(5) over (order by recency_days {recency} {nulls[recency]}, customer_id) as r,
                ntile(5) over (order by order_count {frequency} {nulls[frequency]}, customer_id) as f,
                ntile(5) over (order by total_spent {monetary} {nulls[monetary]}, customer_id) as m from known)"""


def anomalies(source: str, value: str, keep: str, z: str = "2", k: str = "1.5") -> str:
    return f"""
        with stats as (select avg(x) as mean_rev, stddev_samp(x) as stddev_rev, quantile_cont(x, 0.25) as q1, quantile_cont(x, 0.75) as q3
                       from (select cast({value} as double) as x from {source})),
        scored as (select d.*, cast({value} as double) as x, s.*, (cast({value} as double) - mean_rev) / nullif(stddev_rev, 0) as z,
                     q1 - {k} * (q3 - q1) as lower_bound, q3 + {k} * (q3 - q1) as upper_bound from {source} d cross join stats s)
        select {keep}, mean_rev, stddev_rev, round(z, 2) + 0.0 as z_score, lower_bound as iqr_lower_bound, upper_bound as iqr_upper_bound,
          coalesce(abs(z) > {z} or x < lower_bound or x > upper_bound, false) as is_anomaly,
          case when x > mean_rev + {z} * stddev_rev then 'Revenue Spike' when x < mean_rev - {z} * stddev_rev then 'Revenue Drop' else 'Normal' end as anomaly_type
        from scored"""


PARTS["mart_customer_rfm"] = (["known"], rfm(("asc", "desc", "desc")))
PARTS["mart_customer_rfm_turned"] = (["known"], rfm(("desc", "asc", "asc")))
PARTS["mart_anomalies"] = (["daily"], anomalies("daily", "daily_revenue", "order_date, daily_revenue, daily_orders"))
PARTS["hourly"] = (["stg_web_events"], "select event_hour, event_type, count(*) as events from stg_web_events where event_hour is not null group by all")
PARTS["hours"] = (["hourly"], "select event_hour, cast(sum(events) as bigint) as events from hourly group by event_hour")
PARTS["hours_flagged"] = (["hours"], anomalies("hours", "events", "event_hour, events", "1.5", "0.5"))


def sql(parts: list[str], select: str, **replaced: str) -> str:
    """``select`` over the named parts and all that they read; ``replaced`` gives other SQL for a part."""
    needed: list[str] = []

    def add(name: str) -> None:
        for used in PARTS[name][0]:
            add(used)
        if name not in needed:
            needed.append(name)

    for name in parts:
        add(name)
    return "with " + ",\n".join(f"{name} as materialized ({replaced.get(name, PARTS[name][1])})" for name in needed) + f"\n{select}"


def rounded(*columns: str) -> str:
    return "* replace (" + ", ".join(f"round({c}, 4) + 0.0 as {c}" for c in columns) + ")"


STATISTICS = rounded("mean_rev", "stddev_rev", "iqr_lower_bound", "iqr_upper_bound")


def null_tokens(columns: list[str], *tokens: str) -> str:
    return ", ".join("{0} as {1}".format(c if not tokens else f"case when {c} not in ({', '.join(repr(t) for t in tokens)}) then {c} end", c) for c in columns)


def counted(*tables: str) -> str:
    return " union all ".join(f"select '{t}' as tbl, count(*) as row_count from {t}" for t in tables)


RAW_ORDER_COLUMNS = ["order_id", "customer_id", "product_id", "order_date", "order_status", "quantity", "unit_price", "discount_pct", "shipping_city", "shipping_country"]
RAW_CUSTOMER_COLUMNS = ["customer_id", "customer_name", "email", "phone", "city", "country", "segment", "signup_date"]
STAGED = ["stg_orders", "stg_customers", "stg_products", "stg_web_events"]
MARTS = ["mart_sales", "mart_customer_rfm", "mart_product", "mart_anomalies"]
LOADED_ORDERS = sql(["raw_orders"], f"select {null_tokens(RAW_ORDER_COLUMNS, '', 'NULL')} from raw_orders")

ORACLES = {
    **{name: sql([name], f"select * from {name}") for name in [*STAGED, "mart_sales", "mart_customer_rfm", "mart_customer_rfm_turned", "mart_product"]},
    "mart_anomalies": sql(["mart_anomalies"], f"select {STATISTICS} from mart_anomalies"),
    "load_csv_orders": LOADED_ORDERS,
    "load_csv_customers": sql(["raw_customers"], f"select {null_tokens(RAW_CUSTOMER_COLUMNS, '', 'NULL')} from raw_customers"),
    "load_json_products": sql(["raw_products"], "select * exclude (_loaded_at) replace (cast(unit_cost as decimal(10,2)) as unit_cost) from raw_products"),
    "load_json_events": sql(["raw_web_events"], "select * exclude (_loaded_at) from raw_web_events"),
    "lineage_columns": sql(["raw_customers"], """
        select timestamp '2001-01-03 00:00:00' as _loaded_at, 'run-1' as _run_id, count(*) as row_count, count(*) as from_csv from raw_customers"""),
    "run_log": sql(["raw_customers", "raw_products"], """
        select 'raw_customers' as table_name, count(*) as rows_loaded, cast(0 as bigint) as rows_failed, 'SUCCESS' as load_status from raw_customers
        union all select 'raw_products', count(*), cast(0 as bigint), 'SUCCESS' from raw_products"""),
    "length_violations": sql(["raw_customers"], """
        select count(*) filter (length(customer_id) > 3) as customer_id, count(*) filter (length(customer_name) > 200) as customer_name,
          count(*) filter (length(city) > 14) as city, count(*) filter (length(email) > 20) as email from raw_customers"""),
    # a load stamps all its rows alike, so only the tie-break picks among the rows of an order
    "load_rejects": sql(["raw_customers", "raw_web_events"], """
        select *, sum(rejected) over (partition by table_name)::bigint as rows_failed from (
          select 'raw_customers' as table_name, reason, count(*) as rejected, any_value(good) as rows_loaded from (
            select *, count(*) filter (where reason is null) over () as good from (
              select case when length(customer_name) > 200 then 'length of customer_name' when length(city) > 14 then 'length of city'
                when length(case when email in ('', 'NULL') then null else email end) > 20 then 'length of email'
                when signup_date not in ('', 'NULL') and try_cast(signup_date as date) is null then 'no date in signup_date' end as reason from raw_customers))
          where reason is not null group by 2
          union all
          select 'raw_web_events', 'malformed', count(*) filter (where event_type = 'error'), count(*) from raw_web_events)"""),
    "pipeline_counts": sql([*STAGED, *MARTS], counted(*STAGED, *MARTS), raw_orders=f"select * replace (timestamp '2001-01-01 00:00:00' as _loaded_at) from ({adapter.RAW_ORDERS})"),
    "null_if_tokens": sql(["raw_customers"], f"select {null_tokens(['customer_id', 'email', 'signup_date'], '', 'unknown')} from raw_customers"),
    "try_casts": sql(["raw_orders"], f"""
        select order_id, {to_date('order_date')} as order_date, try_cast(quantity as decimal(18,0)) as quantity, try_cast(unit_price as decimal(10,2)) as unit_price,
          try_cast(discount_pct as decimal(5,2)) as discount_pct, try_cast(order_date as timestamp) as order_ts from raw_orders"""),
    "text_clean": sql(["raw_orders"], """
        select order_id, lower(trim(order_status)) as order_status, upper(trim(shipping_city)) as shipping_city, trim(shipping_city) as trimmed_city,
          customer_id || '/' || product_id || cast(length(order_status) as varchar) as joined from raw_orders"""),
    "initcap_words": sql(["raw_customers"], f"""
        select customer_id, {initcap('customer_name')} as customer_name, {initcap('city')} as city, {initcap('country')} as country from raw_customers"""),
    "variant_fields": sql(["raw_products"], """
        select product_id, cast(unit_cost as decimal(10,2)) as unit_cost, stock_qty, is_active, try_cast(product_name as integer) as name_as_number,
          cast(null as varchar) as missing from raw_products"""),
    "date_parts": sql(["raw_orders"], f"""
        select order_id, cast(date_trunc('month', d) as date) as order_month, cast(dayofweek(d) as integer) as order_day_of_week,
          cast(datediff('day', d, {AS_OF}) as integer) as age_days, date_trunc('day', _loaded_at) as loaded_day, date_trunc('hour', _loaded_at) as loaded_hour
        from (select *, {to_date('order_date')} as d from raw_orders)"""),
    "stock_bands": sql(["raw_products"], f"select product_id, stock_qty, {STOCK} as stock_status from raw_products"),
    "safe_pct": sql(["stg_orders"], f"""
        select product_id, {pct("count_if(order_status = 'returned')", 'count(*)')} as return_pct, cast(null as decimal(18,2)) as undefined_pct
        from stg_orders group by product_id"""),
    "latest_per_key_customers": sql(["raw_customers"], f"select * from raw_customers {latest('customer_id', RAW_CUSTOMER_COLUMNS)}"),
    "ntile_global_orders": """
        select o_orderkey, o_totalprice, cast(o_orderdate as date) as o_orderdate,
          cast(ntile(7) over (order by o_totalprice desc nulls first, o_orderkey) as integer) as by_price,
          cast(ntile(7) over (order by cast(o_orderdate as date) nulls last, o_orderkey) as integer) as by_date from orders""",
    "rank_nulls_first": sql(["stg_products", "stg_orders"], """
        select product_id, category, units, cast(rank() over (partition by category order by units desc nulls first) as integer) as units_rank
        from (select product_id, category from stg_products)
          left join (select product_id, cast(sum(quantity) as decimal(28,0)) as units from stg_orders group by product_id) using (product_id)"""),
    "left_join_fact_dim": sql(["stg_orders", "stg_products"], """
        select category, count(*) as lines, cast(sum(line_revenue) as decimal(28,2)) as revenue, cast(sum(p.unit_cost * quantity) as decimal(38,2)) as cost
        from stg_orders o left join stg_products p on o.product_id = p.product_id group by category"""),
    "inner_join_stats": sql(["stg_orders", "stg_customers"], """
        select customer_id, first_order, last_order, segment
        from (select customer_id, min(order_date) as first_order, max(order_date) as last_order from stg_orders group by customer_id)
          join (select customer_id, segment from stg_customers) using (customer_id)"""),
    "left_join_dim_fact": sql(["stg_orders", "stg_products"], """
        select p.product_id, supplier, count(order_id) as lines, cast(sum(quantity) as decimal(28,0)) as units
        from stg_products p left join stg_orders o on p.product_id = o.product_id group by 1, 2"""),
    "cross_join_stats": sql(["stg_orders"], """
        select c.*, s.* from (select shipping_country, cast(sum(line_revenue) as decimal(28,2)) as revenue from stg_orders group by 1) c
        cross join (select cast(sum(revenue) as decimal(38,2)) as all_revenue, max(revenue) as max_revenue
                    from (select cast(sum(line_revenue) as decimal(28,2)) as revenue from stg_orders group by shipping_country)) s"""),
    "merged_reach": sql(["completed"], """
        select shipping_country, count(distinct customer_id) as unique_customers, true as within_4_pct from completed group by shipping_country"""),
    "multi_distinct": sql(["clean_orders"], """
        select shipping_country, count(distinct order_id) as order_ids, count(distinct customer_id) as customers, count(distinct product_id) as products
        from clean_orders group by 1"""),
    "conditional_distinct": sql(["clean_orders"], """
        select product_id, count(distinct order_id) as total_orders, count(distinct case when order_status = 'returned' then order_id end) as returned_orders
        from clean_orders group by 1"""),
    "count_if": sql(["stg_orders"], """
        select order_month, cast(sum(case when is_discounted then 1 else 0 end) as bigint) as discounted, count(*) as lines from stg_orders group by 1"""),
    "mean_amounts": sql(["stg_orders"], f"select order_date, shipping_country, {mean('line_revenue')} as mean_revenue from stg_orders group by 1, 2"),
    "percentile_cont": sql(["daily"], "select " + ", ".join(
        f"round(quantile_cont(cast(daily_revenue as double), {q}), 4) + 0.0 as p{int(q * 100)}" for q in (0.1, 0.25, 0.5, 0.75, 0.9)) + " from daily"),
    "percentile_order_lines": sql(["stg_orders"], "select " + ", ".join(
        f"round(quantile_cont(cast(line_revenue as double), {q}), 4) + 0.0 as p{int(q * 100)}" for q in (0.01, 0.25, 0.5, 0.75, 0.99)) + " from stg_orders"),
    "stddev_daily": sql(["daily"], """
        select round(avg(cast(daily_revenue as double)), 4) + 0.0 as mean_rev, round(stddev_samp(cast(daily_revenue as double)), 4) + 0.0 as stddev_rev from daily"""),
    "zscore_iqr_events": sql(["hours_flagged"], f"select {STATISTICS} from hours_flagged"),
    "layer_row_counts": sql(STAGED, counted(*STAGED)),
    "at_risk_customers": sql(["mart_customer_rfm"], """
        select customer_id, customer_name, email, recency_days, total_spent, rfm_cell from mart_customer_rfm where customer_segment_rfm = 'At Risk'"""),
    "top_margin_products": sql(["mart_product"], """
        select product_id, product_name, category, gross_margin_pct from mart_product order by gross_margin_pct desc nulls last, product_id limit 10"""),
    "anomaly_days": sql(["mart_anomalies"], "select order_date, daily_revenue, z_score, anomaly_type from mart_anomalies where is_anomaly"),
    "revenue_by_day_category_country": sql(["mart_sales"], """
        select order_date, category, shipping_country, cast(sum(total_revenue) as decimal(38,2)) as revenue from mart_sales group by 1, 2, 3"""),
    "top_products_by_revenue": sql(["mart_product"], """
        select product_id, product_name, category, total_revenue, total_units_sold from mart_product order by total_revenue desc nulls last, product_id limit 10"""),
    "rfm_segment_sizes": sql(["mart_customer_rfm"], "select customer_segment_rfm, count(*) as customers from mart_customer_rfm group by 1"),
    "events_hourly": sql(["hourly"], "select * from hourly"),
    "stream_raw_load": LOADED_ORDERS,
    "stream_load_dedup": sql(["stg_orders"], "select *, timestamp '2001-12-31 07:00:00' as _stg_updated_at from stg_orders"),
    "stream_events_hourly": sql(["hourly"], "select * from hourly"),
}
for _again, _as in {"load_json_array_products": "load_json_products", "load_json_array_events": "load_json_events",
                    "load_json_mixed_layouts": "load_json_events", "stream_json_array_products": "load_json_products",
                    "stream_raw_load_documents": "load_json_events", "published_mart_sales": "mart_sales",
                    "grown_mart_sales": "mart_sales", "grown_mart_customer_rfm": "mart_customer_rfm", "grown_mart_product": "mart_product",
                    "grown_mart_anomalies": "mart_anomalies", "compacted_events_hourly": "events_hourly", "published_stg_orders": "stg_orders",
                    "published_mart_customer_rfm": "mart_customer_rfm", "published_mart_product": "mart_product", "published_mart_anomalies": "mart_anomalies"}.items():
    ORACLES[_again] = ORACLES[_as]
