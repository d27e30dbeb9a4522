import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks import adapter
from lakemart.plans import marts, questions, refresh, staging
from lakemart.workspace import Stored, shared_folder

AS_OF = dt.date(2001, 12, 31)


def initial_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def orders(spark, small):
    return Stored(staging.stg_orders(adapter.raw(spark, small, "orders")), "test-orders").df


@pytest.fixture(scope="module")
def products(spark, small):
    return Stored(staging.stg_products(adapter.raw(spark, small, "products")), "test-products").df


@pytest.fixture(scope="module")
def customers(spark, small):
    return Stored(staging.stg_customers(adapter.raw(spark, small, "customers"), AS_OF), "test-customers").df


def test_staged_columns(spark, small, orders, products, customers):
    events = staging.stg_web_events(adapter.raw(spark, small, "web_events"))
    assert [len(df.columns) for df in (orders, customers, products, events)] == [18, 12, 14, 15]
    assert dict(orders.dtypes)["line_revenue"] == "decimal(18,2)"
    assert dict(events.dtypes)["event_date"] == "timestamp_ntz"
    assert dict(products.dtypes)["_stg_updated_at"] == "timestamp"


def test_orders_without_id_or_date_drop_out(spark):
    row = {**{c: "1" for c in ("customer_id", "product_id", "quantity", "unit_price", "discount_pct")},
           "order_status": " Completed ", "shipping_city": " oslo ", "shipping_country": "no", "_source_file": "f", "_run_id": "r"}
    rows = [{**row, "order_id": i, "order_date": d, "_loaded_at": dt.datetime(2024, 1, 1)} for i, d in
            [("a", "2024-02-29"), (None, "2024-02-29"), ("b", "bad"), ("c", None)]]
    (got,) = staging.stg_orders(spark.createDataFrame(rows)).collect()
    assert (got["order_id"], got["order_status"], got["shipping_city"], got["order_month"], got["order_day_of_week"]) == (
        "a", "completed", "OSLO", dt.date(2024, 2, 1), 4)


def test_bad_signup_date_keeps_the_customer(customers):
    assert customers.filter("signup_date is null and customer_age_days is null").count() > 0


def test_loading_twice_changes_nothing(spark, small, orders):
    raw = adapter.raw(spark, small, "orders")
    twice = staging.stg_orders(raw.unionByName(raw)).drop("_stg_updated_at")
    assert twice.exceptAll(orders.drop("_stg_updated_at")).count() == 0
    assert twice.count() == orders.count()


def test_sales_add_up(orders, products):
    sales = marts.mart_sales(orders, products)
    assert len(sales.columns) == 16
    assert sales.agg(F.sum("total_revenue")).first()[0] == marts.completed(orders).agg(F.sum("line_revenue")).first()[0]
    assert {r[0] for r in sales.select("order_status").distinct().collect()} == {"completed"}
    unknown = sales.filter("category is null")
    assert unknown.filter("total_revenue is not null").count() > 0
    assert unknown.filter("total_gross_profit is not null").count() == 0


def test_sales_plan(orders, products):
    tree = initial_plan(marts.mart_sales(orders, products))
    assert "PushedFilters: [IsNotNull(order_status), EqualTo(order_status,completed)]" in tree
    assert "Expand" not in tree
    scan = next(line for line in tree.splitlines() if "FileScan" in line and "line_revenue" in line)
    assert "shipping_city" not in scan and "order_month" not in scan


def test_rfm_over_ranges_equals_the_windows(orders, customers):
    ranged = marts.mart_customer_rfm(orders, customers, AS_OF, single_task_rows=20)
    plain = marts.mart_customer_rfm(orders, customers, AS_OF)
    assert len(ranged.columns) == 19
    assert ranged.exceptAll(plain).count() == 0
    assert ranged.count() == plain.count() > 100
    assert "SinglePartition" not in initial_plan(ranged)


def test_rfm_turned_round(orders, customers):
    usual = marts.mart_customer_rfm(orders, customers, AS_OF).select("customer_id", "monetary_score")
    turned = marts.mart_customer_rfm(orders, customers, AS_OF, best_is_high=True).select("customer_id", F.col("monetary_score").alias("m"))
    sums = usual.join(turned, "customer_id").select(F.col("monetary_score") + F.col("m")).distinct().collect()
    assert {r[0] for r in sums} <= {5, 6, 7}


def test_product_plan_aggregates_before_the_join(orders, products):
    product = marts.mart_product(products, orders)
    assert len(product.columns) == 17
    assert product.count() == products.count()
    assert product.filter("total_orders = 0 and revenue_rank_in_category = 1 and return_rate_pct is null").count() > 0
    tree = initial_plan(product)
    assert tree.index("Join") < tree.index("HashAggregate")


def test_product_ranks_over_ranges(orders, products):
    ranged = marts.mart_product(products, orders, single_task_rows=10)
    assert ranged.exceptAll(marts.mart_product(products, orders)).count() == 0


def test_anomalies_read_orders_once(orders):
    anomalies = marts.mart_anomalies(orders)
    anomalies.collect()
    final = initial_plan(anomalies).split("\n+- == Initial Plan ==")[0]
    assert "ReusedExchange" in final.split("Subquery subquery", 1)[1].split("Initial Plan")[0]
    assert "NestedLoop" not in final
    assert len(anomalies.columns) == 10
    days = [r[0] for r in anomalies.select("order_date").collect()]
    assert days == sorted(days)


def test_hot_keys_give_the_same_marts(spark, orders, products, customers):
    """Half of all orders move to one customer, product and day."""
    hot = orders.withColumns({
        c: F.when(F.crc32("order_id") % 2 == 0, F.lit(v)).otherwise(F.col(c))
        for c, v in {"customer_id": "C1", "product_id": "P1", "order_date": dt.date(1997, 1, 1)}.items()
    })
    sales = marts.mart_sales(hot, products)
    rows = marts.completed(hot).join(products.select("product_id", "category", "sub_category"), "product_id", "left")
    want = rows.groupBy("order_date", "category", "sub_category", "shipping_country").agg(
        F.countDistinct("order_id").alias("total_orders"), F.countDistinct("customer_id").alias("unique_customers"))
    assert sales.select(*want.columns).exceptAll(want).count() == 0
    assert marts.mart_customer_rfm(hot, customers, AS_OF).filter("customer_id = 'C1'").first()["order_count"] > 500


def test_questions(orders, products, customers):
    rfm = Stored(marts.mart_customer_rfm(orders, customers, AS_OF), "test-rfm").df
    product = Stored(marts.mart_product(products, orders), "test-product").df
    assert questions.rfm_segment_sizes(rfm).agg(F.sum("customers")).first()[0] == rfm.count()
    assert questions.at_risk_customers(rfm).count() == rfm.filter("customer_segment_rfm = 'At Risk'").count()
    top = [r["total_revenue"] for r in questions.top_products_by_revenue(product, 5).collect()]
    assert len(top) == 5 and None not in top and top == sorted(top, reverse=True)
    assert "TakeOrderedAndProject" in initial_plan(questions.top_margin_products(product))
    assert questions.anomaly_days(marts.mart_anomalies(orders)).filter("anomaly_type is null").count() == 0


def test_refresh_from_files_to_marts(spark, small, lake):
    for name in adapter.SQL:
        run = f"run-{name}"
        lake.append_raw(f"raw_{name}", adapter.raw(spark, small, name).withColumn("_run_id", F.lit(run)), run)
    staged = refresh.refresh_staging(lake, AS_OF, partition_orders=True)
    built = refresh.refresh_marts(lake, AS_OF)
    assert {r["tbl"]: r["row_count"] for r in refresh.counts(lake, lake.stg).collect()} == staged
    assert {r["tbl"]: r["row_count"] for r in refresh.counts(lake, lake.marts).collect()} == built
    again = refresh.refresh_marts(lake, AS_OF)
    assert again == built
    sales = lake.table(lake.marts, "mart_sales").filter("order_month = date'1997-01-01'")
    assert "PartitionFilters: [isnotnull(order_month" in initial_plan(sales)


def test_scratch_is_deleted_after_a_refresh(spark, orders, customers):
    from lakemart.workspace import exists, scratch

    with scratch(spark):
        stored = Stored(orders.limit(1), "test-scratch")
        assert stored.rows == 1 and stored.path.startswith(shared_folder(spark))
    assert not exists(spark, stored.path)
