import datetime as dt
import random
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakemart.operators.dedup import latest_per_key
from lakemart.plans import marts, staging
from lakemart.sources import latest
from lakemart.plans.incremental import _added, refresh_marts_from
from lakemart.sources.latest import LatestTable, Snapshot
from lakemart.streaming.hourly import add_events, compact_hourly, read_hourly
from lakemart.streaming.loads import latest_table
from lakemart.workspace import Stored, complete_folders, file_names, stored_bytes

COLUMNS = "k string, _loaded_at timestamp_ntz, v int"


def changes(spark, *rows):
    return spark.createDataFrame([(k, None if day is None else dt.datetime(2024, 1, day), v) for k, day, v in rows], COLUMNS)


def content(df):
    return sorted((r["k"], r["v"]) for r in df.select("k", "v").collect())


def test_latest_through_deltas_and_compaction(spark, tmp_path):
    told = []
    table = LatestTable(spark, str(tmp_path / "t"), "k", switch=told.append)
    draw, rows = random.Random(4), []
    for batch in range(5):
        new = [(f"k{draw.randint(0, 12)}", draw.choice([None, 1, 2, 3, 4]), draw.randint(0, 99)) for _ in range(8)]
        rows += new
        table.add(changes(spark, *new), f"{batch:03d}")
        table.add(changes(spark, *new), f"{batch:03d}")  # repeated after a failure
        want = content(latest_per_key(changes(spark, *rows), ["k"], "_loaded_at"))
        assert content(table.read()) == content(spark.sql(told[-1])) == want
        if batch in (1, 3):
            assert table.compact(share=10 if batch == 3 else 0, most_deltas=1) == ("delta" if batch == 3 else "base")
            assert content(table.read()) == content(spark.sql(told[-1])) == want
    some = spark.createDataFrame([("k1",), ("k5",), ("nobody",)], "k string")
    assert content(table.read(keys=some)) == [r for r in want if r[0] in ("k1", "k5")]
    assert table.compact(share=10) is None


def test_deltas_cost_what_they_bring(spark, tmp_path):
    table = LatestTable(spark, str(tmp_path / "t"), "k")
    big = spark.range(20000).selectExpr("concat('k', id) k", "timestamp_ntz '2024-01-01 00:00:00' _loaded_at", "cast(id as int) v")
    table.add(big, "a")
    table.compact()
    before = stored_bytes(spark, table.folder)
    table.add(changes(spark, ("k7", 2, -1)), "b")
    assert stored_bytes(spark, table.folder) - before < 3000 and table.read().where("v = -1").count() == 1 and table.read().count() == 20000
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_changed_keys_and_what_is_forgotten(spark, tmp_path):
    table = LatestTable(spark, str(tmp_path / "t"), "k")
    assert table.snapshot().empty
    table.add(changes(spark, ("a", 1, 1), ("b", 1, 1)), "1")
    old = table.snapshot()
    assert table.changed_keys(old, table.snapshot()).count() == 0
    table.add(changes(spark, ("b", 2, 2), ("c", 1, 1)), "2")
    keys = lambda: sorted(r[0] for r in table.changed_keys(old, table.snapshot()).collect())
    assert keys() == ["b", "c"]
    table.compact(share=0)
    assert keys() == ["b", "c"] and content(table.read(old)) == [("a", 1), ("b", 1)]
    assert content(table.read(old, table.changed_keys(old, table.snapshot()))) == [("b", 1)]
    for i in range(3):
        table.add(changes(spark, ("d", 1, i)), f"3{i}")
        table.compact(share=0)
    assert table.changed_keys(old, table.snapshot()) is None
    assert len(complete_folders(spark, f"{table.folder}/base")) == 2 and len(complete_folders(spark, f"{table.folder}/deltas")) == 1
    with pytest.raises(LookupError):
        LatestTable(spark, str(tmp_path / "none"), "k").read()


def test_merged_deltas_are_no_news(spark, tmp_path):
    table = LatestTable(spark, str(tmp_path / "t"), "k")
    table.add(changes(spark, *[(f"k{i}", 1, i) for i in range(500)]), "0")
    table.compact()
    for i in range(3):
        table.add(changes(spark, ("a", 1 + i, i)), f"1{i}")
    old = table.snapshot()
    assert table.compact(share=100, most_deltas=2) == "delta"
    assert table.changed_keys(old, table.snapshot()).count() == 0 and len(table.snapshot().deltas) == 1


def test_hourly_counts_over_a_compacted_state(spark, tmp_path):
    path = str(tmp_path / "h")
    event = lambda i, hour, day: (f"e{i}", "view", None if hour is None else dt.datetime(2024, 1, 1, hour), dt.datetime(2024, 2, day))
    schema = "event_id string, event_type string, event_hour timestamp_ntz, _loaded_at timestamp_ntz"
    assert read_hourly(spark, path).count() == 0
    batches = [[event(i, i % 5, 1) for i in range(40)], [event(3, 9, 2), event(4, None, 2), event(99, 1, 1)], [event(3, 0, 3), event(5, 4, 1)], [event(5, 7, 1)]]
    seen = {}
    for n, batch in enumerate(batches):
        add_events(spark, spark.createDataFrame(batch, schema), path, n)
        for e, _, hour, loaded in batch:
            seen[e] = max(seen.get(e, (dt.datetime(1, 1, 1), None)), (loaded, hour), key=lambda x: (x[0], x[1] is None, x[1] or x[0]))
        want = {}
        for _, hour in seen.values():
            if hour is not None:
                want[hour] = want.get(hour, 0) + 1
        check = lambda: {r["event_hour"]: r["events"] for r in read_hourly(spark, path).collect()}
        assert check() == want
        compact_hourly(spark, path, share=0 if n in (0, 2) else 9)
        assert check() == want
    assert len(file_names(spark, f"{path}/counts")) == 2


@pytest.fixture
def staged(spark, lake):
    products = [(f"p{i}", f"n{i}", f"c{i % 2}", f"s{i % 3}", "x", 1.5 + i, 9.0, 40, True, 2.0, 20.0, "In Stock") for i in range(6)]
    schema = "product_id string, product_name string, category string, sub_category string, supplier string, unit_cost decimal(10,2), unit_price decimal(10,2), stock_qty int, is_active boolean, gross_margin_amount decimal(18,2), gross_margin_pct decimal(18,2), stock_status string"
    from decimal import Decimal

    rows = [tuple(Decimal(str(x)) if isinstance(x, float) else x for x in r) for r in products]
    publish = lambda found: lake.publish(lake.stg, "stg_products", spark.createDataFrame(found, schema))
    publish(rows)
    people = [(f"u{i}", f"N{i}", None, "S", "city", "land", dt.date(2020, 1, 1)) for i in range(5)]
    lake.publish(lake.stg, "stg_customers", spark.createDataFrame(people, "customer_id string, customer_name string, email string, segment string, city string, country string, signup_date date"))
    return rows, publish


def some_orders(spark, draw, count, day):
    """Raw orders of few ids, so that later ones change earlier ones."""
    rows = [(
        f"o{draw.randint(0, 60)}", draw.choice(["u0", "u1", "u2", "u9", None]), draw.choice(["p0", "p1", "p2", "p7", None]), f"2024-0{draw.randint(1, 4)}-1{draw.randint(0, 3)}",
        draw.choice(["completed", "completed", "returned", "pending"]), draw.choice(["1", "2", "n/a"]), draw.choice(["9.99", "5.00", "?"]), draw.choice(["10", None]),
        "city", draw.choice(["a", "b"]), dt.datetime(2024, 5, day), "f", "r",
    ) for _ in range(count)]
    schema = "order_id string, customer_id string, product_id string, order_date string, order_status string, quantity string, unit_price string, discount_pct string, shipping_city string, shipping_country string, _loaded_at timestamp_ntz, _source_file string, _run_id string"
    return staging.clean_orders(spark.createDataFrame(rows, schema))


AS_OF = dt.date(2024, 6, 1)


def compare_marts(lake, table):
    orders, customers, products = table.read(), lake.table(lake.stg, "stg_customers"), lake.table(lake.stg, "stg_products")
    want = {
        "mart_sales": marts.mart_sales(orders, products), "mart_customer_rfm": marts.mart_customer_rfm(orders, customers, AS_OF),
        "mart_product": marts.mart_product(products, orders), "mart_anomalies": marts.mart_anomalies(orders),
    }
    for name, made in want.items():
        got = lake.table(lake.marts, name)
        assert got.dtypes == made.dtypes, name
        plain = lambda df: sorted(str([round(x, 6) if isinstance(x, float) else x for x in r]) for r in df.collect())
        assert plain(got) == plain(made), name


def test_refresh_from_changes_equals_a_rebuild(spark, lake, staged):
    rows, publish = staged
    draw = random.Random(2)
    table = latest_table(lake, "stg_orders", "order_id")
    table.add(some_orders(spark, draw, 80, 1), "1")
    refresh_marts_from(lake, table, AS_OF)
    compare_marts(lake, table)
    table.add(some_orders(spark, draw, 6, 2), "2")
    refresh_marts_from(lake, table, AS_OF)
    compare_marts(lake, table)
    publish([(*rows[0][:2], "c9", *rows[0][3:]), *rows[2:]])  # a category changes, a product goes
    table.compact(share=0)
    table.add(some_orders(spark, draw, 10, 3), "3")
    refresh_marts_from(lake, table, AS_OF)
    compare_marts(lake, table)
    assert len(file_names(spark, f"{lake.log_folder(lake.marts, 'totals')}/states")) == 2


def test_refresh_writes_touched_months_only(spark, lake, staged):
    draw = random.Random(7)
    table = latest_table(lake, "stg_orders", "order_id")
    table.add(some_orders(spark, draw, 60, 1), "1")
    refresh_marts_from(lake, table, AS_OF)
    table.add(some_orders(spark, draw, 200, 2).where("order_date < '2024-02-01'").limit(1).withColumn("order_id", F.lit("new")), "2")
    refresh_marts_from(lake, table, AS_OF)
    folder = f"{lake.log_folder(lake.marts, 'totals')}/mart_sales"
    versions = complete_folders(spark, folder)
    assert [n for n in file_names(spark, f"{folder}/{versions[-1]}") if n.startswith("order_month")] == ["order_month=2024-01-01"]
    compare_marts(lake, table)
    refresh_marts_from(lake, table, AS_OF)  # nothing new
    assert complete_folders(spark, folder) == versions
    compare_marts(lake, table)


def test_refresh_starts_anew_where_the_old_rows_are_gone(spark, lake, staged):
    draw = random.Random(9)
    table = latest_table(lake, "stg_orders", "order_id")
    table.add(some_orders(spark, draw, 30, 1), "1")
    refresh_marts_from(lake, table, AS_OF)
    for i in range(2, 5):
        table.add(some_orders(spark, draw, 10, i), str(i))
        table.compact(share=0)
    assert table.changed_keys(Snapshot(None, ("1",)), table.snapshot()) is None
    refresh_marts_from(lake, table, AS_OF)
    compare_marts(lake, table)


def test_one_delta_is_not_sorted_again(spark, tmp_path):
    table = LatestTable(spark, str(tmp_path / "t"), "k")
    table.add(changes(spark, ("a", 1, 1), ("a", 2, 2), (None, 1, 3), (None, 2, 4)), "1")
    assert "row_number" not in table.sql(table.snapshot()) and content(table.read().where("k is not null")) == [("a", 2)] and table.read().count() == 2


def test_one_part_of_totals_is_not_added_again(spark):
    part = spark.createDataFrame([("a", 2, 5, 1), (None, 1, 7, 2), ("b", 0, 0, 3)], "k string, lines bigint, units bigint, day int")
    types, others = {"lines": "bigint", "units": "decimal(38,0)"}, {"day": F.max("day")}
    one, two = _added([part], ["k"], types, others), _added([part, part.limit(0)], ["k"], types, others)
    assert one.dtypes == two.dtypes and set(one.collect()) == set(two.collect()) and one.count() == 2
    assert "Exchange" not in one._jdf.queryExecution().executedPlan().toString()


def test_more_rows_make_more_landed_files(spark, tmp_path, monkeypatch):
    from checks import queries

    spark.range(1000).write.parquet(f"{tmp_path}/lineitem.parquet")
    assert queries.landed_files(spark, str(tmp_path), "lineitem", 4) == 4
    monkeypatch.setattr(queries, "FILE_ROWS", 50)
    assert queries.landed_files(spark, str(tmp_path), "lineitem", 4) == 20


def test_shuffle_files_go_with_the_write(spark, tmp_path):
    """The disk of a refresh holds the shuffle of one statement, not those of all before it."""
    dirs = [d.getPath() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {f for d in dirs for f in Path(d).rglob("shuffle_*")}
    before, setting = files(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    stored = Stored(spark.range(5000).groupBy((F.col("id") % 3000).alias("k")).agg(F.count("*").alias("n")), "counted")
    for _ in range(50):  # files are removed in the background
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before and stored.rows == stored.df.count() == 3000
    assert spark.conf.get(setting, "false") == "false"


def test_many_changes_are_read_in_one_shuffle(spark, tmp_path):
    table = LatestTable(spark, str(tmp_path / "t"), "k")
    rows = lambda ids, v: spark.createDataFrame([(f"k{i}", dt.datetime(2024, 1, 1 + v), v) for i in ids] + [(None, dt.datetime(2024, 1, 1 + v), v)], COLUMNS)
    table.add(rows(range(400), 0), "a")
    old = table.snapshot()
    table.compact()
    table.add(rows(range(300, 500), 1), "b")
    table.add(rows(range(450, 520), 2), "c")
    assert table.many_changed(old, table.snapshot())
    want = {**{f"k{i}": 0 for i in range(300)}, **{f"k{i}": 1 for i in range(300, 450)}, **{f"k{i}": 2 for i in range(450, 520)}, None: 2}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        read, keys = table.read(), table.changed_keys(old, table.snapshot()).union(spark.createDataFrame([("nobody",)], "k string"))
        marked = table.marked(table.snapshot(), keys, "seen")
        for df, shuffles in ((read, 1), (table.marked(table.snapshot(), Stored(keys, "keys").df, "seen"), 1)):
            assert df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == shuffles
        assert read.count() == len(want) and {r["k"]: r["v"] for r in read.collect()} == want
        assert marked.columns == [*read.columns, "seen"] and {r["k"]: r["v"] for r in marked.collect()} == want
        assert {r["k"] for r in marked.where("seen").collect()} == {None, *(f"k{i}" for i in range(300, 520))}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("many", [0, 1e9])
def test_few_and_many_changes_give_the_same_marts(spark, lake, staged, monkeypatch, many):
    monkeypatch.setattr(latest, "MANY", many)
    rows, publish = staged
    draw = random.Random(3)
    table = latest_table(lake, "stg_orders", "order_id")
    table.add(some_orders(spark, draw, 80, 1), "1")
    refresh_marts_from(lake, table, AS_OF)
    table.compact()
    table.add(some_orders(spark, draw, 30, 2), "2")
    refresh_marts_from(lake, table, AS_OF)
    table.add(some_orders(spark, draw, 20, 3), "3")
    publish([(*rows[0][:2], "c9", *rows[0][3:]), *rows[2:]])
    refresh_marts_from(lake, table, AS_OF)  # its old state is a base and a delta
    compare_marts(lake, table)


def test_derived_columns_break_no_tie(spark, tmp_path):
    table = LatestTable(spark, str(tmp_path / "t"), "k")
    seen = []
    derive = lambda rows: seen.append(rows.columns) or rows.withColumn("half", F.col("v") / 2)
    table.add(changes(spark, ("a", 1, 3), ("a", 1, 5), ("b", 2, 4)), "1", derive)
    assert seen == [["k", "_loaded_at", "v"]]
    assert {(r["k"], r["v"], r["half"]) for r in table.read().collect()} == {("a", 5, 2.5), ("b", 4, 2.0)}
