import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from checks import adapter, queries
from lakemart.plans import staging
from lakemart.operators.dedup import latest_per_key
from lakemart.streaming.hourly import add_events, hourly_events, read_hourly
from lakemart.streaming.loads import merge_latest, read_latest, stream_raw
from lakemart.workspace import file_names, shared_folder, stored_bytes

HEADER = "customer_id,customer_name,email,phone,city,country,segment,signup_date\n"


def test_stream_loads_only_new_files(spark, lake, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    run = lambda: stream_raw(lake, "raw_customers", str(drop), str(tmp_path / "ckpt")).awaitTermination()
    (drop / "a.csv").write_text(HEADER + "1,x,,p,c,n,s,2024-01-01\n")
    run()
    (drop / "b.csv").write_text(HEADER + "2,y,NULL,p,c,n,s,2024-01-01\n3,z,e,p,c,n,s,d\n")
    run()
    run()
    rows = lake.table(lake.raw, "raw_customers").orderBy("customer_id").collect()
    assert [(r["customer_id"], r["email"], r["_source_file"].rsplit("/")[-1]) for r in rows] == [("1", None, "a.csv"), ("2", None, "b.csv"), ("3", "e", "b.csv")]
    assert len({r["_run_id"] for r in rows}) == 2
    assert sorted(r["rows_loaded"] for r in lake.runs().collect()) == [1, 2]


def test_stream_of_documents(spark, lake, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    (drop / "a.json").write_text("\n".join(json.dumps({"event_id": f"e{i}"}) for i in range(3)))
    stream_raw(lake, "raw_web_events", str(drop), str(tmp_path / "ckpt")).awaitTermination()
    assert lake.table(lake.raw, "raw_web_events").selectExpr("variant_get(raw_data, '$.event_id', 'string') e").distinct().count() == 3


def changes(spark, *rows):
    return spark.createDataFrame([(k, dt.datetime(2024, 1, day), v) for k, day, v in rows], "k string, _loaded_at timestamp_ntz, v int")


def test_merge_keeps_the_latest_and_can_be_repeated(spark, tmp_path):
    table, aside = str(tmp_path / "t"), str(tmp_path / "m")
    merge_latest(spark, changes(spark, ("a", 1, 1), ("b", 2, 1), ("b", 1, 0)), "k", table, aside + "0", 4)
    merge_latest(spark, changes(spark, ("b", 1, 9), ("c", 3, 1), ("a", 2, 2)), "k", table, aside + "1", 4)
    want = {("a", 2), ("b", 1), ("c", 1)}
    assert {(r["k"], r["v"]) for r in read_latest(spark, table).collect()} == want
    merge_latest(spark, changes(spark, ("b", 1, 9), ("c", 3, 1), ("a", 2, 2)), "k", table, aside + "1", 4)
    assert sorted((r["k"], r["v"]) for r in read_latest(spark, table).collect()) == sorted(want)


def test_merge_refuses_another_number_of_buckets(spark, tmp_path):
    merge_latest(spark, changes(spark, ("a", 1, 1)), "k", str(tmp_path / "t"), str(tmp_path / "m0"), 4)
    with pytest.raises(ValueError, match="4 buckets"):
        merge_latest(spark, changes(spark, ("a", 2, 1)), "k", str(tmp_path / "t"), str(tmp_path / "m1"), 8)


def test_hourly_stream_counts_late_and_corrected_events(spark, small, tmp_path):
    """Files in falling time order, and a second version of some events in another hour."""
    raw = adapter.raw(spark, small, "web_events")
    events = staging.clean_web_events(raw).select("event_id", "event_type", "event_hour", "_loaded_at")
    moved = events.limit(20).withColumns({"event_hour": F.expr("event_hour + interval 5 hours"), "_loaded_at": F.expr("_loaded_at + interval 9 days")})
    for i, part in enumerate((events.where("event_hour >= '2024-01-20'"), events.where("event_hour < '2024-01-20' or event_hour is null"), moved, events.limit(30))):
        add_events(spark, part, str(tmp_path / "out"), i)
        add_events(spark, part, str(tmp_path / "out"), i)  # repeated after a failure
    want = hourly_events(latest_per_key(events.union(moved), ["event_id"], "_loaded_at"))
    got = read_hourly(spark, str(tmp_path / "out"))
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0


def raw_orders(spark, ids, copies):
    """Raw orders of few ids, each with ``copies`` rows that differ in load time and quantity, side by side."""
    schema = "order_id string, customer_id string, product_id string, order_date string, order_status string, quantity string, unit_price string, discount_pct string, shipping_city string, shipping_country string, _loaded_at timestamp_ntz, _source_file string, _run_id string"
    rows = [(None if i % 11 == 10 else f"o{i}", "c", None, "2024-01-05", "Completed", str(n), "2.50", None if n % 2 else "10", "x", "y", dt.datetime(2024, 1, 1 + n % 3), "f", "r")
            for i in range(ids) for n in range(copies)]
    return spark.createDataFrame(rows, schema).coalesce(2)


def test_rows_are_dealt_without_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(queries, "FILE_ROWS", 50)
    raw = raw_orders(spark, 200, 2)
    status, group = spark.sparkContext.statusTracker(), "dealt"
    spark.sparkContext.setJobGroup(group, group)
    try:
        drops = queries.dealt(raw, 2)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [len(status.getJobInfo(job).stageIds) for job in status.getJobIdsForGroup(group)] == [1]
    read = [spark.read.schema(raw.schema).parquet(d) for d in drops]
    assert [df.count() for df in read] == [200, 200]
    assert read[0].join(read[1], "order_id").count() > 100  # copies of an order come in both
    assert read[0].unionByName(read[1]).exceptAll(raw).isEmpty() and raw.exceptAll(read[0].unionByName(read[1])).isEmpty()
    assert max(r[0] for df in read for r in df.groupBy(F.input_file_name()).count().select("count").collect()) <= 50


@pytest.mark.parametrize("ids", [0, 1, 60])
def test_streamed_orders_are_the_latest_and_leave_no_input_behind(spark, monkeypatch, ids):
    raw = raw_orders(spark, ids, 5) if ids != 1 else raw_orders(spark, 1, 1)
    monkeypatch.setattr(queries.adapter, "raw", lambda *_: raw)
    known = set(file_names(spark, shared_folder(spark)))
    got = queries.stream_load_dedup(spark, "")
    want = staging.stg_orders(raw, queries.LOADED)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.count() == {0: 0, 1: 1, 60: 55}[ids]
    new = set(file_names(spark, shared_folder(spark))) - known
    left = [n for n in new if n.startswith(("landed", "arrived")) or (n.startswith("dealt") and stored_bytes(spark, f"{shared_folder(spark)}/{n}"))]
    assert not left
