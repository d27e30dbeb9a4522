import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F

from lakemart.sources import moves, readers, schemas, sinks
from lakemart.sources.lake import FAILED, SUCCESS
from lakemart.sources.loads import load_raw, read_raw

ORDERS = "order_id,customer_id,product_id,order_date,order_status,quantity,unit_price,discount_pct,shipping_city,shipping_country\n"
PRODUCTS = [{"product_id": "p1", "unit_cost": 1.5, "is_active": True}, {"product_id": None, "tags": [1]}]


@pytest.fixture
def drop(tmp_path):
    folder = tmp_path / "drop"
    folder.mkdir()
    return folder


def test_csv_quotes_nulls_and_blanks(spark, lake, drop):
    (drop / "o.csv").write_text(ORDERS + '1,,NULL,"x, ""y"" z",  sp  ,1,2,3,a,b\n2,"","NULL",d,s,1,2,3,a,b\n')
    load_raw(lake, "raw_orders", str(drop), "run-a")
    rows = lake.table("%s" % lake.raw, "raw_orders").orderBy("order_id").collect()
    assert [(r["customer_id"], r["product_id"]) for r in rows] == [(None, None), (None, None)]
    assert (rows[0]["order_date"], rows[0]["order_status"]) == ('x, "y" z', "  sp  ")
    assert {r["_run_id"] for r in rows} == {"run-a"}
    assert rows[0]["_source_file"].endswith("/drop/o.csv")
    assert rows[0]["_loaded_at"] is not None


def test_header_is_skipped_by_position(spark, lake, drop):
    (drop / "o.csv").write_text("a,b,c,d,e,f,g,h,i,j\n1,2,3,4,5,6,7,8,9,10\n")
    row = read_raw(lake, "raw_orders", str(drop), "r").first()
    assert (row["order_id"], row["shipping_country"]) == ("1", "10")


def test_compressed_files_and_line_breaks(spark, drop):
    with gzip.open(drop / "c.csv.gz", "wt") as f:
        f.write(ORDERS + '1,c,p,d,"two\nlines",1,2,3,a,b\n')
    got = readers.read_delimited(spark, str(drop), "raw_orders", multiline=True).collect()
    assert [r["order_status"] for r in got] == ["two\nlines"]


def test_bad_record_fails_the_load_and_is_logged(spark, lake, drop):
    (drop / "o.csv").write_text(ORDERS + "1,2\n")
    with pytest.raises(Exception):
        load_raw(lake, "raw_orders", str(drop), "run-bad")
    assert lake.table(lake.raw, "raw_orders").count() == 0
    (entry,) = lake.runs().collect()
    assert (entry["load_status"], entry["rows_loaded"]) == (FAILED, None)
    assert entry["error_message"]


def test_json_lines_and_arrays_give_the_same_documents(spark, lake, drop):
    (drop / "lines.json").write_text("\n".join(map(json.dumps, PRODUCTS)))
    (drop / "array.json").write_text(json.dumps(PRODUCTS, indent=2))
    lines = read_raw(lake, "raw_products", str(drop / "lines.json"), "r")
    array = read_raw(lake, "raw_products", str(drop / "array.json"), "r", array_files=True)
    want = [{"is_active": True, "product_id": "p1", "unit_cost": 1.5}, {"product_id": None, "tags": [1]}]
    split = read_raw(lake, "raw_products", str(drop / "array.json"), "r", array_files=True, indent=2)
    for df in (lines, array, split):
        got = [json.loads(r[0]) for r in df.select(F.to_json("raw_data")).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
        assert df.select("_source_file").first()[0].endswith(".json")


def test_large_indented_arrays_are_split(spark, drop):
    documents = [{"id": i, "note": 'a } ] "quoted",\n  },\n', "tags": [i, {"deep": {}}], "empty": []} for i in range(20_000)]
    (drop / "a.json").write_text(json.dumps(documents, indent=2))
    (drop / "none.json").write_text("[]\n")
    (drop / "one.json").write_text(json.dumps([{"id": -1}], indent=2) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200KB")
    try:
        df = readers.read_json_arrays(spark, str(drop), indent=2)
        assert df.rdd.getNumPartitions() > 5
        got = [json.loads(r[0]) for r in df.select(F.to_json("raw_data")).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(got, key=lambda d: d["id"]) == [{"id": -1}, *documents]


@pytest.mark.parametrize("array_files", [False, True])
def test_bad_json_fails(spark, lake, drop, array_files):
    (drop / "bad.json").write_text('[{"a": 1}, {"a": ' if array_files else '{"a": 1}\n{"a": }\n')
    with pytest.raises(Exception):
        read_raw(lake, "raw_products", str(drop), "r", array_files=array_files).collect()


def test_load_counts_logs_and_archives(spark, lake, drop, tmp_path):
    (drop / "o.csv").write_text(ORDERS + "1,2,3,4,5,6,7,8,9,10\n")
    assert load_raw(lake, "raw_orders", str(drop / "o.csv"), archive_to=str(tmp_path / "done"), spread=2) == 1
    assert not (drop / "o.csv").exists()
    assert (tmp_path / "done" / "o.csv").exists()
    (entry,) = lake.runs().collect()
    assert (entry["table_name"], entry["load_status"], entry["rows_loaded"], entry["rows_failed"]) == ("raw_orders", SUCCESS, 1, 0)
    assert entry["started_at"] <= entry["completed_at"]
    assert len(entry["run_id"]) == 36
    assert entry["loaded_by"]


def test_empty_file_loads_no_rows(spark, lake, drop):
    (drop / "o.csv").write_text(ORDERS)
    assert load_raw(lake, "raw_orders", str(drop)) == 0


def test_loads_append_and_a_repeated_run_replaces_itself(spark, lake, drop):
    (drop / "o.csv").write_text(ORDERS + "1,2,3,4,5,6,7,8,9,10\n")
    for run in ("a", "b", "b"):
        load_raw(lake, "raw_orders", str(drop), run)
    raw = lake.table(lake.raw, "raw_orders")
    assert sorted(r["_run_id"] for r in raw.collect()) == ["a", "b"]
    assert raw.schema == schemas.raw_schema("raw_orders")


def test_layers_and_tables(spark, lake):
    lake.create()  # a second time changes nothing
    assert lake.tables(lake.raw) == sorted([*schemas.RAW_TABLES, schemas.RUN_LOG])
    assert lake.tables(lake.stg) == []


def test_publish_replaces_the_table_and_keeps_running_readers(spark, lake):
    assert lake.publish(lake.stg, "t", spark.range(3)) == 3
    reader = lake.table(lake.stg, "t")
    assert lake.publish(lake.stg, "t", spark.range(5).withColumn("m", F.lit("x")), ["m"]) == 5
    assert reader.count() == 3
    assert lake.table(lake.stg, "t").count() == 5
    assert lake.publish(lake.stg, "t", lake.table(lake.stg, "t").limit(2)) == 2
    assert lake.table(lake.stg, "t").count() == 2
    assert len(lake._versions(f"{lake.root}/{lake.stg}/t")) == 2


def test_length_violations(spark):
    df = spark.createDataFrame([("abc", "x"), ("abcd", None)], "a string, b string")
    assert tuple(schemas.length_violations(df, {"a": 3, "b": 1}).first()) == (1, 0)


def test_csv_sink_round_trip(spark, tmp_path):
    values = ['x, "y" z', "  sp  ", "", None, "plain"]
    df = spark.createDataFrame([(f"{i}", *[v] * 9) for i, v in enumerate(values)], ", ".join(f"{c} string" for c in schemas.ORDER_COLUMNS))
    sinks.write_csv(df, str(tmp_path / "csv"), "gzip")
    back = readers.blank_to_null(readers.read_delimited(spark, str(tmp_path / "csv"), "raw_orders"))
    assert back.exceptAll(readers.blank_to_null(df)).count() == 0
    assert back.count() == 5


def test_json_sink_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ("b", 2)], "product_id string, n int")
    sinks.write_json(df, str(tmp_path / "json"))
    back = readers.read_json_lines(spark, str(tmp_path / "json")).select(F.to_json("raw_data")).collect()
    assert sorted(r[0] for r in back) == ['{"n":2,"product_id":"b"}', '{"n":null,"product_id":"a"}']


def test_load_time_can_be_given(spark, lake, drop):
    (drop / "o.csv").write_text(ORDERS + "1,2,3,4,5,6,7,8,9,10\n")
    at = dt.datetime(2024, 1, 2, 3)
    assert read_raw(lake, "raw_orders", str(drop), "r", loaded_at=at).first()["_loaded_at"] == at


def test_documents_can_be_spread(spark, lake, drop):
    (drop / "a.json").write_text("\n".join(json.dumps({"event_id": i}) for i in range(10)))
    assert load_raw(lake, "raw_web_events", str(drop), spread=3) == 10
    assert lake.table(lake.raw, "raw_web_events").count() == 10


def test_archived_files_keep_their_folders(spark, lake, tmp_path):
    for folder, key in (("a", "1"), ("b", "2")):
        (tmp_path / "drop" / folder).mkdir(parents=True)
        (tmp_path / "drop" / folder / "c.csv").write_text("customer_id,customer_name,email,phone,city,country,segment,signup_date\n" + key + ",x,,p,c,n,s,2024-01-01\n")
    assert load_raw(lake, "raw_customers", f"{tmp_path}/drop/*/c.csv", archive_to=str(tmp_path / "done")) == 2
    assert sorted(p.parent.name for p in (tmp_path / "done").rglob("c.csv")) == ["a", "b"]
    assert load_raw(lake, "raw_customers", f"{tmp_path}/done/*/c.csv", delete_read=True) == 2
    assert not list((tmp_path / "done").rglob("c.csv"))


def test_bad_records_are_set_aside(spark, lake, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    header = ",".join(schemas.CUSTOMER_COLUMNS) + "\n"
    (drop / "a.csv").write_text(header + '1,x,,p,c,n,s,2024-01-01\n2,short\n3,"a, b",e,p,c,n,s,soon\n4,x,e,p,' + "c" * 101 + ",n,s,NULL\n")
    path = str(drop)
    assert load_raw(lake, "raw_customers", path, quarantine=True, casts={"signup_date": "date"}) == 1
    rows = {r["record"]: r["reason"] for r in lake.rejects().collect()}
    assert rows == {"2,short": "malformed", '3,"a, b",e,p,c,n,s,soon': "no date in signup_date", f"4,x,e,p,{'c' * 101},n,s,": "length of city"}
    run = lake.runs().first()
    assert (run["rows_loaded"], run["rows_failed"], run["load_status"]) == (1, 3, "SUCCESS")
    assert lake.table(lake.raw, "raw_customers").first()["email"] is None
    with pytest.raises(Exception, match="(?i)malformed"):
        load_raw(lake, "raw_customers", path)


def test_bad_documents_are_set_aside(spark, lake, tmp_path):
    assert lake.rejects().count() == 0
    (tmp_path / "e.json").write_text('{"event_id": "1"}\n{"event_id": \n\n[{"event_id": "2"}, {"event_id": "3"}]\n')
    assert load_raw(lake, "raw_web_events", str(tmp_path / "e.json"), quarantine=True) == 3
    assert [(r["record"], r["reason"], r["_source_file"].rsplit("/")[-1]) for r in lake.rejects().collect()] == [('{"event_id": ', "malformed", "e.json")]
    load_raw(lake, "raw_web_events", str(tmp_path / "e.json"), run_id="again", quarantine=True)
    assert lake.rejects().count() == 2 and lake.table(lake.raw, "raw_web_events").count() == 6


def customers_drop(tmp_path, n):
    (tmp_path / "drop").mkdir(exist_ok=True)
    for i in range(n):
        (tmp_path / "drop" / f"{i}.csv").write_text(",".join(schemas.CUSTOMER_COLUMNS) + f"\n{i},x,,p,c,n,s,2024-01-01\n")


@pytest.mark.parametrize("delete_read", [False, True])
def test_a_load_interrupted_between_moves_ends_right(spark, lake, tmp_path, monkeypatch, delete_read):
    customers_drop(tmp_path, 5)
    path, how = f"{tmp_path}/drop/*.csv", {"delete_read": True} if delete_read else {"archive_to": str(tmp_path / "done")}
    done, tried = moves._done, []

    def fails_later(lake, file, target):
        tried.append(file)
        if len(tried) > 2:
            raise OSError("gone away")
        return done(lake, file, target)

    monkeypatch.setattr(moves, "THREADS", 1)
    monkeypatch.setattr(moves, "_done", fails_later)
    with pytest.raises(OSError, match="gone away"):
        load_raw(lake, "raw_customers", path, "first", **how)
    monkeypatch.setattr(moves, "_done", done)
    assert moves.unfinished(lake) == ["first"] and len(list((tmp_path / "drop").glob("*.csv"))) == 3
    (tmp_path / "drop" / "new.csv").write_text(",".join(schemas.CUSTOMER_COLUMNS) + "\nnew,x,,p,c,n,s,2024-01-01\n")
    assert load_raw(lake, "raw_customers", path, "second", **how) == 1
    assert sorted(r["customer_id"] for r in lake.table(lake.raw, "raw_customers").collect()) == ["0", "1", "2", "3", "4", "new"]
    assert moves.unfinished(lake) == [] and not list((tmp_path / "drop").glob("*.csv"))
    assert len(list((tmp_path / "done").glob("*.csv"))) == (0 if delete_read else 6)


def test_moves_of_a_load_that_failed_are_not_due(spark, lake, tmp_path, monkeypatch):
    customers_drop(tmp_path, 2)
    path = f"{tmp_path}/drop/*.csv"
    append = type(lake).append_raw

    def breaks(self, *args):
        raise OSError("no space")

    for run in ("a", "a"):  # also as a run that repeats itself
        monkeypatch.setattr(type(lake), "append_raw", breaks)
        with pytest.raises(OSError, match="no space"):
            load_raw(lake, "raw_customers", path, run, archive_to=str(tmp_path / "done"))
        monkeypatch.setattr(type(lake), "append_raw", append)
        assert moves.recover(lake, "raw_customers") == []
        assert len(list((tmp_path / "drop").glob("*.csv"))) == 2
        load_raw(lake, "raw_customers", path, run)
    assert lake.table(lake.raw, "raw_customers").count() == 2
    assert moves.recover(lake, "raw_orders") == []


def test_moves_never_overwrite(spark, lake, tmp_path):
    customers_drop(tmp_path, 1)
    (tmp_path / "done").mkdir()
    (tmp_path / "done" / "0.csv").write_text("other")
    with pytest.raises(OSError, match="could not move"):
        load_raw(lake, "raw_customers", f"{tmp_path}/drop/*.csv", archive_to=str(tmp_path / "done"))
    assert (tmp_path / "done" / "0.csv").read_text() == "other" and (tmp_path / "drop" / "0.csv").exists()


def test_array_files_are_archived(spark, lake, tmp_path):
    (tmp_path / "drop").mkdir()
    (tmp_path / "drop" / "a.json").write_text('[{"event_id": "1"}, {"event_id": "2"}]')
    assert load_raw(lake, "raw_web_events", f"{tmp_path}/drop/*.json", array_files=True, archive_to=str(tmp_path / "done")) == 2
    assert (tmp_path / "done" / "a.json").exists() and not (tmp_path / "drop" / "a.json").exists()


def test_a_run_is_written_without_a_sort(spark, lake, tmp_path, monkeypatch):
    """All rows of a run are one partition, so there is nothing to sort them by."""
    from lakemart.sources import lake as module

    seen, write = [], module.write_counted

    def watched(df, path, *args, **options):
        seen.append(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters"))
        return write(df, path, *args, **options)

    monkeypatch.setattr(module, "write_counted", watched)
    (tmp_path / "c.csv").write_text("customer_id,customer_name,email,phone,city,country,segment,signup_date\n" + "".join(f"C{i},n,,,,,,\n" for i in range(50)))
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    assert load_raw(lake, "raw_customers", str(tmp_path / "c.csv")) == 50
    assert seen and all(int(n) > 0 for n in seen)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    assert lake.table(lake.raw, "raw_customers").count() == 50
