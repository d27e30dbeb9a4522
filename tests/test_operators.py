import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakemart.operators import aggregates, joins
from lakemart.operators.anomalies import zscore_iqr
from lakemart.operators.dedup import latest_per_key
from lakemart.operators.ranking import Order, ntile_global, rank_by_ranges, rank_within, tile_ends
from lakemart.operators.selection import exact_percentiles
from lakemart.operators.sets import layer_counts
from lakemart.workspace import Stored


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# D1

def test_latest_per_key_breaks_ties_the_same_way_on_any_partitioning(spark):
    rows = [(k, dt.datetime(2024, 1, 1), f"v{i}") for i in range(40) for k in ("a", "b")] + [("c", None, "x"), ("c", dt.datetime(2024, 1, 2), "y")]
    df = spark.createDataFrame(rows, "k string, _loaded_at timestamp_ntz, v string")
    for n in (1, 3, 7):
        got = sorted(tuple(r) for r in latest_per_key(df.repartition(n), ["k"], "_loaded_at").select("k", "v").collect())
        assert got == [("a", "v9"), ("b", "v9"), ("c", "x")]


def test_latest_per_key_is_idempotent(spark):
    df = spark.range(1000).selectExpr("id % 100 as k", "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, int(id % 7)) as _loaded_at", "id as v")
    once = latest_per_key(df, ["k"], "_loaded_at")
    assert once.count() == 100
    assert once.exceptAll(latest_per_key(once.union(once), ["k"], "_loaded_at")).count() == 0


def test_latest_per_key_limits_rows_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as _loaded_at")
    tree = plan(latest_per_key(df, ["k"], "_loaded_at"))
    assert tree.index("Exchange hashpartitioning") < tree.rindex("WindowGroupLimit")
    assert tree.count("WindowGroupLimit [k") == 2


# W2

@pytest.mark.parametrize("rows", [0, 3, 6, 13, 777])
def test_ntile_over_ranges_equals_the_window(spark, rows):
    df = spark.range(rows).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") % 9 > 0, (F.col("id") % 4).cast("decimal(18,2)")).alias("few"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") * 7919 % 101).cast("int")).alias("day"),
        F.lit(1).alias("same"),
    )
    scores = {"a": Order("few"), "b": Order("few", descending=True), "c": Order("day"), "d": Order("day", descending=True), "e": Order("same")}
    ranged = ntile_global(df, 5, scores, "id", single_task_rows=2)
    few, day = F.col("few"), F.col("day")
    plain = df.withColumns({
        out: F.ntile(5).over(Window.orderBy(*order, "id"))
        for out, order in {"a": [few.asc_nulls_last()], "b": [few.desc_nulls_first()], "c": [day], "d": [day.desc()], "e": []}.items()
    })
    assert ranged.count() == rows
    assert ranged.exceptAll(plain).count() == 0


def test_large_ntile_moves_no_rows(spark):
    df = spark.range(1000).selectExpr("id", "id * 7919 % 1000 as v")
    tree = plan(ntile_global(df, 5, {"t": Order("v")}, "id", single_task_rows=50))
    assert "Exchange" not in tree and "Window" not in tree


def test_ntile_needs_unique_keys(spark):
    df = spark.range(100).selectExpr("1 as id", "1 as v")
    for limit in (10, 1000):
        with pytest.raises(ValueError, match="unique"):
            ntile_global(df, 5, {"t": Order("v")}, "id", single_task_rows=limit)


@pytest.mark.parametrize("limit", [50, 5000])
def test_ntile_of_tied_times_is_the_same_at_any_limit(spark, limit):
    df = spark.range(3000).selectExpr("id", "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, int(id % 5)) as v")
    got = ntile_global(df, 7, {"t": Order("v", descending=True)}, "id", single_task_rows=limit)
    assert [r["count"] for r in got.groupBy("t").count().orderBy("t").collect()] == [429] * 4 + [428] * 3
    assert got.exceptAll(df.selectExpr("*", "cast(ntile(7) over (order by v desc, id) as int) as t")).count() == 0


def test_jobs_do_not_follow_the_number_of_scores(spark):
    df = Stored(spark.range(4000).selectExpr("id", *[f"id * {7 + 2 * i} % 4001 as v{i}" for i in range(6)]), "scores").df

    def jobs(count):
        spark.sparkContext.setJobGroup(f"scores-{count}", "tiles")
        found = ntile_global(df, 5, {f"t{i}": Order(f"v{i}") for i in range(count)}, "id", 4000, single_task_rows=100, known_unique=True)
        return found, len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"scores-{count}"))

    (_, one), (six, several) = jobs(1), jobs(6)
    assert several <= one + 1
    for i in range(6):
        assert [r["count"] for r in six.groupBy(f"t{i}").count().collect()] == [800] * 5


def test_falling_strings(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("c",)], "k string")
    got = {r["k"]: r["r"] for r in rank_within(df.withColumn("g", F.lit(1)), "g", Order("k", descending=True), "r").collect()}
    assert got == {None: 1, "c": 2, "b": 3, "a": 4}
    with pytest.raises(TypeError, match="falling"):
        ntile_global(df.withColumn("f", F.col("k") == "a"), 2, {"t": Order("f", descending=True)}, "k", single_task_rows=1)


def test_falling_strings_over_ranges(spark):
    words = ["", "a", "ab", "abc", "b", "B", "a\x00", "z", "é", "日本", "\U0001f600", "\uffff", None, "~", "ab "]
    df = spark.createDataFrame([(i, i % 2, words[i * 7 % 15]) for i in range(200)], "id int, g int, k string")
    order, by = Order("k", descending=True), F.col("k").desc_nulls_first()
    for column in (df, df.withColumn("k", F.col("k").cast("binary"))):
        ranks = rank_by_ranges(column, "g", order, "r", 4).select("id", "r")
        assert sorted(ranks.collect()) == sorted(column.select("id", F.rank().over(Window.partitionBy("g").orderBy(by)).alias("r")).collect())
        tiles = ntile_global(column, 7, {"t": order}, "id", single_task_rows=5).select("id", "t")
        assert sorted(tiles.collect()) == sorted(column.select("id", F.ntile(7).over(Window.orderBy(by, "id")).alias("t")).collect())


@pytest.mark.parametrize("limit", [3, 50, 10_000])
def test_exact_percentiles_of_any_size(spark, limit):
    values = [(i * 37 % 501) / 4 if i % 11 else None for i in range(2000)] + [7.25] * 900
    df = spark.createDataFrame([(v,) for v in values], "v double")
    fractions = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.999, "e": 1.0}
    got = exact_percentiles(df, "v", fractions, limit).first().asDict()
    known = sorted(v for v in values if v is not None)
    for name, q in fractions.items():
        at = q * (len(known) - 1)
        low = int(at)
        assert got[name] == pytest.approx(known[low] + (at - low) * (known[min(low + 1, len(known) - 1)] - known[low]))
    assert exact_percentiles(df.where("v is null"), "v", fractions, limit).first().asDict() == dict.fromkeys(fractions)


def test_more_than_a_hundred_ranges(spark):
    df = spark.range(3000).selectExpr("id", "cast(id % 3 as string) as g", "id * 7919 % 1009 as v")
    plain = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy("v")))
    ranged = rank_by_ranges(df, "g", Order("v"), "r", 8)
    assert ranged.exceptAll(plain).count() == 0 and ranged.count() == 3000


def test_tile_ends():
    assert tile_ends(12, 5) == [3, 6, 8, 10]
    assert tile_ends(3, 5) == [1, 2]
    assert tile_ends(0, 5) == []


# W3

@pytest.mark.parametrize("range_rows", [1, 1000])
def test_rank_by_ranges_equals_the_window(spark, range_rows):
    df = spark.range(600).select(
        "id",
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("g"), (F.col("id") % 3).cast("string"))).alias("g"),
        F.when(F.col("id") % 4 > 0, (F.col("id") * 31 % 17).cast("decimal(28,2)")).alias("v"),  # many ties, a third NULL
    )
    plain = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(F.col("v").desc_nulls_first())))
    ranged = rank_by_ranges(df, "g", Order("v", descending=True), "r", range_rows)
    assert ranged.count() == 600
    assert ranged.exceptAll(plain).count() == 0


def test_rank_puts_missing_revenue_first(spark):
    df = spark.createDataFrame([("c", "a", None), ("c", "b", 5), ("c", "d", 5), ("c", "e", 1)], "g string, id string, v int")
    for limit in (1, 100):
        got = {r["id"]: r["r"] for r in rank_within(df, "g", Order("v", descending=True), "r", single_task_rows=limit).collect()}
        assert got == {"a": 1, "b": 2, "d": 2, "e": 4}


# J1-J4

def test_enrich_keeps_unknown_keys(spark):
    facts = spark.createDataFrame([("p1", 1), ("p9", 2), (None, 3)], "product_id string, n int")
    dimension = spark.createDataFrame([("p1", "c")], "product_id string, category string")
    got = {r["n"]: r["category"] for r in joins.enrich(facts, dimension, "product_id").collect()}
    assert got == {1: "c", 2: None, 3: None}


def test_keep_known_drops_unknown_keys(spark):
    stats = spark.createDataFrame([("c1", 1), ("c9", 2)], "customer_id string, n int")
    assert [r["n"] for r in joins.keep_known(stats, spark.createDataFrame([("c1", "x")], "customer_id string, name string"), "customer_id").collect()] == [1]


def test_with_totals_fills_counts_only(spark):
    dimension = spark.createDataFrame([("p1",), ("p2",)], "product_id string")
    totals = spark.createDataFrame([("p1", 3, 9)], "product_id string, lines long, units long")
    got = {r["product_id"]: (r["lines"], r["units"]) for r in joins.with_totals(dimension, totals, "product_id", ["lines"]).collect()}
    assert got == {"p1": (3, 9), "p2": (0, None)}


def test_with_statistics_is_no_join_and_wants_one_row(spark):
    df = spark.range(5).selectExpr("id as x")
    got = joins.with_statistics(df, df.agg(F.max("x").alias("top")))
    assert {r["top"] for r in got.collect()} == {4}
    assert "Join" not in plan(got)
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        joins.with_statistics(df, df.select(F.col("x").alias("y"))).collect()


# A

def test_conditional_counts(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "x"), ("c", "y"), ("d", None)], "id string, s string")
    got = df.agg(aggregates.count_matching(F.col("s") == "x"), aggregates.count_distinct_where(F.col("s") == "x", F.col("id")), aggregates.count_rows()).first()
    assert tuple(got) == (3, 2, 5)
    none = df.filter("false").agg(aggregates.count_matching(F.col("s") == "x")).first()
    assert none[0] == 0


def test_quantile_interpolates(spark):
    df = spark.createDataFrame([(Decimal(v),) for v in (1, 2, 3, 10)], "x decimal(10,2)")
    assert df.agg(aggregates.quantile(F.col("x"), 0.25)).first()[0] == 1.75
    assert df.agg(aggregates.quantile(F.col("x"), 0.5, approximate=True)).first()[0] in (2.0, 3.0)


def test_distinct_counts(spark):
    df = spark.range(1000).selectExpr("id % 2 as g", "id % 10 as a", "id % 7 as b")
    got = {tuple(r) for r in aggregates.distinct_counts(df, ["g"], {"na": "a", "nb": "b"}).collect()}
    assert got == {(0, 5, 7), (1, 5, 7)}
    assert aggregates.distinct_counts(df, ["g"], {"na": "a"}, approximate=True).count() == 2


# B15-B18

def flags(spark, *revenues):
    rows = [(i, Decimal(r)) for i, r in enumerate(revenues)]
    df = spark.createDataFrame(rows, "day int, daily_revenue decimal(28,2)")
    return zscore_iqr(df, "daily_revenue").orderBy("day").collect()


def test_one_day_has_no_deviation(spark):
    (row,) = flags(spark, 5)
    assert (row["stddev_rev"], row["z_score"], row["is_anomaly"], row["anomaly_type"]) == (None, None, False, "Normal")


def test_equal_days_have_no_score(spark):
    assert {(r["stddev_rev"], r["z_score"], r["is_anomaly"]) for r in flags(spark, 5, 5, 5)} == {(0.0, None, False)}


def test_spike(spark):
    row = flags(spark, *[10] * 20, 100)[-1]
    assert (row["is_anomaly"], row["anomaly_type"]) == (True, "Revenue Spike")


def test_drop(spark):
    row = flags(spark, *[100] * 20, 1)[-1]
    assert (row["is_anomaly"], row["anomaly_type"]) == (True, "Revenue Drop")


def test_outlier_by_quartiles_only_is_normal(spark):
    outliers = [r for r in flags(spark, *[10] * 8, 12, 12) if r["is_anomaly"]]
    assert [(r["day"], r["z_score"] < 2, r["anomaly_type"]) for r in outliers] == [(8, True, "Normal"), (9, True, "Normal")]


def test_no_rows(spark):
    assert flags(spark) == []


# U1

def test_layer_counts(spark):
    got = layer_counts({"a": spark.range(3), "b": spark.range(0)})
    assert {tuple(r) for r in got.collect()} == {("a", 3), ("b", 0)}


def test_sketches_merge_to_any_total(spark):
    rows = spark.range(60_000).select((F.col("id") % 7).alias("a"), (F.col("id") % 3).alias("b"), F.when(F.col("id") % 11 != 0, F.col("id") % 9_973).alias("v"))
    sketches = aggregates.distinct_sketches(rows, ["a", "b"], {"n": "v"})
    for keys in ([], ["a"], ["b"], ["a", "b"]):
        exact = {tuple(r[k] for k in keys): r["n"] for r in aggregates.distinct_counts(rows, keys, {"n": "v"}).collect()}
        got = {tuple(r[k] for k in keys): r["n"] for r in aggregates.merged_distinct(sketches, keys, ["n"]).collect()}
        assert got.keys() == exact.keys()
        assert all(abs(got[k] - n) <= 0.03 * n for k, n in exact.items())
    none = aggregates.distinct_sketches(spark.createDataFrame([(1, None)], "a int, v string"), ["a"], {"n": "v"})
    assert aggregates.merged_distinct(none, ["a"], ["n"]).collect()[0]["n"] == 0
