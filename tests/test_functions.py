import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakemart.functions import casts, dates, measures, text


def values(spark, expr, *inputs, type_="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {type_}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_try_number_rounds_and_never_fails(spark):
    got = values(spark, casts.try_number, "3.5", "-3.5", " 7 ", "1e3", "1,000", "", "x", None)
    assert got == [4, -4, 7, 1000, None, None, None, None]


def test_try_decimal_rounds_and_drops_overflow(spark):
    got = values(spark, lambda c: casts.try_decimal(c, 10, 2), "12.345", "2.675", "123456789", "-0.005", None)
    assert got == [Decimal("12.35"), Decimal("2.68"), None, Decimal("-0.01"), None]


def test_try_date_is_strict(spark):
    got = values(spark, casts.try_date, "2023-01-05", "2023-02-30", "bad", "2023-1-5", "2023-01-05\n", "2023-01-05 10:00:00", "", None)
    assert got == [dt.date(2023, 1, 5)] + [None] * 7


def test_try_date_other_format(spark):
    assert values(spark, lambda c: casts.try_date(c, "dd/MM/yyyy"), "05/01/2023", "2023-01-05") == [dt.date(2023, 1, 5), None]


def test_try_timestamp(spark):
    got = values(spark, casts.try_timestamp, "2024-01-05T10:11:12", "2024-01-05 10:11:12", "bad", None)
    assert got == [dt.datetime(2024, 1, 5, 10, 11, 12)] * 2 + [None, None]


def test_null_if(spark):
    assert values(spark, lambda c: casts.null_if(c, "", "NULL"), "", "NULL", "null", " ", None) == [None, None, "null", " ", None]


def test_variant_fields(spark):
    df = spark.createDataFrame([('{"a": 1.239, "b": null, "s": "1.239", "t": "abc", "n": 7, "y": true}',)], "j string").select(F.parse_json("j").alias("v"))
    v = F.col("v")
    got = df.select(
        casts.variant_field(v, "a", "decimal(10,2)"), casts.variant_field(v, "s", "decimal(10,2)"), casts.variant_field(v, "b"),
        casts.variant_field(v, "none"), casts.variant_field(v, "n", "int"), casts.variant_field(v, "y", "boolean"),
        casts.variant_field(v, "t", "decimal(10,2)", safe=True),
    ).first()
    assert list(got) == [Decimal("1.24"), Decimal("1.24"), None, None, 7, True, None]
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        df.select(casts.variant_field(v, "t", "decimal(10,2)")).collect()


def test_trim_only_blanks(spark):
    assert values(spark, text.lower_trim, "  AbC ", "\tX ") == ["abc", "\tx"]
    assert values(spark, text.upper_trim, " aé ", None) == ["AÉ", None]


def test_initcap_after_any_delimiter(spark):
    got = values(spark, text.initcap_trim, " mary-jane o'brien  d.c. foo/bar x_y ", "ÉCOLE (nord) [a]{b}<c>", "", None)
    assert got == ["Mary-Jane O'brien  D.C. Foo/Bar X_Y", "École (Nord) [A]{B}<C>", "", None]


def test_dates(spark):
    day = dt.date(2023, 1, 1)
    assert values(spark, dates.day_of_week, day, dt.date(2023, 1, 7), None, type_="date") == [0, 6, None]
    assert values(spark, dates.month_start, dt.date(2023, 5, 31), type_="date") == [dt.date(2023, 5, 1)]
    assert values(spark, lambda c: dates.days_between(c, dates.today(dt.date(2023, 1, 31))), day, type_="date") == [30]
    moment = dt.datetime(2024, 1, 5, 10, 11, 12)
    assert values(spark, lambda c: dates.truncate("hour", c), moment, type_="timestamp_ntz") == [dt.datetime(2024, 1, 5, 10)]
    assert values(spark, lambda c: dates.truncate("day", c), moment, type_="timestamp_ntz") == [dt.datetime(2024, 1, 5)]


def revenue(spark, *lines):
    df = spark.createDataFrame([(*map(lambda x: None if x is None else Decimal(x), line),) for line in lines], "q decimal(18,0), p decimal(10,2), d decimal(5,2)")
    return [r[0] for r in df.select(measures.line_revenue(F.col("q"), F.col("p"), F.col("d"))).collect()]


def test_line_revenue(spark):
    got = revenue(spark, ("3", "9.99", "5"), ("3", "9.99", None), (None, "1", "0"), ("1", None, "0"), ("1", "0.05", "50"), ("2", "10", "100"))
    assert got == [Decimal("28.47"), Decimal("29.97"), None, None, Decimal("0.03"), Decimal("0.00")]


def test_is_discounted(spark):
    assert values(spark, measures.is_discounted, Decimal(5), Decimal(0), None, type_="decimal(5,2)") == [True, False, False]


def test_stock_status(spark):
    got = values(spark, measures.stock_status, 0, 1, 19, 20, -1, None, type_="int")
    assert got == ["Out of Stock", "Low Stock", "Low Stock", "In Stock", "Low Stock", "In Stock"]


def test_safe_pct_of_ties_signs_and_zero(spark):
    df = spark.createDataFrame([(1, 3), (-1, 3), (1, 8000), (-1, 8000), (1, 0), (None, 3)], "a int, b int")
    got = [r[0] for r in df.select(measures.safe_pct(F.col("a"), F.col("b"))).collect()]
    assert got == [Decimal("33.33"), Decimal("-33.33"), Decimal("0.01"), Decimal("-0.01"), None, None]


def test_mean_amount_of_large_group_is_not_rounded_twice(spark):
    # 0.0049999... must stay below the tie
    n = 300_001
    df = spark.range(n).select(F.when(F.col("id") < n // 2, F.lit("0.01")).otherwise("0").cast("decimal(18,2)").alias("x"))
    assert df.agg(measures.mean_amount(F.col("x"))).first()[0] == Decimal("0.00")


def test_gross_margin(spark):
    df = spark.createDataFrame([(Decimal("10"), Decimal("7.5")), (Decimal("0"), Decimal("1")), (None, Decimal("1"))], "p decimal(10,2), c decimal(10,2)")
    got = df.select(measures.gross_margin(F.col("p"), F.col("c")), measures.gross_margin_pct(F.col("p"), F.col("c"))).collect()
    assert [tuple(r) for r in got] == [(Decimal("2.50"), Decimal("25.00")), (Decimal("-1.00"), None), (None, None)]


def test_is_incomplete(spark):
    assert values(spark, measures.is_incomplete, None, "", " ", "a@b") == [True, True, False, False]


def test_segments_of_all_score_cells(spark):
    scores = spark.range(125).selectExpr("int(id div 25) + 1 r", "int(id div 5 % 5) + 1 f", "int(id % 5) + 1 m")
    cells = scores.select(measures.rfm_segment(F.col("r"), F.col("f"), F.col("m")).alias("s"), measures.rfm_cell(F.col("r"), F.col("f"), F.col("m")).alias("cell"))
    sizes = {r["s"]: r["count"] for r in cells.groupBy("s").count().collect()}
    assert sizes == {"Loyal Customers": 37, "Lost": 20, "New Customers": 20, "At Risk": 18, "Needs Attention": 16, "Champions": 8, "Potential Loyalists": 6}
    assert cells.select("cell").distinct().count() == 125
    assert scores.filter("r = 1 and f = 2 and m = 5").select(measures.rfm_average(F.col("r"), F.col("f"), F.col("m"))).first()[0] == Decimal("2.67")
