"""Every registered query against its SQL on the smallest test tables."""

import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from checks import queries
from checks.compare import connect, differences
from checks.oracles import ORACLES
from checks.queries import QUERIES

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_every_query_has_sql():
    assert set(ORACLES) == set(NAMES)
    assert set(NAMES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, small, name):
    rows, found = differences(spark, con, name, small)
    assert not found
    assert rows > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("indent", [2, None])
def test_landed_arrays_are_bounded(spark, monkeypatch, indent):
    lines = spark.range(4000).select(F.struct(F.lit("x" * 100).alias("a")).alias("raw_data"))
    monkeypatch.setattr(queries.adapter, "raw", lambda *_: lines)
    monkeypatch.setattr(queries, "ARRAY_CHARS", 20_000, raising=False)
    files = [r[0] for r in spark.read.text(queries.landed_array(spark, "", "any", indent), wholetext=True).collect()]
    assert max(map(len, files)) < 40_000
    assert [x for f in files for x in json.loads(f)] == [{"a": "x" * 100}] * 4000


def test_raw_orders_meet_their_country_before_their_lines(spark, small):
    """Spark runs the joins as they are ordered: the last one brings lines and orders together, and no row differs from the SQL."""
    from checks import adapter

    made = adapter.flat(spark, small, "orders")
    joins = [line for line in made._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in line]
    assert len(joins) == 4 and "l_orderkey" in joins[0]
    written = spark.sql(adapter.RAW_ORDERS).select(*[F.col(c).cast(made.schema[c].dataType) for c in made.columns])
    assert written.count() > 0 and made.exceptAll(written).isEmpty() and written.exceptAll(made).isEmpty()
