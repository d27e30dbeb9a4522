"""Joins between facts, dimensions and statistics.

No join carries a broadcast hint: Spark broadcasts a side only when its size, estimated from the files
or measured by AQE, is below ``spark.sql.autoBroadcastJoinThreshold``; beyond that it sort-merge joins
and splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Every fact with the attributes of its dimension row, NULL where unknown; ``key`` is unique there."""
    return facts.join(dimension, key, "left")


def keep_known(stats: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Statistics of known keys only, with the attributes."""
    return stats.join(dimension, key, "inner")


def with_totals(dimension: DataFrame, totals: DataFrame, key: str, counts: Iterable[str]) -> DataFrame:
    """Every dimension row with totals aggregated per ``key``; without facts, counts are 0 and sums NULL."""
    joined = dimension.join(totals, key, "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})


def with_statistics(df: DataFrame, stats: DataFrame) -> DataFrame:
    """The columns of a one-row ``stats`` on every row.

    The row is a scalar subquery: evaluated once, then a constant in each task, without a join.
    More than one row raises.
    """
    row = stats.select(F.struct("*")).scalar()
    return df.select("*", *[row[c].alias(c) for c in stats.columns])
