"""Aggregate expressions and group-bys beyond the built-in ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_rows() -> Column:
    """A12"""
    return F.count(F.lit(1))


def count_matching(condition: Column) -> Column:
    """Rows for which the condition holds."""
    return F.count_if(condition)


def count_distinct_where(condition: Column, value: Column) -> Column:
    """Distinct values among the rows for which the condition holds."""
    return F.count_distinct(F.when(condition, value))


def quantile(value: Column, fraction: float, approximate: bool = False) -> Column:
    """Interpolated percentile.

    The exact one keeps a counter per distinct value in one buffer per group: for input of bounded size,
    such as a row per calendar day.  ``approximate`` bounds the buffer for anything larger.
    """
    if approximate:
        return F.percentile_approx(value.cast("double"), fraction, 100_000)
    return F.percentile(value.cast("double"), fraction)


def distinct_counts(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str], approximate: bool = False) -> DataFrame:
    """Distinct counts per group, ``{result: column}``.

    Exact counts spread each group over its values before they are added up, so a hot group is no
    hot task.  ``approximate`` replaces the shuffle of all values by sketches.
    """
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.groupBy(*keys).agg(*[count(c).alias(name) for name, c in columns.items()])


#: Base 2 logarithm of the registers of a sketch: 0.8 % standard error, at most 16 KB.
SKETCH_SIZE = 14


def distinct_sketches(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str], size: int = SKETCH_SIZE) -> DataFrame:
    """A5 for totals over groups: a sketch of the distinct values per group, ``{result: column}``, to be stored.

    NULLs don't count.  Each task sends one sketch per group, however many values it has seen.
    """
    return df.groupBy(*keys).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), size).alias(name) for name, c in columns.items()])


def merged_distinct(sketches: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Distinct counts over any union of groups from their sketches alone; without ``keys`` one row for all."""
    return sketches.groupBy(*keys).agg(*[F.hll_sketch_estimate(F.hll_union_agg(name)).alias(name) for name in names])
