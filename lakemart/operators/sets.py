"""Set operations."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.operators.aggregates import count_rows


def layer_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its name and row count, in one job."""
    counts = [df.agg(count_rows().alias("row_count")).select(F.lit(name).alias("tbl"), "row_count") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)
