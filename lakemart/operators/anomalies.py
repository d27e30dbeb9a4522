"""Outlier flags from the standard score and the interquartile range."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.operators.aggregates import quantile
from lakemart.operators.joins import with_statistics

# Labels by direction.
SPIKE, DROP, NORMAL = "Revenue Spike", "Revenue Drop", "Normal"


def spread(df: DataFrame, value: str, approximate: bool = False, **also: Column) -> DataFrame:
    """One row with mean, sample deviation and quartiles of ``value``."""
    x = F.col(value).cast("double")
    return df.agg(
        F.avg(value).cast("double").alias("mean_rev"),
        F.stddev_samp(x).alias("stddev_rev"),
        quantile(x, 0.25, approximate).alias("q1"),
        quantile(x, 0.75, approximate).alias("q3"),
        *[c.alias(name) for name, c in also.items()],
    )


def zscore_iqr(df: DataFrame, value: str, z: float = 2.0, k: float = 1.5, approximate: bool = False,
               also: Mapping[str, Column] | None = None) -> DataFrame:
    """Flag rows more than ``z`` deviations from the mean or more than ``k`` ranges outside the quartiles.

    The label looks at the deviations only.  Without spread the standard score is NULL and only the
    quartiles decide.  Give in ``also`` an aggregate over each column that ``df`` computes beside
    ``value``: the statistics then need the same columns as the rows, and Spark reads ``df`` once.
    """
    x = F.col(value).cast("double")
    mean, sd, q1, q3 = (F.col(c) for c in ("mean_rev", "stddev_rev", "q1", "q3"))
    score = (x - mean) / F.nullif(sd, F.lit(0.0))
    lower, upper = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
    flagged = (F.abs(score) > z) | (x < lower) | (x > upper)
    return with_statistics(df, spread(df, value, approximate, **(also or {}))).select(
        *df.columns,
        mean.alias("mean_rev"),
        sd.alias("stddev_rev"),
        (F.round(score, 2) + 0.0).alias("z_score"),
        lower.alias("iqr_lower_bound"),
        upper.alias("iqr_upper_bound"),
        F.coalesce(flagged, F.lit(False)).alias("is_anomaly"),
        F.when(x > mean + z * sd, SPIKE).when(x < mean - z * sd, DROP).otherwise(NORMAL).alias("anomaly_type"),
    )
