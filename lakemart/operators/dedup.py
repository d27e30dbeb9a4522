"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], latest: str, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """The row with the greatest ``latest`` for each key; a NULL there counts as greatest.

    Rows of one load share their load time, so ties are broken by every other column (or ``tiebreak``):
    the result does not depend on the partitioning.  Spark limits each task to one row per key before
    the shuffle (WindowGroupLimit), so a hot key never moves more rows than there are tasks.
    """
    others = tiebreak if tiebreak is not None else [c for c in df.columns if c not in keys and c != latest]
    newest_first = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_first() for c in [latest, *others]])
    return df.withColumn("_rn", F.row_number().over(newest_first)).filter(F.col("_rn") == 1).drop("_rn")
