"""NTILE over a whole table and RANK within large groups, without a task that holds all rows.

Spark runs a window without partition keys in one task, and one with few keys in few tasks.  Both
operators use the plain window while a counted size allows it and switch to a distributed form with
equal results beyond that.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.operators.selection import as_literal, rows_at
from lakemart.workspace import Stored

SINGLE_TASK_ROWS = 500_000


@dataclass(frozen=True)
class Order:
    """Sort order of a column; NULL is the greatest value: last ascending, first descending."""

    column: str
    descending: bool = False

    def sorting(self) -> Column:
        """This order for a window (O3), of any type."""
        value = F.col(self.column)
        return value.desc_nulls_first() if self.descending else value.asc_nulls_last()

    def ascending_keys(self, df: DataFrame) -> list[Column]:
        """Columns whose ascending order is this order; descending ones of numbers, dates, times, strings and bytes only.

        A falling string becomes the complement of its bytes; the letter behind it puts it after what it begins.
        """
        value, kind = F.col(self.column), df.schema[self.column].dataType
        if isinstance(kind, T.DateType):
            value = F.unix_date(value)
        elif isinstance(kind, T.TimestampType | T.TimestampNTZType):
            value = F.unix_micros(value.cast("timestamp"))
        turned = -value if isinstance(kind, T.NumericType | T.DateType | T.TimestampType | T.TimestampNTZType) else None
        if isinstance(kind, T.BinaryType) or isinstance(kind, T.StringType) and kind.collation == "UTF8_BINARY":
            turned = F.concat(F.translate(F.hex(value), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))
        if self.descending and turned is None:
            raise TypeError(f"{self.column}: a falling order of {kind.simpleString()} has no distributed form")
        is_null = value.isNull()
        null_rank = ~is_null if self.descending else is_null
        return [null_rank.cast("int").alias("null_rank"), (turned if self.descending else value).alias("value")]

    def key(self, df: DataFrame, unique: str) -> Column:
        """A totally ordered key: this order, ties broken by a column that is unique."""
        return F.struct(*self.ascending_keys(df), F.col(unique).alias("unique"))


def ntile_global(df: DataFrame, tiles: int, scores: dict[str, Order], unique: str, rows: int | None = None,
                 single_task_rows: int = SINGLE_TASK_ROWS, known_unique: bool = False) -> DataFrame:
    """One NTILE column per entry of ``scores`` over all rows; ties are broken by ``unique``.

    ``df`` is read several times when it is large, so give a stored table; ``rows`` is its size if known.  The borders
    of all scores are selected together.  A ``unique`` column that repeats is refused, whatever the size of the table;
    ``known_unique`` saves the shuffle that finds out, for the key of a group-by.
    """
    rows = df.count() if rows is None else rows
    if not known_unique and not df.groupBy(unique).count().filter("count > 1").isEmpty():
        raise ValueError(f"{unique} is not unique, so tiles of rows with equal keys are not defined")
    if rows <= single_task_rows:
        return df.withColumns({out: F.ntile(tiles).over(Window.orderBy(order.sorting(), unique)) for out, order in scores.items()})
    ends = tile_ends(rows, tiles)
    keys = {out: order.key(df, unique) for out, order in scores.items()}
    last = rows_at(df, keys, {out: ends for out in scores}, rows, single_task_rows)
    columns = {}
    for out, key in keys.items():
        key_type = df.select(key.alias("key")).schema["key"].dataType
        tile = F.lit(1)
        for end in ends:
            tile = tile + (key > as_literal(last[out][end], key_type)).cast("int")
        columns[out] = tile
    return df.withColumns(columns)


def tile_ends(rows: int, tiles: int) -> list[int]:
    """Position of the last row of each tile but the last: sizes differ by at most 1, larger tiles first."""
    size, larger = divmod(rows, tiles)
    ends = [t * size + min(t, larger) for t in range(1, tiles)]
    return sorted({end for end in ends if 0 < end < rows})


def rank_within(df: DataFrame, group: str, order: Order, out: str, group_sizes: DataFrame | None = None,
                single_task_rows: int = SINGLE_TASK_ROWS) -> DataFrame:
    """RANK of each row in its group.

    The largest group is counted first, on ``group_sizes`` if that is a cheaper frame with the same
    groups as ``df``; beyond ``single_task_rows`` ranks are computed over ranges.
    """
    counted = (df if group_sizes is None else group_sizes).groupBy(group).count()
    largest = counted.agg(F.max("count")).first()[0] or 0
    if largest <= single_task_rows:
        return df.withColumn(out, F.rank().over(Window.partitionBy(group).orderBy(order.sorting())))
    return rank_by_ranges(df, group, order, out, single_task_rows)


def rank_by_ranges(df: DataFrame, group: str, order: Order, out: str, range_rows: int = SINGLE_TASK_ROWS) -> DataFrame:
    """RANK as 1 + the rows of the group with a smaller value, for groups of any size.

    Rows are first added up per distinct value, so a value that many rows share is one row.  The values are dealt to
    as many ranges of (group, value) as their number asks for, and stored with the number of their range; each range is
    summed in its own task, on top of the totals of the ranges of its group before it, which are one row a range.
    """
    df = Stored(df, "rank-rows").df
    counted = Stored(df.groupBy(group, order.column).agg(F.count(F.lit(1)).alias("_n")), "rank-values")
    ranges = max(2, -(-counted.rows // range_rows))
    keyed = counted.df.withColumns({"_no_group": F.col(group).isNull(), **{f"_{k}": c for k, c in zip(("null", "value"), order.ascending_keys(df), strict=True)}})
    dealt = keyed.repartitionByRange(ranges, "_no_group", group, "_null", "_value").withColumn("_part", F.spark_partition_id())
    placed = Stored(dealt, "rank-ranges").df
    earlier_parts = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(group, "_part").agg(F.sum("_n").alias("_n"))
        .select(F.col(group).alias("_group"), F.col("_part").alias("_of"), F.coalesce(F.sum("_n").over(earlier_parts), F.lit(0)).alias("_offset"))
    )
    smaller = Window.partitionBy(group, "_part").orderBy("_null", "_value").rowsBetween(Window.unboundedPreceding, -1)
    ranks = (
        placed.withColumn("_smaller", F.coalesce(F.sum("_n").over(smaller), F.lit(0)))
        .join(offsets, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_of")))
        .select(F.col(group).alias("_g"), F.col(order.column).alias("_v"), (F.col("_offset") + F.col("_smaller") + 1).cast("int").alias(out))
    )
    same = df[group].eqNullSafe(F.col("_g")) & df[order.column].eqNullSafe(F.col("_v"))
    return df.join(ranks, same, "inner").drop("_g", "_v")
