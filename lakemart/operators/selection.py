"""Rows at given positions of several orders of one table, without sorting it.

All orders are looked at together: one pass samples keys, one counts the rows between them, and both are repeated only
within the ranges that hold a wanted position, until these are small enough for one task; a last pass numbers their rows.
So the number of jobs follows the size of the table, not the number of orders or positions.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.workspace import Stored

#: Ranges that one pass cuts a range into, and sampled keys for each of them.
RANGES, SAMPLES = 64, 40


@dataclass(frozen=True)
class Range:
    """Keys from ``low`` up to but without ``high`` (open where None): how many rows they have and what these weigh,
    and the weight before them."""

    low: Row | None
    high: Row | None
    before: int
    rows: int
    weight: int

    def holds(self, key: Column, key_type: T.StructType) -> Column:
        inside = F.lit(True)
        if self.low is not None:
            inside = inside & (key >= as_literal(self.low, key_type))
        if self.high is not None:
            inside = inside & (key < as_literal(self.high, key_type))
        return inside

    def has_any(self, positions: Sequence[int]) -> bool:
        return any(self.before < p <= self.before + self.weight for p in positions)


def rows_at(df: DataFrame, keys: Mapping[str, Column], positions: Mapping[str, Sequence[int]], rows: int, single_task_rows: int,
            weight: Column | None = None, total: int | None = None) -> dict[str, dict[int, Row]]:
    """For each named key, a struct without repeated values, the keys at these 1-based positions in ascending order.

    With a ``weight``, a row stands for that many equal ones, ``total`` in all, and takes as many positions.  ``df`` is
    read several times.  What reaches the driver are samples of fixed size and a number for each range.  The samples
    decide how even the ranges are, never the result.
    """
    names = [name for name in keys if positions.get(name)]
    columns = {name: f"key_{i}" for i, name in enumerate(names)}
    frame = df.select(*[keys[name].alias(columns[name]) for name in names], (F.lit(1) if weight is None else weight).cast("bigint").alias("n"))
    types = {name: frame.schema[columns[name]].dataType for name in names}
    whole = Range(None, None, 0, rows, rows if total is None else total)
    waiting = [(name, whole) for name in names]
    small: list[tuple[str, Range]] = [x for x in waiting if x[1].rows <= single_task_rows]
    large = [x for x in waiting if x[1].rows > single_task_rows]
    while large:
        cuts = _cuts(frame, columns, types, large)
        parts = _counted(frame, columns, types, large, cuts)
        waiting = large
        large = []
        for (name, outer), own, found in zip(waiting, cuts, parts, strict=True):
            edges, before = [outer.low, *own, outer.high], outer.before
            for k in range(len(own) + 1):
                n, held = found.get(k, (0, 0))
                part = Range(edges[k], edges[k + 1], before, n, held)
                before += held
                if not part.has_any(positions[name]):
                    continue
                if part.rows == outer.rows:
                    raise ValueError(f"keys of {name} are not unique, so positions in their order are not defined")
                (small if part.rows <= single_task_rows else large).append((name, part))
    return _numbered(frame, columns, types, small, positions)


def _cuts(frame: DataFrame, columns: dict[str, str], types: dict, ranges: list[tuple[str, Range]]) -> list[list[Row]]:
    """Ascending keys that cut each range about evenly, from the keys with the least hashes."""
    wanted = SAMPLES * RANGES
    drawn = []
    for i, (name, whole) in enumerate(ranges):
        key = F.col(columns[name])
        near = whole.holds(key, types[name])
        share = min(1.0, wanted / whole.rows)
        if share < 1:
            near = near & (F.xxhash64(key) <= int(-(2**63) + share * 2**64) - 1)
        drawn.append(F.sort_array(F.collect_set(F.when(near, key))).alias(f"cuts_{i}"))
    found = []
    for keys in frame.agg(*drawn).first():
        step = max(1, -(-len(keys) // RANGES))
        found.append(list(keys[step::step]))
    return found


def _per_name(frame: DataFrame, columns: dict[str, str], place: dict[str, Column]) -> DataFrame:
    """One row for each name that ``place`` has a number for; keys of other names are NULL."""
    entries = [
        F.struct(F.lit(name).alias("name"), at.alias("at"), F.col("n").alias("n"), *[
            (F.col(c) if other == name else F.lit(None).cast(frame.schema[c].dataType)).alias(c) for other, c in columns.items()
        ])
        for name, at in place.items()
    ]
    return frame.select(F.explode(F.array(*entries)).alias("row")).select("row.*").where(F.col("at").isNotNull())


def _counted(frame: DataFrame, columns: dict[str, str], types: dict, ranges: list[tuple[str, Range]], cuts: list[list[Row]]) -> list[dict]:
    """Rows and weight between the cuts of each range."""
    place: dict[str, Column] = {}
    for i, ((name, whole), own) in enumerate(zip(ranges, cuts, strict=True)):
        key = F.col(columns[name])
        part = range_of(key, own, types[name]) + F.lit(i * (RANGES + 1))
        inside = whole.holds(key, types[name])
        place[name] = F.when(inside, part).otherwise(place[name]) if name in place else F.when(inside, part)
    slim = _per_name(frame, columns, place).groupBy("at").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("weight"))
    found: list[dict] = [{} for _ in ranges]
    for at, rows, weight in slim.collect():
        found[at // (RANGES + 1)][at % (RANGES + 1)] = (rows, weight)
    return found


def _numbered(frame: DataFrame, columns: dict[str, str], types: dict, ranges: list[tuple[str, Range]], positions: Mapping[str, Sequence[int]]) -> dict[str, dict[int, Row]]:
    """The keys at the positions, all of which lie in small ranges."""
    place: dict[str, Column] = {}
    for name, part in ranges:
        inside = part.holds(F.col(columns[name]), types[name])
        place[name] = F.when(inside, F.lit(part.before)).otherwise(place[name]) if name in place else F.when(inside, F.lit(part.before))
    if not place:
        return {}
    rows = _per_name(frame, columns, {name: at.cast("bigint") for name, at in place.items()})
    order = Window.partitionBy("name", "at").orderBy(*columns.values())
    rows = rows.withColumn("upto", F.col("at") + F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    hit = F.lit(False)
    for name in place:
        wanted = F.array(*[F.lit(p).cast("bigint") for p in positions[name]])
        hit = hit | ((F.col("name") == name) & F.exists(wanted, lambda p: (p <= F.col("upto")) & (p > F.col("upto") - F.col("n"))))
    found: dict[str, dict[int, Row]] = {name: {} for name in place}
    for row in rows.where(hit).collect():
        for p in positions[row["name"]]:
            if row["upto"] - row["n"] < p <= row["upto"]:
                found[row["name"]][p] = row[columns[row["name"]]]
    return found


def range_of(key: Column, cuts: Sequence[Row], key_type: T.StructType) -> Column:
    """Number of the range that a key falls into, by binary search in generated code; a function of the row alone."""
    literals = [as_literal(cut, key_type) for cut in cuts]

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(key < literals[middle], search(low, middle)).otherwise(search(middle + 1, high))

    return search(0, len(cuts))


def as_literal(key: Row, key_type: T.StructType) -> Column:
    return F.struct(*[F.lit(key[f.name]).cast(f.dataType).alias(f.name) for f in key_type.fields])


def exact_percentiles(df: DataFrame, value: str, fractions: Mapping[str, float], single_task_rows: int) -> DataFrame:
    """A16 for input of any size: one row with the interpolated percentile for each named fraction, as doubles.

    Rows are added up per distinct value first, so a value that many rows share is one row; then the values at the two
    positions around each percentile are selected.  NULLs don't count; without any value all percentiles are NULL.
    """
    counted = Stored(df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n")), "percentile-values")
    total = counted.df.agg(F.sum("n")).first()[0] or 0
    wanted = {name: q * (total - 1) for name, q in fractions.items()}
    positions = sorted({p for at in wanted.values() for p in (math.floor(at) + 1, math.ceil(at) + 1)}) if total else []
    keys = rows_at(counted.df, {"value": F.struct("value")}, {"value": positions}, counted.rows, single_task_rows, F.col("n"), total).get("value", {})

    def between(at: float) -> float | None:
        if not total:
            return None
        low, high = math.floor(at), math.ceil(at)
        below, above = float(keys[low + 1]["value"]), float(keys[high + 1]["value"])
        return below if low == high else (high - at) * below + (at - low) * above

    return df.sparkSession.createDataFrame([tuple(between(at) for at in wanted.values())], ", ".join(f"`{name}` double" for name in wanted))
