"""Mixing sources to target weights by Pfair scheduling.

The rows of each source are cut into blocks.  Block j of a source of weight w is released at slot floor(j / w) and due
at slot ceil((j + 1) / w); in every slot the released block with the earliest deadline runs.  With weights that add
up to 1 this meets all deadlines, so after any number of slots every source is less than one block from its share.

Weights are whole numbers of slots of a period, so the schedule of one period, a table of bounded size, gives the slot
of any block by arithmetic.  The period has as many slots as the mix has blocks, up to ``MOST_SLOTS``; up to there the
shares of the table are met exactly, beyond it weights are rounded to multiples of 1 / ``MOST_SLOTS``, and a source has
one slot at least.  A source that has run out leaves its slots empty and the others go on.
"""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.texts import fresh_name


#: Slots of a period, and sources with slots of their own: the smaller ones share theirs.
MOST_SLOTS, MOST_SOURCES = 100_000, 2_000
#: Columns that the mix adds.
PLACE = ["block", "slot", "release", "deadline", "in_mix"]
#: Least slots of a period whose weights are given or capped.
FEWEST_SLOTS = 1000


def whole_shares(weights: dict, period: int) -> dict:
    """Slots of a period for each source: its share, rounded by largest remainder, one at least."""
    total = sum(map(Fraction, weights.values()))
    exact = {s: Fraction(w) * period / total for s, w in weights.items()}
    shares = {s: max(1, math.floor(x)) for s, x in exact.items()}
    missing = period - sum(shares.values())
    for s in sorted(exact, key=lambda s: (shares[s] - exact[s], str(s)))[: max(missing, 0)]:
        shares[s] += 1
    return shares


def schedule(shares: dict) -> list[tuple]:
    """``(source, block, slot, release, deadline)`` of one period, earliest deadline first; ``shares`` are slots of the period."""
    period = sum(shares.values())
    waiting = sorted((j * period // a, -((j + 1) * period // -a), str(s), j, s) for s, a in shares.items() for j in range(a))
    ready, rows, at = [], [], 0
    for slot in range(period):
        while at < period and waiting[at][0] <= slot:
            release, deadline, name, j, s = waiting[at]
            heapq.heappush(ready, (deadline, name, j, release, s))
            at += 1
        deadline, _, j, release, s = heapq.heappop(ready)
        rows.append((s, j, slot, release, deadline))
    return rows


def capped_weights(counts: dict, cap: float) -> dict:
    """Weights in proportion to ``counts``, none above ``cap`` of the whole (or an equal share, if that is more)."""
    cap = max(Fraction(cap), Fraction(1, max(len(counts), 1)))
    weights, fixed = {s: Fraction(n) for s, n in counts.items()}, set()
    while True:
        total = sum(weights[s] for s in weights if s not in fixed)
        room = 1 - cap * len(fixed)
        over = {s for s in weights if s not in fixed and weights[s] * room > cap * total}
        if not over:
            return {s: cap if s in fixed else weights[s] * room / total for s in weights}
        fixed |= over


def mix(docs: DataFrame, weights: dict | None = None, source: str = "source", cap: float = 1.0, block_rows: int = 16, seed: int = 2,
        most_slots: int = MOST_SLOTS, most_sources: int = MOST_SOURCES) -> DataFrame:
    """Every row of ``docs`` with its place in the mix: block, slot, release, deadline, in_mix.

    Rows of a source follow the hash of their values; its last block may be a part.  Until it has run out, a source is less
    than one block from its share of the slots, at any slot.  No row is dropped and none repeats.  Without ``weights``
    the shares are those of the table, none above ``cap``: a capped source goes on after the others.  A
    source without a weight is not mixed (NULL places, in_mix false); one with a weight but without rows is left out.
    Without weights, the sources beyond the ``most_sources`` largest are mixed as one.  NULL is a source like any other.
    Repeated rows are places of their own; an empty table gives an empty one.  Columns named like the new ones are replaced.
    """
    spark = docs.sparkSession
    columns = [c for c in docs.columns if c.lower() not in PLACE]
    sizes = docs.groupBy(F.col(f"`{source}`").cast("string").alias("s")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        found = sizes.orderBy(F.desc("n"), "s").limit(most_sources).collect()
        counts = {r["s"]: r["n"] for r in found}
        rest = (sizes.agg(F.sum("n")).first()[0] or 0) - sum(counts.values()) if len(found) == most_sources else 0
    else:
        wanted = {None if s is None else str(s): w for s, w in weights.items() if w > 0}
        named = [s for s in wanted if s is not None]
        mine = F.col("s").isin(named) | F.col("s").isNull() if None in wanted else F.col("s").isin(named)
        counts, rest = {r["s"]: r["n"] for r in sizes.where(mine).collect()}, 0
    blocks = {(s,): -(-n // block_rows) for s, n in counts.items()}
    if rest:
        blocks[()] = -(-rest // block_rows)  # the key of all smaller sources
    total = sum(blocks.values())
    if weights is None:
        targets = capped_weights(blocks, cap)
        period = total if all(targets[s] * total == blocks[s] for s in blocks) else max(total, FEWEST_SLOTS)
    else:
        targets, period = {(s,): wanted[s] for s in counts}, max(total, FEWEST_SLOTS)
    shares = whole_shares(targets, min(period, most_slots)) if targets else {}
    length = sum(shares.values())
    order_of = {s: i for i, s in enumerate(shares)}
    slots = [(order_of[s], j, slot, r, d) for s, j, slot, r, d in schedule(shares)]
    names = {c: fresh_name(docs, f"_{c}") for c in ("order", "bucket", "row", "before", "block", "of", "share", "j", "slot", "release", "deadline", "known", "b", "o", "key")}
    n = lambda c: F.col(names[c])
    table = spark.createDataFrame(slots, ", ".join(f"{names[c]} int" for c in ("o", "j", "slot", "release", "deadline")))
    known = spark.createDataFrame([(s[0] if s else None, order_of[s], shares[s]) for s in shares if s], f"{names['known']} string, {names['of']} int, {names['share']} int")
    own = F.col(f"`{source}`").cast("string")
    # Rows are numbered within (source, bucket); the buckets' sizes, far fewer than rows, give the offsets.
    buckets = max(1, -(-(sum(counts.values()) + rest) // 4096))
    hashed = docs.select(*[F.col(f"`{c}`") for c in columns], F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in columns]).alias(names["order"]))
    keyed = hashed.join(F.broadcast(known), own.eqNullSafe(n("known")), "left")
    if rest:
        keyed = keyed.withColumns({names["share"]: F.coalesce(n("share"), F.lit(shares[()])), names["of"]: F.coalesce(n("of"), F.lit(order_of[()]))})
    keyed = keyed.withColumn(names["bucket"], F.floor((F.shiftrightunsigned(names["order"], 33) * buckets) / F.lit(1 << 31)))
    earlier = Window.partitionBy(names["of"]).orderBy(names["bucket"]).rowsBetween(Window.unboundedPreceding, -1)
    sums = keyed.groupBy(names["of"], names["bucket"]).agg(F.count(F.lit(1)).alias(names["row"]))
    offsets = sums.select(n("of").alias(names["key"]), n("bucket").alias(names["b"]), F.coalesce(F.sum(names["row"]).over(earlier), F.lit(0)).alias(names["before"]))
    numbered = keyed.withColumn(names["row"], F.row_number().over(Window.partitionBy(names["of"], names["bucket"]).orderBy(names["order"])) - 1)
    numbered = numbered.join(offsets, n("of").eqNullSafe(n("key")) & (n("bucket") == n("b")))
    numbered = numbered.withColumn(names["block"], F.when(n("of").isNotNull(), F.floor((n("row") + n("before")) / block_rows)))
    placed = numbered.join(F.broadcast(table), (n("of") == n("o")) & ((n("block") % n("share")).cast("int") == n("j")), "left")
    base = F.floor(n("block") / n("share")) * length
    return placed.select(
        *[F.col(f"`{c}`") for c in columns], n("block").alias("block"), (base + n("slot")).alias("slot"), (base + n("release")).alias("release"),
        (base + n("deadline")).alias("deadline"), n("of").isNotNull().alias("in_mix"),
    )


def mixed(docs: DataFrame, seed: int = 2, **options) -> DataFrame:
    """The rows of ``docs`` that the mix takes, in files that follow its order; all columns unchanged.

    Rows of a slot stand in the order of their block, so the order is the same on every run.
    """
    order = F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in docs.columns if c.lower() not in PLACE])
    taken = mix(docs, seed=seed, **options).where("in_mix")
    return taken.repartitionByRange("slot").sortWithinPartitions("slot", order).select(*[F.col(f"`{c}`") for c in docs.columns])


def in_file_order(docs: DataFrame) -> DataFrame:
    """Rows of a table read from files, with ``_part`` and ``_row``: the number of their file and of the row in it."""
    return docs.select("*", F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("int").alias("_part"), F.col("_metadata.row_index").alias("_row"))


def streamed(placed: DataFrame, size: str) -> DataFrame:
    """``placed``, a stored table with ``_part`` and ``_row``, with its place in the stream of all rows: ``place`` (rows before
    it) and ``start`` (their ``size`` added up).  Only the totals of the files, a row each, are summed in one task."""
    before = Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    files = placed.groupBy(F.col("_part").alias("_of")).agg(F.count(F.lit(1)).alias("_rows"), F.sum(size).alias("_size"))
    files = files.select("_of", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("_rows", "_size")])
    above = Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    own = placed.withColumns({"place": F.count(F.lit(1)).over(above), "start": F.coalesce(F.sum(size).over(above), F.lit(0))})
    both = own.join(F.broadcast(files), F.col("_part") == F.col("_of"))
    return both.withColumns({"place": F.col("place") + F.col("_rows"), "start": F.col("start") + F.col("_size")}).drop("_part", "_row", "_of", "_rows", "_size")
