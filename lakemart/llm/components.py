"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.texts import stored


def _with_least(edges: DataFrame) -> DataFrame:
    """Directed edges ``(u, v)`` with ``m``, the least of u and its neighbours; a join, so that a hub is split.

    A sort-merge join: both sides are dealt by u anyway, and no table of each round passes through the driver.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least.hint("merge"), "u").select("u", "v", F.least("u", "m").alias("m"))


def _each(edges: DataFrame, *ends: tuple[str, str]) -> DataFrame:
    """A row ``(u, v)`` of each row of ``edges`` for each pair of its columns; unlike a union, it reads ``edges`` once."""
    pairs = F.array(*[F.struct(F.col(a).alias("u"), F.col(b).alias("v")) for a, b in ends])
    return edges.select(F.explode(pairs).alias("e")).select("e.u", "e.v")


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node of the distinct ``edges(u, v)``, u > v, either hangs on one node or has nodes hang on it."""
    sides = F.array(*[F.struct(F.col(c).alias("node"), F.lit(up).alias("up"), F.lit(1 - up).alias("down")) for c, up in (("u", 1), ("v", 0))])
    nodes = edges.select(F.explode(sides).alias("e")).groupBy("e.node").agg((F.sum("e.up") + F.max("e.down")).alias("n"))
    return (nodes.agg(F.max("n")).first()[0] or 0) < 2


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(u, v)``: root is the least node that can be reached.

    Each round hangs larger neighbours on the least one, then smaller ones (large star, small star);
    the links shrink to stars in about the logarithm of the longest path, and no round follows.  Half rounds are
    written to the shared folder, so that no plan holds more than one and what the driver keeps of plans and tasks
    stays small.  Self links and repeated links are allowed; an empty table gives an empty table.
    """
    edges = stored(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    while not _are_stars(edges):
        both = _each(edges, ("u", "v"), ("v", "u"))
        # As many rows as links, so repeated ones can stay until the next half.
        large = stored(_with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")), "links")
        edges = stored(_each(_with_least(large), ("v", "m"), ("u", "m")).where("u <> v").distinct(), "links")
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.select(F.col("v").alias("node"), F.col("v").alias("root")))
