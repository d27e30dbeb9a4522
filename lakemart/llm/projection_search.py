"""Nearest neighbours by low-dimensional stable projections and kd-trees.

Vectors are projected to ``m`` dimensions by Gaussian (2-stable) directions: the squared projected distance of two
vectors, over their squared distance, follows the chi-square distribution with m degrees of freedom.  So projected
neighbours are looked at in the order of their projected distance and verified with the real one, until the k-th best
distance found, d, is so small that a closer vector would have been met with probability ``confidence`` at least: the
chi-square distribution function of (projected distance / d)^2 has reached it.

The top of the kd-tree, cut on a bounded sample, deals the projected vectors to cells of about ``CELL`` rows; each cell
has its own kd-tree inside a task.  A query first searches its own cell.  The d found there bounds the projected
radius within which the stopping test can still fail, so it then goes only to the cells that this ball meets.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.texts import bounded_sample, stored

CELL, LEAF = 2048, 32


def chi_square(x: float, m: int) -> float:
    """Distribution function for an even number m of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(m // 2))


def stop_ratio(confidence: float, m: int) -> float:
    """Squared projected distance over d^2 at which the stopping test holds."""
    low, high = 0.0, 1000.0
    while high - low > 1e-9:
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, m) < confidence else (low, middle)
    return high


class Cuts:
    """The top of the kd-tree: node i is cut at ``at[i]`` along dimension ``level % m``; children 2i + 1 and 2i + 2."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth, self.m = depth, sample.shape[1]
        self.at = np.zeros(2**depth - 1)
        parts = [sample]
        for level in range(depth):
            f, nxt = level % self.m, []
            for j, part in enumerate(parts):
                cut = float(np.median(part[:, f])) if len(part) else 0.0
                self.at[2**level - 1 + j] = cut
                nxt += [part[part[:, f] < cut], part[part[:, f] >= cut]]
            parts = nxt

    def cells(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        for level in range(self.depth):
            node = 2 * node + 1 + (x[:, level % self.m] >= self.at[node])
        return node - (2**self.depth - 1)

    def met(self, x: np.ndarray, radius: float) -> list[int]:
        """Cells that the ball around x meets."""
        found, todo = [], [(0, 0, np.zeros(self.m))]
        while todo:
            node, level, off = todo.pop()
            if level == self.depth:
                found.append(node - (2**self.depth - 1))
                continue
            f = level % self.m
            gap = x[f] - self.at[node]
            for child, far in ((2 * node + 1, gap >= 0), (2 * node + 2, gap < 0)):
                away = off.copy()
                if far:
                    away[f] = max(away[f], abs(gap))
                if away @ away <= radius * radius:
                    todo.append((child, level + 1, away))
        return found


class Tree:
    """The kd-tree of one cell: leaves of at most ``LEAF`` rows with their boxes."""

    def __init__(self, projected: np.ndarray):
        self.leaves, todo = [], [np.arange(len(projected))]
        while todo:
            rows = todo.pop()
            if len(rows) <= LEAF:
                self.leaves.append(rows)
                continue
            f = int(np.ptp(projected[rows], axis=0).argmax())
            order = rows[np.argpartition(projected[rows, f], len(rows) // 2)]
            todo += [order[: len(rows) // 2], order[len(rows) // 2 :]]
        self.low = np.array([projected[r].min(0) for r in self.leaves])
        self.high = np.array([projected[r].max(0) for r in self.leaves])

    def search(self, vectors: np.ndarray, query: np.ndarray, place: np.ndarray, k: int, bound: float, ratio: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows and distances of the k nearest verified, none beyond ``bound``; leaves in order of projected distance."""
        gap = np.maximum(np.maximum(self.low - place, place - self.high), 0)
        near = (gap * gap).sum(1)
        rows, distances, done = np.zeros(0, np.int64), np.zeros(0), 0
        order = np.argsort(near, kind="stable")
        while done < len(order) and near[order[done]] <= ratio * bound * bound:
            more = np.concatenate([self.leaves[i] for i in order[done : done + 4]])
            done += 4
            rows = np.append(rows, more)
            away = vectors[more] - query
            distances = np.append(distances, np.sqrt((away * away).sum(1)))
            if len(rows) > k:
                best = np.lexsort((rows, distances))[:k]
                rows, distances = rows[best], distances[best]
            if len(rows) >= k:
                bound = min(bound, float(distances.max()))
        keep = distances <= bound
        return rows[keep], distances[keep]


def _matrix(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    whole = column.combine_chunks()
    flat = whole.flatten().to_numpy(zero_copy_only=False).astype(kind)
    return flat.reshape(len(whole), -1)


def _searched(k: int, ratio: float):
    """One cell: its points, ordered by their least id, and the queries that come to it."""

    def run(points: pa.Table, queries: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if points.num_rows and queries.num_rows:
            points = points.sort_by("class_id")
            ids = points["class_id"].to_numpy()
            vectors, tree = _matrix(points["vector"], np.float64), Tree(_matrix(points["place"], np.float64))
            places, bounds = _matrix(queries["place"], np.float64), queries["bound"].to_numpy()
            for i, (q, vector) in enumerate(zip(queries["query"].to_pylist(), _matrix(queries["vector"], np.float64), strict=True)):
                rows, distances = tree.search(vectors, vector, places[i], k, bounds[i], ratio)
                out[0].extend([q] * len(rows))
                out[1].extend(ids[rows].tolist())
                out[2].extend(distances.tolist())
        return pa.table({"query": pa.array(out[0], pa.int64()), "class_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})

    return run


def usable(vector: str) -> Column:
    """Vectors that take part: no NULL or non-finite component, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def nearest(
    table: DataFrame, is_query: Column, id_col: str = "vec_id", vector: str = "embedding", k: int = 10, m: int = 8, confidence: float = 0.95,
    sample_rows: int = 1_000_000, seed: int = 1,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest found of each row for which ``is_query`` (over the columns
    ``vec_id`` and ``vector``) holds, itself left out, ties to the smaller id.

    Equal vectors are one point that carries its k + 1 least ids, which is all that a result can need.  NULL vectors,
    NULL ids, vectors that are not ``usable`` and those of another length than most take no part.  Rows that repeat an
    id count once for each vector.  The tree's top is cut on 64 points for each cell, ``sample_rows`` (of m numbers each) at most; every point is indexed.  Empty
    tables and single vectors give no rows; further columns are not read.
    """
    spark = table.sparkSession
    rows = table.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), F.col(f"`{vector}`").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable("vector"))
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if lengths is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows = rows.where(F.size("vector") == lengths["n"]).distinct()
    directions = np.random.default_rng(seed).standard_normal((lengths["n"], m))
    # Classes of equal vectors; the window keeps k + 1 rows of each before anything is shuffled.
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    members = rows.withColumn("_n", place).where(F.col("_n") <= k + 1).groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))

    def project(batches):
        for batch in batches:
            places = _matrix(pa.chunked_array([batch.column(0)]), np.float64) @ directions if batch.num_rows else np.zeros((0, m))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(places), pa.list_(pa.float64()))], names=["vector", "ids", "place"])

    kind = table.schema[vector].dataType.simpleString()
    points = stored(members.mapInArrow(project, f"vector {kind}, ids array<bigint>, place array<double>").withColumn("class_id", F.col("ids")[0]), "points")
    total = points.count()
    depth = max(0, math.ceil(math.log2(max(1, total / CELL))))
    sample = bounded_sample(points, "class_id", min(sample_rows, 64 * 2**depth), total).select("place").toPandas()["place"]
    cuts = Cuts(np.array(sample.tolist()).reshape(-1, m), depth)
    ratio = stop_ratio(confidence, m)

    @F.pandas_udf("bigint")
    def home(places):
        return pd.Series(cuts.cells(np.stack(places.to_numpy()))) if len(places) else pd.Series([], dtype="int64")

    def to_cells(batches):
        for batch in batches:
            cell, row = [], []
            places = _matrix(pa.chunked_array([batch.column(2)]), np.float64) if batch.num_rows else []
            for i, (at, bound, own) in enumerate(zip(places, batch.column(3).to_numpy(zero_copy_only=False), batch.column(4).to_numpy(zero_copy_only=False), strict=True)):
                met = [c for c in cuts.met(at, bound * math.sqrt(ratio)) if c != own]
                cell += met
                row += [i] * len(met)
            part = batch.take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array(cell, pa.int64())], names=["query", "vector", "place", "bound", "cell"])

    celled = points.withColumn("cell", home("place"))
    asked = rows.where(is_query).join(points.select("vector", "class_id"), "vector").select("vec_id", F.col("class_id").alias("query"))
    asked = stored(asked, "asked")
    queries = celled.join(asked.select(F.col("query").alias("class_id")).distinct(), "class_id", "left_semi")
    queries = stored(queries.select(F.col("class_id").alias("query"), "vector", "place", F.lit(float("inf")).alias("bound"), "cell"), "queries")
    result = "query bigint, class_id bigint, score double"
    indexed = celled.select("cell", "class_id", "vector", "place").groupBy("cell")
    first = stored(indexed.cogroup(queries.groupBy("cell")).applyInArrow(_searched(k + 1, ratio), result), "first")
    bounds = first.groupBy("query").agg(F.when(F.count("*") > k, F.max("score")).otherwise(float("inf")).alias("bound"))
    others = queries.drop("bound").join(bounds, "query").select("query", "vector", "place", "bound", "cell")
    others = others.mapInArrow(to_cells, f"query bigint, vector {kind}, place array<double>, bound double, cell bigint")
    second = indexed.cogroup(others.groupBy("cell")).applyInArrow(_searched(k + 1, ratio), result)
    found = first.union(second).withColumn("_n", F.row_number().over(Window.partitionBy("query").orderBy("score", "class_id"))).where(F.col("_n") <= k + 1)
    expanded = found.join(points.select("class_id", "ids"), "class_id").select("query", "score", F.explode("ids").alias("vec_id"))
    nearest_ids = expanded.withColumn("_n", F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id"))).where(F.col("_n") <= k + 1)
    lists = nearest_ids.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("score", "vec_id"))).alias("found"))
    own = asked.join(lists, "query").select(F.col("vec_id").alias("query_id"), F.filter("found", lambda x: x["vec_id"] != F.col("vec_id")).alias("found"))
    return own.select("query_id", F.posexplode(F.slice("found", 1, k)).alias("i", "x")).select(
        "query_id", (F.col("i") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score")
    )
