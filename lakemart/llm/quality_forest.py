"""Quality rules: an isolation forest over rule statistics, its threshold calibrated from labelled rows.

Every tree splits a small subsample at random features and random values; documents that few splits set apart
have short paths and are anomalous.  The trees hold documents that are labelled good, and are cut in the box of all labelled
ones; otherwise labels set the threshold only: the lowest score that rejects at most ``clean_loss`` of the labelled good
documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemart.llm.texts import bounded_sample, fresh_name, map_texts, stored

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\v\f\r"
UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
TAILS = bytes(range(0x80, 0xC0))  # bytes of a character after its first
#: Odd factors by which the word ids of a window are hashed.
FACTORS = np.array([2 * x + 1 for x in np.random.default_rng(8).integers(0, 2**62, WINDOW, np.uint64)], np.uint64)

STATISTICS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint,"
    " n_lines bigint, n_upper bigint, n_letters bigint, n_twins bigint"
)
NAMES = [x.split()[0] for x in STATISTICS.split(",")]


def repeat_words(ids: np.ndarray) -> int:
    """Words inside 8-word windows that occur twice or more."""
    n = len(ids) - WINDOW + 1
    if n < 2:
        return 0
    wide = ids.astype(np.uint64)
    hashes = sum((wide[k : k + n] * FACTORS[k] for k in range(WINDOW)), np.zeros(n, np.uint64))
    order = np.argsort(hashes, kind="stable")
    near = np.flatnonzero(hashes[order[1:]] == hashes[order[:-1]])
    if not len(near):
        return 0
    first, second = order[near], order[near + 1]
    if any((ids[first + k] != ids[second + k]).any() for k in range(WINDOW)):  # two windows share a hash by chance
        windows = np.lib.stride_tricks.sliding_window_view(ids, WINDOW)
        _, which, counts = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
        starts = np.flatnonzero(counts[which.ravel()] > 1)
    else:
        starts = np.union1d(first, second)
    edges = np.zeros(len(ids) + 1, np.int64)
    edges[starts] += 1
    edges[starts + WINDOW] -= 1
    return int((np.cumsum(edges)[:-1] > 0).sum())


def statistics(text: bytes) -> tuple[int, ...]:
    """The values of ``STATISTICS`` for one whole text."""
    words = text.split()  # of bytes: ASCII white space only
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    bare = text.translate(None, SPACE)
    lines = [x for x in text.split(b"\n") if x.strip()]
    upper = len(bare) - len(bare.translate(None, UPPER))
    letters = upper + len(bare) - len(bare.translate(None, LOWER))
    return (
        len(words),
        len(bare.translate(None, TAILS)),
        len(bare) - len(bare.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(ids),
        len(lines),
        upper,
        letters,
        int((ids[1:] == ids[:-1]).sum()),
    )


def with_statistics(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    def work(texts: list[bytes]) -> dict[str, list]:
        rows = np.array([statistics(t) for t in texts], np.int64).reshape(-1, len(NAMES))
        return dict(zip(NAMES, (np.ascontiguousarray(c) for c in rows.T), strict=True))

    return map_texts(docs, text, keep, work, STATISTICS)


#: The fixed rules: fewer than 20 words, or over 30 % of them in repeated windows.
BASE_FAILED = "n_words < 20 or 100 * n_repeat_words > 30 * n_words"


def features(values: np.ndarray) -> np.ndarray:
    """Rates that don't depend on length, from rows of ``STATISTICS``; roots spread out what is near zero."""
    words, chars, symbols, dup_lines, repeats, lines, upper, letters, twins = values.reshape(-1, len(NAMES)).T.astype(float)
    words, lines, letters = (np.maximum(x, 1) for x in (words, lines, letters))
    rates = np.sqrt([np.minimum(symbols / words, 1), dup_lines / lines, repeats / words, upper / letters, twins / words])
    return np.column_stack([np.log1p(chars / words), *rates])


@dataclass
class Forest:
    """Trees as arrays: of node i of a tree, the feature (-1: leaf), the cut, the left child (right: next), the path length."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    usual: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Anomaly of each row, 0 to 1."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, cut, left, path in self.trees:
            at = np.zeros(len(x), np.int64)
            while (inner := feature[at] >= 0).any():
                go = at[inner]
                at[inner] = left[go] + (x[rows[inner], feature[go]] >= cut[go])
            total += path[at]
        return 2.0 ** (-total / max(1, len(self.trees)) / self.usual)


def usual_path(n: int) -> float:
    """Mean path length of an unsuccessful search in a binary tree of n rows."""
    return 0.0 if n < 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n if n > 2 else 1.0


def grow(x: np.ndarray, low: np.ndarray, high: np.ndarray, trees: int = 100, subsample: int = 256, depth: int = 12, seed: int = 5) -> Forest:
    """An isolation forest over the rows of x; without rows, one in which everything is usual.

    Cuts are drawn from the box ``low`` to ``high`` and its halves, not from the range of the rows inside: what lies
    where no row of x is reaches an empty leaf early.
    """
    random, made = np.random.default_rng(seed), []
    size = min(subsample, len(x))
    for _ in range(trees if len(x) else 0):
        feature, cut, left, path = [-1], [0.0], [0], [0.0]
        todo = [(0, x[random.choice(len(x), size, replace=False)], low, high, 0)]
        while todo:
            node, rows, a, b, level = todo.pop()
            if len(rows) < 2 or level == depth:
                path[node] = level + usual_path(len(rows))
                continue
            f = int(random.integers(x.shape[1]))
            at = random.uniform(a[f], b[f])
            feature[node], cut[node], left[node] = f, at, len(feature)
            inner = np.where(np.arange(len(a)) == f, at, a), np.where(np.arange(len(b)) == f, at, b)
            below = rows[:, f] < at
            for part, box in ((rows[below], (a, inner[1])), (rows[~below], (inner[0], b))):
                todo.append((len(feature), part, *box, level + 1))
                feature.append(-1), cut.append(0.0), left.append(0), path.append(0.0)
        made.append((np.array(feature), np.array(cut), np.array(left), np.array(path)))
    return Forest(made, max(usual_path(size), 1.0))


@dataclass
class Model:
    forest: Forest
    threshold: float

    def scores(self, statistics: np.ndarray) -> np.ndarray:
        return self.forest.scores(features(statistics))


BINS = 2000


def fit(stats: DataFrame, labels: DataFrame, fit_rows: int = 20_000, clean_weight: float = 5.0, id_col: str = "doc_id") -> Model:
    """A forest and its threshold from ``stats(doc_id, STATISTICS)`` and ``labels(doc_id, quality)``.

    The forest is grown over a sample of at most ``fit_rows`` labelled rows: trees hold the good ones, the box spans
    all.  The threshold weighs the score counts of *all* labelled rows: rejected bad share less ``clean_weight``
    times the rejected good share, the highest of the best.  Labels that are NULL or that meet no row have no part;
    without any labelled rows, or without bad ones, nothing is rejected.
    """
    marked = labels.where("quality is not null").select(F.col(id_col), (F.col("quality") > 0).cast("int").alias("good"))
    known = stored(stats.join(marked, id_col).select(id_col, "good", *NAMES), "labelled")
    sample = np.array(bounded_sample(known, id_col, fit_rows, known.count()).select("good", *NAMES).toPandas().sort_values(["good", *NAMES]), np.int64)
    x, good = features(sample[:, 1:]), sample[:, 0] == 1
    forest = grow(x[good], x.min(0), x.max(0)) if len(x) else grow(x, np.zeros(0), np.zeros(0))
    binned = scored(known, ["good"], Model(forest, np.inf)).groupBy("good", F.floor(F.col("anomaly") * BINS).alias("bin")).count()
    counts = np.zeros((2, BINS + 2))
    for row in binned.collect():  # two labels by BINS
        counts[row["good"], row["bin"] + 1] = row["count"]
    if not counts[0].sum():
        return Model(forest, np.inf)
    above = counts[:, ::-1].cumsum(1)[:, ::-1] / np.maximum(counts.sum(1, keepdims=True), 1)
    gain = above[0] - clean_weight * above[1]
    return Model(forest, (np.flatnonzero(gain == gain.max())[-1] - 1) / BINS)


def scored(stats: DataFrame, keep: list[str], model: Model) -> DataFrame:
    """``keep`` and the anomaly of each row of statistics."""
    shared = stats.sparkSession.sparkContext.broadcast(model)  # trees of a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[len(keep) :]])
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(shared.value.scores(values))], names=[*keep, "anomaly"])

    schema = StructType([stats.schema[c] for c in keep]).add("anomaly", "double")
    return stats.select(*keep, *NAMES).mapInArrow(run, schema)


def verdicts(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", fit_rows: int = 20_000) -> DataFrame:
    """For each row of ``docs``: doc_id, ``STATISTICS``, base_failed, anomaly (0 to 1) and kept.

    kept is false if the fixed rules fail, else if the anomaly is at or above the calibrated threshold.  NULL and
    empty texts have no words and fail.  Repeated rows and NULL ids keep their rows; an empty table gives an empty
    one; further columns are not read.
    """
    ids = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    stats = stored(with_statistics(ids, "text", ["doc_id"]), "statistics")
    model = fit(stats, labels.select(F.col(f"`{id_col}`").alias("doc_id"), "quality"), fit_rows)
    found = scored(stats, ["doc_id", *NAMES], model)
    return found.withColumn("base_failed", F.expr(BASE_FAILED)).withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < model.threshold))


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", fit_rows: int = 20_000) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns unchanged.  No text is shuffled: texts are read twice."""
    ids = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    model = fit(with_statistics(ids, "text", ["doc_id"]), labels.select(F.col(f"`{id_col}`").alias("doc_id"), "quality"), fit_rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = fresh_name(docs, "_kept")

    def work(texts: list[bytes]) -> dict[str, list]:
        rows = np.array([statistics(t) for t in texts], np.int64).reshape(-1, len(NAMES))
        failed = (rows[:, 0] < 20) | (100 * rows[:, 4] > 30 * rows[:, 0])
        return {kept: pa.array(~failed & (shared.value.scores(rows) < shared.value.threshold))}

    return map_texts(docs, text, docs.columns, work, f"`{kept}` boolean").where(f"`{kept}`").drop(kept)
