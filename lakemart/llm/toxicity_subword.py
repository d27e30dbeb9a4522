"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams, hashed to rows of an embedding table; its vector is their
mean, a passage's vector the mean over its distinct words.  So a misspelling that was never seen shares most of its
vector with the word it stands for.  A document is as toxic as its most toxic passage: a few words in a long text are
not averaged away.  Embeddings and softmax are learned together by AdaGrad from that passage of each document in turn.
As the softmax is linear, scoring needs one number for each row of the table.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.pretokens import REMEMBERED
from lakemart.llm.texts import bounded_sample, map_texts

WORD = re.compile(r"\w+")
SHORTEST, LONGEST = 3, 4
#: Words of a passage; one with fewer distinct words than FEW is averaged as if it had as many, the others zero.
PASSAGE, FEW = 64, 24


def grams(word: str, buckets: int) -> list[int]:
    """Rows of the embedding table of a word's n-grams, ends marked."""
    data = f"<{word}>"
    found = [data[i : i + n] for n in range(SHORTEST, LONGEST + 1) for i in range(len(data) - n + 1)]
    return [zlib.crc32(x.encode("utf-8", "replace")) & (buckets - 1) for x in found]


@dataclass
class Model:
    """The logit of each row of the table towards label 1, and the offset."""

    logits: np.ndarray
    offset: float
    known: dict[str, float] = field(default_factory=dict)

    def _word(self, word: str) -> float:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        found = self.known[word] = float(self.logits[grams(word, len(self.logits))].mean())
        return found

    def score(self, text: str) -> float:
        """Probability of label 1 of a whole text, by its worst passage; one without words has the offset alone."""
        known, most = self.known, 0.0
        for k, words in enumerate(passages(text)):
            total = 0.0
            for word in words:
                value = known.get(word)
                total += self._word(word) if value is None else value
            total /= max(len(words), FEW)
            most = total if k == 0 else max(most, total)
        return float(1 / (1 + np.exp(-np.clip(self.offset + most, -60, 60))))


def passages(text: str) -> list[set[str]]:
    """The distinct words of each passage."""
    words = WORD.findall(text.lower())
    return [set(words[i : i + PASSAGE]) for i in range(0, len(words), PASSAGE)]


def bag(text: str, buckets: int, known: dict[str, list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the table that a text uses, their weights, and where its passages start among them."""
    rows, weights, starts = [], [], []
    for words in passages(text):
        starts.append(len(rows))
        for word in words:
            own = known.get(word)
            if own is None:
                own = known[word] = grams(word, buckets)
            rows += own
            weights += [1 / len(own) / max(len(words), FEW)] * len(own)
    return np.array(rows, np.int32), np.array(weights, np.float32), np.array(starts, np.int64)


def train(texts: list[str], labels: list[int], buckets: int = 1 << 17, size: int = 8, epochs: int = 20, rate: float = 0.5, seed: int = 7) -> Model:
    """Embeddings and softmax from labelled texts; without both labels, a model that says what it has seen."""
    random = np.random.default_rng(seed)
    share = (sum(labels) + 0.5) / (len(labels) + 1) if labels else 0.0
    if len(set(labels)) < 2:
        return Model(np.zeros(buckets, np.float32), float(np.log(share / (1 - share))) if labels else -60.0)
    table = random.uniform(-1 / size, 1 / size, (buckets, size)).astype(np.float32)
    softmax, offsets = random.uniform(-1, 1, (2, size)).astype(np.float32), np.zeros(2, np.float32)
    seen_table, seen_softmax, seen_offsets = np.full(buckets, 1e-6, np.float32), np.full((2, size), 1e-6, np.float32), np.full(2, 1e-6, np.float32)
    known: dict[str, list[int]] = {}
    bags, chosen = [bag(t, buckets, known) for t in texts], {}
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in random.permutation(len(bags)):
            rows, weights, starts = bags[i]
            if not len(starts):
                continue
            if epoch & (epoch - 1) == 0:  # at first any passage, then the worst one, chosen again in epochs 1, 2, 4, 8...
                vectors = np.add.reduceat(table[rows] * weights[:, None], starts)
                k = int((vectors @ (softmax[1] - softmax[0])).argmax()) if epoch else int(random.integers(len(starts)))
                part = slice(starts[k], starts[k + 1] if k + 1 < len(starts) else None)
                used, where = np.unique(rows[part], return_inverse=True)
                chosen[i] = used, np.bincount(where, weights[part]).astype(np.float32)
            used, pull = chosen[i]
            mean = pull @ table[used]
            logits = softmax @ mean + offsets
            p = np.exp(logits - logits.max())
            wrong = p / p.sum() - np.array([1 - labels[i], labels[i]], np.float32)
            back, out = wrong @ softmax, np.outer(wrong, mean)
            seen_softmax += out * out
            seen_offsets += wrong * wrong
            seen_table[used] += (back @ back) * pull * pull / size
            table[used] -= np.outer(step * pull / np.sqrt(seen_table[used]), back)
            softmax -= step * 0.1 * out / np.sqrt(seen_softmax)
            offsets -= step * 0.1 * wrong / np.sqrt(seen_offsets)
    return Model(table @ (softmax[1] - softmax[0]), float(offsets[1] - offsets[0]))


def labelled(docs: DataFrame, labels: DataFrame, learn: Column, fit_rows: int) -> DataFrame:
    """At most ``fit_rows`` texts with label 1 and as many with label 0, of the labels that ``learn`` lets through."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & learn)
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    drawn = [bounded_sample(known.where(F.col("toxic") == k), "doc_id", fit_rows, counts.get(k, 0)) for k in (0, 1)]
    chosen = drawn[0].union(drawn[1])  # at most 2 * fit_rows rows of two numbers
    return docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, learn: Column, fit_rows: int = 4000) -> Model:
    """A model from a bounded sample of labelled texts, trained in one task.

    ``fit_rows`` bounds the texts of each label; only they reach that task.  A doc_id that repeats in ``docs`` counts once, as its first text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = {}
        for batch in batches:
            for doc_id, text, toxic in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                old = rows.get(doc_id)
                rows[doc_id] = (min(text or "", old[0]) if old else text or "", toxic)
        found = [rows[k] for k in sorted(rows)]
        model = train([t for t, _ in found], [y for _, y in found])
        yield pa.RecordBatch.from_arrays([pa.array([model.logits.tobytes()]), pa.array([model.offset])], names=["logits", "offset"])

    made = labelled(docs, labels, learn, fit_rows).repartition(1).mapInArrow(run, "logits binary, offset double").first()
    return Model(np.frombuffer(made["logits"], np.float32), made["offset"]) if made else train([], [])


def scores(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all) of each row and its score, 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a table of fixed size

    def work(texts: list[bytes]) -> dict[str, list]:
        return {"score": pa.array([shared.value.score(t.decode("utf-8", "replace")) for t in texts], pa.float64())}

    return map_texts(docs, text, docs.columns if keep is None else keep, work, "score double")


#: A fifth of the ids, never learned from.
HELD_OUT = "crc32(cast(cast(doc_id as string) as binary)) % 5 = 0"


def toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", fit_rows: int = 4000) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from 0.5) of each row; labels of held-out ids are not learned.

    NULL and empty texts get the score of a text without words.  Repeated rows stay, a NULL doc_id is not held out and
    not learned; an empty table gives an empty one, and without labels every score is near 0.  Only the text is an
    input of the score; further columns are not read.
    """
    ids = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    marks = labels.select(F.col(f"`{id_col}`").alias("doc_id"), "toxic")
    model = fit(ids, marks, ~F.expr(HELD_OUT), fit_rows)
    found = scores(ids, model, "text", ["doc_id"])
    held_out = F.coalesce(F.expr(HELD_OUT), F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
