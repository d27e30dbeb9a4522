"""Language ID: a byte convolutional network, trained in numpy.

A text is cut into windows of fixed length.  Bytes are embedded, filters of several widths run over the window, the
maximum of each filter over all places (rectified) goes into a softmax over the languages.  A language's score of a text is
its mean probability over all windows, each weighted by its bytes.  Training is Adam on windows of labelled texts;
behind the maximum only the place that gave it is changed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.texts import fresh_name, map_texts

#: Bytes of a window, sizes of embedding and filters, windows that are looked at together.
WINDOW, SIZE, FILTERS, TOGETHER = 256, 8, 32, 64
WIDTHS = (2, 3, 4)
LETTER = re.compile(r"[^\W\d_]")
UNKNOWN = "und"
#: A third of the ids, never learned from.
HELD_OUT = "crc32(cast(cast(doc_id as string) as binary)) % 3 = 1"


@dataclass
class Model:
    """Parameters by name, and the languages in the order of the softmax."""

    values: dict[str, np.ndarray]
    languages: list[str]

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        return _softmax(_pooled(self.values, windows)[0] @ self.values["out"] + self.values["offset"])


def cut(data: bytes) -> np.ndarray:
    """All windows of a text; the last one is filled up with byte 0."""
    count = max(1, -(-len(data) // WINDOW))
    return np.frombuffer(data.ljust(count * WINDOW, b"\0"), np.uint8).reshape(count, WINDOW)


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _patches(embedded: np.ndarray, width: int) -> np.ndarray:
    """Every stretch of ``width`` embedded bytes of each window as one row."""
    count, places = len(embedded), WINDOW - width + 1
    step = embedded.strides
    return np.lib.stride_tricks.as_strided(embedded, (count, places, width * SIZE), (step[0], SIZE * step[2], step[2]))


def _pooled(values: dict[str, np.ndarray], windows: np.ndarray, places: bool = False) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rectified maxima of all filters, and on request the places that gave them."""
    embedded = values["bytes"][windows]
    parts, where = [], []
    for width in WIDTHS:
        found = _patches(embedded, width).reshape(-1, width * SIZE) @ values[f"filters{width}"]
        found = found.reshape(len(windows), -1, FILTERS)
        if places:
            at = found.argmax(axis=1)
            where.append(at)
            best = np.take_along_axis(found, at[:, None, :], 1)[:, 0]
        else:
            best = found.max(axis=1)
        parts.append(best + values[f"bias{width}"])
    return np.maximum(np.concatenate(parts, axis=1), 0), where


def _gradients(values: dict[str, np.ndarray], windows: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
    pooled, where = _pooled(values, windows, places=True)
    wrong = _softmax(pooled @ values["out"] + values["offset"])
    wrong[np.arange(len(labels)), labels] -= 1
    wrong /= len(labels)
    made = {"out": pooled.T @ wrong, "offset": wrong.sum(axis=0), "bytes": np.zeros_like(values["bytes"])}
    back = (wrong @ values["out"].T) * (pooled > 0)
    rows = np.arange(len(windows))[:, None, None]
    for k, width in enumerate(WIDTHS):
        pull = back[:, k * FILTERS : (k + 1) * FILTERS]
        used = windows[rows, where[k][:, :, None] + np.arange(width)]  # window, filter, byte of the best place
        seen = values["bytes"][used].reshape(len(windows), FILTERS, width * SIZE)
        made[f"filters{width}"] = np.einsum("nfe,nf->ef", seen, pull)
        made[f"bias{width}"] = pull.sum(axis=0)
        change = pull[:, :, None] * values[f"filters{width}"].T
        np.add.at(made["bytes"], used.reshape(-1), change.reshape(-1, SIZE))
    return made


def spread(data: bytes, count: int) -> list[bytes]:
    """At most ``count`` windows of a text, spread over it."""
    found = cut(data)
    return [found[k].tobytes() for k in np.unique(np.linspace(0, len(found) - 1, count).astype(int))]


def train(examples: list[bytes], labels: list[str], steps: int = 600, batch: int = 48, rate: float = 0.005, seed: int = 11) -> Model:
    """A network from labelled windows.

    Languages have equal weight: windows are drawn by language first.  Without any label the model knows no language.
    """
    languages = sorted(set(labels))
    if not languages:
        return Model({}, [])
    random = np.random.default_rng(seed)
    known = range(len(languages))
    pools = [np.frombuffer(b"".join(sorted(x for x, y in zip(examples, labels, strict=True) if y == lang)), np.uint8).reshape(-1, WINDOW) for lang in languages]
    values = {"bytes": random.normal(0, 0.3, (256, SIZE)), "out": random.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))), "offset": np.zeros(len(languages))}
    for width in WIDTHS:
        values |= {f"filters{width}": random.normal(0, (width * SIZE) ** -0.5, (width * SIZE, FILTERS)), f"bias{width}": np.zeros(FILTERS)}
    values = {k: v.astype(np.float32) for k, v in values.items()}
    first, second = ({k: np.zeros_like(v) for k, v in values.items()} for _ in range(2))
    for step in range(1, steps + 1 if len(known) > 1 else 1):
        picked = random.integers(len(pools), size=batch)
        windows = np.stack([pools[k][random.integers(len(pools[k]))] for k in picked])
        # A start at any byte, and at times only a short piece, as short texts are.
        for row in windows:
            row[:] = np.roll(row, random.integers(WINDOW))
            if random.random() < 0.3:
                row[random.integers(8, WINDOW) :] = 0
        pace = rate * (1 - step / (steps + 1))
        for name, slope in _gradients(values, windows, np.array(known)[picked]).items():
            first[name] += 0.1 * (slope - first[name])
            second[name] += 0.001 * (slope * slope - second[name])
            values[name] -= pace * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
    if len(known) == 1:  # nothing to tell apart
        values["offset"][known[0]] = 8.0
    return Model(values, languages)


def fit(docs: DataFrame, learn: Column, label: str = "lang", text: str = "text", id_col: str = "doc_id", fit_rows: int = 1500,
        windows_each: int = 4, most_languages: int = 200) -> Model:
    """A network from ``windows_each`` windows of at most ``fit_rows`` texts of each language, trained in one task.

    Only rows with a text and a language that ``learn`` lets through are learned from, of the ``most_languages`` commonest
    languages; they are drawn by the hash of their id, and cut where they lie, so that bounded rows reach that task.
    """
    place = F.xxhash64(F.col(f"`{id_col}`"), F.lit("sample"))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("binary").alias("text"), place.alias("place")
    )
    rows = rows.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_languages).collect()
    # A threshold on the hash first, so that no group grows with the table; then the exact bound.
    shares = docs.sparkSession.createDataFrame([(r[0], int(min(1.0, 1.3 * fit_rows / r[1]) * (1 << 30))) for r in counts], "lang string, share bigint")
    drawn = rows.join(F.broadcast(shares), "lang").where(F.pmod("place", F.lit(1 << 30)) < F.col("share"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            langs, places, texts = (c.to_pylist() for c in given.columns)
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(places, pa.int64()), pa.array([spread(t, windows_each) for t in texts], pa.list_(pa.binary()))], names=["lang", "place", "windows"])

    found = drawn.select("lang", "place", "text").mapInArrow(pieces, "lang string, place bigint, windows array<binary>")
    found = found.groupBy("lang", "place").agg(F.min("windows").alias("windows"))  # an id that repeats counts once
    nearest = Window.partitionBy("lang").orderBy("place")
    sample = found.withColumn("row", F.row_number().over(nearest)).where(F.col("row") <= fit_rows).select("lang", "windows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples, labels = [], []
        for given in batches:
            for lang, windows in zip(*(c.to_pylist() for c in given.columns), strict=True):
                examples += windows
                labels += [lang] * len(windows)
        made = train(examples, labels)
        values = list(made.values.values())
        shapes = pa.array([list(v.shape) for v in values], pa.list_(pa.int32()))
        known = pa.array([made.languages] * len(values), pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(made.values), pa.string()), pa.array([v.astype("<f4").tobytes() for v in values], pa.binary()), shapes, known],
            names=["name", "value", "shape", "languages"],
        )

    made = sample.repartition(1).mapInArrow(run, "name string, value binary, shape array<int>, languages array<string>").collect()  # one row a parameter
    return Model({r["name"]: np.frombuffer(r["value"], "<f4").reshape(r["shape"]) for r in made}, list(made[0]["languages"]) if made else [])


def score(model: Model, texts: list[bytes]) -> list[tuple[str, float]]:
    """Language and score of each text; texts without a letter, or all texts of an untrained model, are UNKNOWN."""
    found: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
    totals = np.zeros((len(texts), len(model.languages)))
    owners, windows, weights = [], [], []

    def settle() -> None:
        if windows:
            chances = model.probabilities(np.concatenate(windows)) * np.concatenate(weights)[:, None]
            np.add.at(totals, np.concatenate(owners), chances)
        owners.clear(), windows.clear(), weights.clear()

    held = 0
    seen = []
    for i, data in enumerate(texts):
        if not model.languages or not LETTER.search(data.decode("utf-8", "replace")):
            continue
        seen.append(i)
        pieces = cut(data)
        sizes = np.full(len(pieces), WINDOW)
        sizes[-1] = len(data) - WINDOW * (len(pieces) - 1)
        for a in range(0, len(pieces), TOGETHER):
            part = slice(a, a + TOGETHER)
            windows.append(pieces[part])
            weights.append(sizes[part] / len(data))
            owners.append(np.full(len(pieces[part]), i))
            held += len(pieces[part])
            if held >= TOGETHER:
                settle()
                held = 0
    settle()
    for i in seen:
        k = int(totals[i].argmax())
        found[i] = model.languages[k], float(min(max(totals[i, k], 0.0), 1.0))
    return found


def predictions(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all) of each row, lang_pred and score; the whole text counts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # parameters of fixed size
    columns = docs.columns if keep is None else keep
    kept = docs.select(*[f"`{c}`" for c in columns])
    names = [fresh_name(kept, n) for n in ("lang_pred", "score")]

    def work(texts: list[bytes]) -> dict[str, list]:
        found = score(shared.value, texts)
        return {names[0]: pa.array([x for x, _ in found], pa.string()), names[1]: pa.array([x for _, x in found], pa.float64())}

    return map_texts(docs, text, columns, work, f"`{names[0]}` string, `{names[1]}` double")


def languages(docs: DataFrame, text: str = "text", label: str = "lang", id_col: str = "doc_id", fit_rows: int = 1500) -> DataFrame:
    """doc_id, held_out, lang_pred and score (0 to 1) of each row; labels of held-out ids are not learned.

    lang_pred is a learned language, or ``und`` with score 0 if the text is NULL or has no letter, or if there is nothing to
    learn from.  Only the text is an input of a prediction.  A NULL doc_id is not held out and not learned; repeated rows
    stay, an empty table gives an empty one, further columns are not read.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.col(f"`{label}`").alias("lang"))
    model = fit(rows, ~F.expr(HELD_OUT), fit_rows=fit_rows)
    found = predictions(rows.select("doc_id", "text"), model, "text", ["doc_id"])
    return found.select("doc_id", F.coalesce(F.expr(HELD_OUT), F.lit(False)).alias("held_out"), "lang_pred", "score")
