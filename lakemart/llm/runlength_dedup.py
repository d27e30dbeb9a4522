"""Removal of repeated byte strings by a run-length suffix index.

Every string of ``length`` bytes chooses the least hash of the short grams inside it.  Successive strings of a text
that choose the same hash form a stretch; equal strings choose equally, so they meet in stretches of the same hash,
whatever texts they come from.  Stretches that are equal as a whole are told by 128-bit digests and their text is not
needed; of the others, one of each content goes with its hash's group into an index.  What stands in a group that is
too large for an index goes through further rounds as rows, by the least hash of longer and longer grams: strings that
differ agree on ever fewer of them.  The last grams are the strings themselves, which are only counted, so any group
comes to an end whatever it holds.

The index is the Burrows-Wheeler transform of the group's stretches in runs.  A suffix shares one byte less with its
neighbour in sorted order than the suffix before it in the text does, unless it stands at the end of a run.  So only
the sampled run ends are compared with their neighbours, and a pass through the text streams the matching statistics
of all positions: the longest match that starts there and stands elsewhere.  Matches of ``length`` bytes are marked.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemart.llm.texts import sliced, stored

GRAM = 32
#: Bytes that are hashed at a time; bytes that one index holds; stretches in a batch of rows.
PIECE, BATCH, ROWS = 1 << 22, 1 << 20, 1 << 14
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Where a text stands, and whether it stands nowhere else.
PLACE = ["a", "b", "base", "sole"]


def gram_lengths(length: int) -> list[int]:
    """Bytes of the grams of each round, up to the whole string; the last but one leaves only strings that end almost together."""
    return sorted({GRAM, max(GRAM, length * 5 // 8), length - max(1, length // 25), length})


def stretches(text: bytes, length: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last string start, and the chosen hash, of each stretch of a text, and whether it may repeat itself.

    A stretch that holds a string twice, d bytes apart, has its hash within the first d grams of the one and the last
    d of the other, so at two places, one at the left end of a string of the stretch, one at the right end.
    """
    data, found = np.frombuffer(text, np.uint8), []
    width = length - gram + 1
    for at in range(0, max(0, len(data) - length + 1), PIECE):
        part = data[at : at + PIECE + length - 1]
        h, size = part.astype(np.uint64) + np.uint64(1), 1
        while size < gram:
            step = min(size, gram - size)  # the last two halves may overlap
            h = h[:-step] * (MIX ** np.uint64(step) | np.uint64(1)) + h[step:]
            h ^= h >> np.uint64(29)
            size += step
        h = h * MIX
        h ^= h >> np.uint64(32)
        # Least of each window of ``width`` hashes: of the tail of one block and the head of the next.
        n = len(h) - width + 1
        whole = np.full(-(-len(h) // width) * width, np.uint64(2**64 - 1))
        whole[: len(h)] = h
        blocks = whole.reshape(-1, width)
        heads = np.minimum.accumulate(blocks, axis=1).ravel()
        tails = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(tails[:n], heads[width - 1 : width - 1 + n])
        starts = np.append(0, np.flatnonzero(least[1:] != least[:-1]) + 1)
        left = np.minimum.reduceat(np.where(h[:n] == least, np.arange(n), len(h)), starts)
        right = np.maximum.reduceat(np.where(h[width - 1 : width - 1 + n] == least, np.arange(width - 1, width - 1 + n), -1), starts)
        found.append((starts + at, np.append(starts[1:], n) - 1 + at, least[starts].view(np.int64), left < right))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    first, last, chosen, again = map(np.concatenate, zip(*found, strict=True))
    joined = np.append(False, (chosen[1:] == chosen[:-1]) & (first[1:] == last[:-1] + 1))  # across pieces
    again = again | np.append(joined[1:], False) | joined
    return first[~joined], last[np.append(~joined[1:], True)], chosen[~joined], np.logical_or.reduceat(again, np.flatnonzero(~joined))


def matching_statistics(strings: list[bytes], depth: int) -> list[np.ndarray]:
    """For each position of each string, the longest match from there inside the string that stands elsewhere too.

    Suffixes are sorted by their first ``depth`` bytes at least; matches up to that are exact, longer ones are found
    to be at least ``depth``.
    """
    text = np.concatenate([x for s in strings for x in (np.frombuffer(s, np.uint8).astype(np.int64) + 1, [0])])
    n = len(text)
    # Ranks of the first 7, 14, 28 ... symbols, up to the depth.
    padded, key = np.append(text, np.zeros(7, np.int64)), np.zeros(n, np.int64)
    for k in range(7):
        key = (key << 9) | padded[k : k + n]
    levels, size = [], 7
    while True:
        order = np.argsort(key)
        fresh = np.append(False, key[order[1:]] != key[order[:-1]])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh)
        levels.append((size, rank.astype(np.int32)))
        if rank[order[-1]] == n - 1 or size >= min(n, depth):
            break
        following = np.full(n, -1, np.int64)
        following[: n - size] = rank[size:]
        key, size = rank * (n + 1) + following + 1, 2 * size
    suffixes = order
    before = np.where(suffixes > 0, text[suffixes - 1], -1)  # the transform; its runs:
    edge = np.append(True, before[1:] != before[:-1])
    heads, tails = np.flatnonzero(edge), np.flatnonzero(np.append(edge[1:], True))

    def shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        a, b, total = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        todo = levels[::-1]
        while todo:
            step, ranks = todo[0]
            same = np.flatnonzero((a + step <= n) & (b + step <= n))
            same = same[ranks[a[same]] == ranks[b[same]]]
            for x in (a, b, total):
                x[same] += step
            if step < depth or not len(same):  # the longest step is taken as often as it fits
                todo = todo[1:]
        for _ in range(6):
            inside = np.flatnonzero((a < n) & (b < n))
            same = inside[text[a[inside]] == text[b[inside]]]
            if len(same) == 0:
                break
            going = np.zeros(len(a), bool)
            going[same] = True
            a[same] += 1
            b[same] += 1
            total[same] += 1
            a[~going] = n  # ended
        return total

    # Suffixes that the sorting left together share what it looked at.
    alike = np.append(~fresh[1:], False) | np.append(False, ~fresh[1:])
    ends = np.zeros(n, np.int64)
    ends[suffixes[alike]] = suffixes[alike] + size
    for rows, others in ((heads[heads > 0], heads[heads > 0] - 1), (tails[tails < n - 1], tails[tails < n - 1] + 1)):
        ends[suffixes[rows]] = np.maximum(ends[suffixes[rows]], suffixes[rows] + shared(suffixes[rows], suffixes[others]))
    ends = np.maximum.accumulate(ends)  # between samples a match loses its first byte, no more
    reach = np.minimum(ends, np.repeat(np.cumsum([len(s) + 1 for s in strings]) - 1, [len(s) + 1 for s in strings])) - np.arange(n)
    reach = np.maximum(reach, 0)
    cuts = np.cumsum([0] + [len(s) + 1 for s in strings])
    return [reach[a : b - 1] for a, b in zip(cuts, cuts[1:], strict=False)]


def spans(marked: np.ndarray) -> list[tuple[int, int]]:
    """First and last of each run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], marked.view(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist(), strict=True))


def _indexed(length: int, schema: StructType):
    """From ``(chosen, a, b, first, sole, content)`` sorted by chosen to ``(a, b, firsts, lasts)``: repeated starts of sole contents.

    No group is larger than ``BATCH``, so an index isn't either, but for the half that stood before the group came.
    """

    def mark(groups: list[tuple[int, list[tuple]]], kinds: list[pa.DataType]) -> pa.RecordBatch:
        rows, out = [row for _, group in groups for row in group], []
        for (a, b, first, sole, x), found in zip(rows, matching_statistics([row[-1] for row in rows], length) if rows else [], strict=True):
            if sole and (marked := found[: len(x) - length + 1] >= length).any():
                out.append((a, b, *([first + y for y in side] for side in zip(*spans(marked), strict=True))))
        columns = list(zip(*out, strict=True)) if out else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, kinds = [], 0, None
        for batch in batches:
            kinds = [batch.column(1).type, batch.column(2).type, pa.list_(pa.int64()), pa.list_(pa.int64())]
            for h, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not held or held[-1][0] != h:
                    if size > BATCH // 2:  # groups share no strings, so several share an index
                        yield mark(held, kinds)
                        held, size = [], 0
                    held.append((h, []))
                held[-1][1].append(row)
                size += len(row[-1])
        if held:
            yield mark(held, kinds)

    return run


def _stretched(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """``(a, b, base, sole, first, last, chosen, again, digest)`` of the stretches of ``texts(a, b, base, sole, text)``, ``ROWS`` at a time.

    Where grams are whole strings, so are the contents: a stretch is then one string over and over.
    """
    schema = StructType([*(texts.schema[c] for c in PLACE), *StructType.fromDDL("first bigint, last bigint, chosen bigint, again boolean, digest binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches):
            held, size = [], 0
            for i, (base, text) in enumerate(zip(part.column(2).to_pylist(), part.column(4).to_pylist(), strict=True)):
                first, last, *others = stretches(text, length, gram)
                for at in range(0, len(first), ROWS):
                    owner, x, y, *cut = [c[at : at + ROWS] for c in (np.full(len(first), i), first, last, *others)]
                    ends = x if gram == length else y
                    held.append(([owner, x + base, y + base, *cut], [xxhash.xxh3_128_digest(text[p : q + length]) for p, q in zip(x.tolist(), ends.tolist(), strict=True)]))
                    size += len(ends)
                    if size >= ROWS:
                        yield rows(part, held)
                        held, size = [], 0
            if held:
                yield rows(part, held)

    def rows(part: pa.RecordBatch, held: list) -> pa.RecordBatch:
        place, *columns = (np.concatenate(c) for c in zip(*(cut for cut, _ in held), strict=True))
        owner, digests = pa.array(place), [d for _, found in held for d in found]
        return pa.RecordBatch.from_arrays([*(part.column(i).take(owner) for i in range(4)), *map(pa.array, columns), pa.array(digests, pa.binary())], names=schema.names)

    return texts.select(*PLACE, F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


def _copies(table: DataFrame, contents: DataFrame, length: int) -> DataFrame:
    """``(a, b, from, to)``: where the stretches of a sole text stand that have copies, as few ranges as there are gaps.

    The stretches of a text follow each other without a gap.  Those that stand at one place only are known with it from
    the count, so the copies are what they leave.  Nothing is joined, so the short stretches of the later rounds, most
    of which have copies, are neither rows nor a hot key.
    """
    texts = table.where("sole").groupBy("a", "b", "base").agg(F.max("last").alias("end"))
    alone = contents.where("n = 1 and at.sole").select("at.a", "at.b", "at.base", F.struct("at.first", "at.last").alias("alone"))
    both = texts.unionByName(alone, allowMissingColumns=True).groupBy("a", "b", "base").agg(F.max("end").alias("end"), F.sort_array(F.collect_list("alone")).alias("alone"))
    before = F.concat(F.array(F.col("base") - 1), F.col("alone.last"))
    after = F.concat(F.col("alone.first"), F.array(F.col("end") + 1))
    gaps = F.zip_with(before, after, lambda x, y: F.struct((x + 1).alias("from"), (y - 1 + length).alias("to")))
    gaps = F.filter(gaps, lambda gap: gap["to"] - gap["from"] >= length)
    return both.select("a", "b", F.explode(gaps).alias("gap")).select("a", "b", "gap.*")


def dedup_spans(docs: DataFrame, length: int, batch: int = BATCH) -> DataFrame:
    """``(a, b, from, to)``: removed bytes of each row of ``docs(a, b, text)``, parts may overlap; ``(a, b)`` is its key.

    Groups of more than ``batch`` bytes go to the next of the ``gram_lengths``.
    """
    return _spans(docs.select("a", "b", F.lit(0).cast("bigint").alias("base"), F.lit(True).alias("sole"), "text"), length, batch, 0)


def _spans(texts: DataFrame, length: int, batch: int, step: int) -> DataFrame:
    """``dedup_spans`` of ``texts(a, b, base, sole, text)``, which start at byte ``base`` of the row ``(a, b)``.

    Places are those in the rows in every round.  Texts that are not sole have copies, so they are gone as a whole
    already; they are there for others to be found in.
    """
    gram = gram_lengths(length)[step]
    table = stored(_stretched(texts, length, gram), "stretches")
    # Contents of each hash, each with its number and one place where it stands.
    number = F.sum(F.col("last") - F.col("first") + 1) if gram == length else F.count("*")
    contents = table.groupBy("chosen", "digest").agg(number.alias("n"), F.bool_or("again").alias("again"), F.min(F.struct("a", "b", "base", "first", "last", "sole")).alias("at"))
    contents = stored(contents, "contents")
    if step:
        copies = _copies(table, contents, length)
    else:  # few of the long first stretches have copies
        copies = table.join(contents.where("n > 1").select("chosen", "digest"), ["chosen", "digest"]).select("a", "b", F.col("first").alias("from"), (F.col("last") + length).alias("to"))
    if gram == length:
        return copies
    bytes_of = F.sum(F.col("at.last") - F.col("at.first") + length)
    mixed = contents.groupBy("chosen").agg(F.count("*").alias("kinds"), F.bool_or("again").alias("again"), (bytes_of > batch).alias("large"))
    mixed = mixed.where("kinds > 1 or again").select("chosen", "large")
    # Stretches with copies go as a whole, so what repeats within one is only looked up for those that stand at one place.
    sole = (F.col("n") == 1) & F.col("at.sole")
    wanted = stored(contents.join(mixed, "chosen").select("chosen", "digest", "at.a", "at.b", "at.base", "at.first", "at.last", sole.alias("sole"), "large"), "wanted")

    places = wanted.groupBy("a", "b", "base").agg(F.collect_list(F.struct("chosen", "digest", "first", "last", "sole", "large")).alias("places"))
    places = places.select(F.col("a").alias("_a"), F.col("b").alias("_b"), F.col("base").alias("_base"), "places")
    joined = texts.drop("sole").join(places, F.col("a").eqNullSafe(F.col("_a")) & (F.col("b") == F.col("_b")) & (F.col("base") == F.col("_base")))
    # Rows that repeat key and text give the same content; one of them is enough.
    content = f"substring(cast(text as binary), cast(p.first - base + 1 as int), cast(p.last - p.first + {length} as int))"
    part = F.expr(f"transform(places, p -> struct(p.chosen as chosen, p.digest as digest, p.first as first, p.sole as sole, p.large as large, {content} as content))")
    strings = joined.select("a", "b", F.explode(part).alias("p")).select("p.chosen", "p.digest", "a", "b", "p.first", "p.sole", "p.content", "p.large")
    strings = strings.dropDuplicates(["chosen", "digest"]).drop("digest")
    further = not wanted.where("large").isEmpty()
    if further:  # the texts are shuffled once for both
        strings = stored(strings, "strings")

    found = strings.where("not large").drop("large").repartition("chosen").sortWithinPartitions("chosen")
    schema = StructType([*(texts.schema[c] for c in ("a", "b")), *StructType.fromDDL("firsts array<bigint>, lasts array<bigint>").fields])
    found = stored(found.mapInArrow(_indexed(length, schema), schema), "repeated").select("a", "b", F.explode(F.arrays_zip("firsts", "lasts")).alias("y"))
    found = copies.union(found.select("a", "b", F.col("y.firsts").alias("from"), (F.col("y.lasts") + length).alias("to")))
    if further:
        rest = strings.where("large").select("a", "b", F.col("first").alias("base"), "sole", F.col("content").alias("text"))
        found = found.union(_spans(rest, length, batch, step + 1))
    return found


def remove_repeats(docs: DataFrame, text: str = "text", id_col: str = "doc_id", length: int = 400, batch: int = BATCH) -> DataFrame:
    """For each row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and kept (the remaining bytes).

    A byte is removed if a string of ``length`` bytes that covers it starts anywhere else too; texts are judged as
    they came.  NULL texts are empty, texts shorter than ``length`` stay whole.  Rows that repeat are copies of each
    other; NULL ids are kept, an empty table gives an empty one, further columns are not read.  An index holds ``batch``
    bytes; the result is the same for any.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    own = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    own = own.withColumn("text_hash", F.xxhash64("text"))
    keyed = own.select(F.col("doc_id").alias("a"), F.col("text_hash").alias("b"), "text")
    removed = dedup_spans(keyed, length, batch).groupBy("a", "b").agg(F.collect_list(F.struct("from", "to")).alias("spans"))
    removed = removed.select(F.col("a").alias("_id"), F.col("b").alias("_hash"), "spans")
    both = own.join(removed, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left").select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part, rows = batch.slice(start, 256), []
                for data, cuts in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    kept, at, gone, runs = [], 0, 0, 0
                    for a, b in sorted((x["from"], x["to"]) for x in cuts or []):
                        if a > at or not runs:
                            kept.append(data[at:a])
                            runs += 1
                            gone, at = gone + b - a, b
                        elif b > at:
                            gone, at = gone + b - at, b
                    kept = b"".join([*kept, data[at:]])
                    rows.append((len(data), gone, runs, hashlib.sha256(kept).hexdigest(), kept))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    kind = own.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    return both.select("doc_id", F.col("text").cast("binary").alias("text"), "spans").mapInArrow(run, out)
