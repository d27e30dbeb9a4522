"""SimHash near-duplicates, found by pigeonring filtering.

A fingerprint of 64 bits is cut into ``threshold + 1`` segments, seen as a ring.  If two fingerprints differ in
at most ``threshold`` bits, then from some segment on every chain of l consecutive segments has at most
``l * threshold / segments`` differing bits in sum: none in the first segment, at most one in the first two, and
so on round the ring.  The first two demands are hash keys (first segment, second segment with at most one bit
turned), the others prune the members of a bucket before the full Hamming check.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.components import components
from lakemart.llm.texts import fresh_name, map_texts, stored

BITS = 64
SEED = 42
#: Greatest threshold: beyond it segments are so short that a bucket would be a large part of the table.
MOST = 12
#: Shingles whose bits are counted at a time.
BLOCK = 1 << 16


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """Signed 64-bit SimHash of a text: majority of the bits of its shingles' XXH64, repeats included."""
    words = text.lower().split()  # of bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words), initial=0))
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    stops = ends[shingle:] if len(words) >= shingle else ends[-1:]
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, BLOCK):
        hashes = np.array([digest(joined[a : b - 1], SEED) for a, b in zip(ends[at : at + BLOCK], stops[at : at + BLOCK], strict=False)], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | None = None, shingle: int = 4, name: str = "fp") -> DataFrame:
    """Columns ``keep`` (all) of each row and its fingerprint; a text without words (NULL, empty) has fingerprint zero."""
    kept = docs.columns if keep is None else keep
    return map_texts(docs, text, kept, lambda texts: {name: pa.array([fingerprint(t, shingle) for t in texts], pa.int64())}, f"`{name}` bigint")


def _segments(threshold: int) -> list[tuple[int, int]]:
    """First bit and width of each segment."""
    m = threshold + 1
    cuts = [BITS * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _mask(a: int, width: int) -> np.uint64:
    return np.uint64(((1 << width) - 1) << a)


def _keys(threshold: int):
    """From batches of ``fp`` to ``(ring, key, fp)``: for each start in the ring, the first segment as it is and the second
    as it is or with one of its zero bits set.  Of two fingerprints that differ there in one bit, one has the zero."""
    segments = _segments(threshold)
    m = len(segments)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                fps = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                rings, keys, owners = [], [], []
                for i in range(m):
                    (a, wa), (b, wb) = segments[i], segments[(i + 1) % m]
                    base = ((fps & _mask(a, wa)) >> np.uint64(a)) << np.uint64(wb) | (fps & _mask(b, wb)) >> np.uint64(b)
                    keys.append(base)
                    owners.append(fps)
                    for bit in range(wb):
                        zero = (base >> np.uint64(bit)) & np.uint64(1) == 0
                        keys.append(base[zero] | np.uint64(1 << bit))
                        owners.append(fps[zero])
                    rings.append(np.full(sum(map(len, keys)) - sum(map(len, rings)), i, np.int8))
                columns = [pa.array(np.concatenate(x).view(np.int64)) for x in (keys, owners)]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(rings)), *columns], names=["ring", "key", "fp"])

    return run


def bucket_links(fps: np.ndarray, start: int, threshold: int) -> list[tuple[int, int]]:
    """Links that connect whatever is connected inside a bucket whose chains begin at segment ``start``.

    Found neighbours leave the candidates, so a dense group of n gives n - 1 links, not all pairs.
    """
    segments = _segments(threshold)
    m = len(segments)
    chain, masks = np.uint64(0), []
    for step in range(m):
        chain |= _mask(*segments[(start + step) % m])
        masks.append((chain, (step + 1) * threshold // m))
    rest, links = np.unique(fps), []
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            differ, found = rest ^ at, np.arange(len(rest))
            for chain, budget in masks[1:]:  # the last one is the full Hamming check
                found = found[np.bitwise_count(differ[found] & chain) <= budget]
            if len(found):
                queue += list(rest[found])
                links += [(int(at.view(np.int64)), int(x)) for x in rest[found].view(np.int64)]
                rest = np.delete(rest, found)
    return links


def _linked(threshold: int):
    """From ``(ring, key, fp)`` sorted by ring and key to links ``(u, v)``.  A bucket may span batches."""

    def found(rings: np.ndarray, keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch | None:
        cuts = np.flatnonzero(np.diff(keys) | np.diff(rings)) + 1
        starts, stops = np.append(0, cuts), np.append(cuts, len(keys))
        links = []
        for a, b in zip(starts[stops - starts > 1], stops[stops - starts > 1], strict=True):
            links += bucket_links(fps[a:b], int(rings[a]), threshold)
        if links:
            u, v = zip(*links, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            rings, keys, fps = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            rings, fps = rings.astype(np.int64), fps.view(np.uint64)
            other = np.flatnonzero((keys != keys[-1]) | (rings != rings[-1]))
            cut = int(other[-1]) + 1 if len(other) else 0  # the last bucket may go on
            if cut or (held and (held[0][1][0] != keys[0] or held[0][0][0] != rings[0])):
                held.append((rings[:cut], keys[:cut], fps[:cut]))
                if (made := found(*map(np.concatenate, zip(*held, strict=True)))) is not None:
                    yield made
                held = []
            held.append((rings[cut:], keys[cut:], fps[cut:]))
        if held and (made := found(*map(np.concatenate, zip(*held, strict=True)))) is not None:
            yield made

    return run


def near_links(fps: DataFrame, threshold: int = 4) -> DataFrame:
    """Links ``(u, v)`` among the distinct fingerprints ``fps(fp)``: enough to connect all that differ in at most ``threshold`` bits."""
    keyed = fps.mapInArrow(_keys(threshold), "ring tinyint, key bigint, fp bigint")
    return keyed.repartition("ring", "key").sortWithinPartitions("ring", "key").mapInArrow(_linked(threshold), "u bigint, v bigint")


def near_duplicates(docs: DataFrame, text: str = "text", id_col: str = "doc_id", shingle: int = 4, threshold: int = 4) -> DataFrame:
    """``(doc_id, fp, component_id, root)`` for each row of ``docs``; component_id is the least doc_id that links reach.

    Rows with equal fingerprints are one node, so copies are never paired; root, the least fingerprint of the group,
    tells groups apart.  Rows without words all have fingerprint zero and link like others.  Repeated rows stay
    repeated; a NULL doc_id gets its component, but never names one (NULL if the component has no other).  An empty
    table gives an empty table; further columns are not read.
    """
    if not 1 <= threshold <= MOST:
        raise ValueError(f"threshold must be from 1 to {MOST}")
    ids = docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text}`").alias("text"))
    marked = stored(fingerprints(ids, "text", [id_col], shingle), "fingerprints")
    nodes = stored(marked.groupBy("fp").agg(F.min(id_col).alias("least_id")), "nodes")
    reached = components(near_links(nodes.select("fp"), threshold))
    linked = stored(reached.join(nodes, reached["node"] == nodes["fp"]).select("fp", "root", "least_id"), "linked")
    least = linked.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = linked.join(least, "root").select("fp", "component_id", "root")
    classes = nodes.join(named, "fp", "left").select(
        "fp", F.coalesce("component_id", "least_id").alias("component_id"), F.coalesce("root", "fp").alias("root")
    )
    return marked.join(classes, "fp").select(id_col, "fp", "component_id", "root")


def first_of_each(docs: DataFrame, text: str = "text", id_col: str = "doc_id", shingle: int = 4, threshold: int = 4) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates, the one whose doc_id names the group; all columns stay.

    If rows repeat that doc_id, the one with the least fingerprint stays.  A group without any doc_id keeps one row.
    """
    groups = near_duplicates(docs, text, id_col, shingle, threshold)
    least, of = fresh_name(docs, "_least"), fresh_name(docs, "_of")
    chosen = groups.where(F.col(id_col).eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.min("fp").alias(least), F.min(id_col).alias(of))
    name, place = fresh_name(docs, "_fingerprint"), fresh_name(docs, "_place")
    marked = fingerprints(docs, text, None, shingle, name)
    kept = marked.join(chosen.drop("root"), (F.col(name) == F.col(least)) & F.col(f"`{id_col}`").eqNullSafe(F.col(of)), "left_semi")
    # Of rows equal in both, the same one each time.
    again = Window.partitionBy(name, f"`{id_col}`").orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    return kept.withColumn(place, F.row_number().over(again)).where(F.col(place) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])
