"""Token ids of documents in files of compressed bit planes.

A file holds documents in ascending order.  Their ids run through chunks of ``CHUNK`` ids, documents may cross
them.  A chunk is transposed: plane b has bit b of every id (or byte b, ``plane_bits=8``), as many planes as its
largest id needs, each compressed by itself with zstandard.  Behind the chunks stand the document index (ids, a mark
for NULL ids, lengths) and the chunk index (offset, ids and compressed size of each plane), then a tail of fixed
size that says where they are.  So a reader can fetch the ids of any document from the chunks that hold them.

Every record is followed by a line feed, as the files are written by Spark's text sink: it commits the files of a
task together, on any storage, whatever executors are lost.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakemart.llm.pretokens import BYTE_LEVEL, REMEMBERED, byte_symbols, usual
from lakemart.llm.texts import sliced, stored
from lakemart.workspace import fresh_path

CHUNK = 1 << 16
MAGIC = b"BPLANES1"
TAIL = struct.Struct("<QQQQ8s")  # offset and size of the document index, offset and size of the chunk index, magic
END_ID = 0


class Encoder:
    """Whole texts to ids as the tokenizers library gives them, without special tokens added.

    Special tokens inside a text are cut out first, as the library does; what lies between is split into
    pre-tokens, and each distinct one goes to the library's model once.
    """

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = [(t.content, i) for i, t in self.tokenizer.get_added_tokens_decoder().items()]
        self.special = {content: np.array([i], "<u4").tobytes() for content, i in special}
        self.cut = re.compile("(" + "|".join(re.escape(c) for c in sorted(self.special, key=len, reverse=True)) + ")") if special else None
        self.known = Known(self.tokenizer.model)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not usual(text):
            return self._whole(text)
        if self.cut and any(c in text for c in self.special):
            return b"".join(self.special.get(x) or self._plain(x) for x in self.cut.split(text))
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        return b"".join(map(self.known.__getitem__, BYTE_LEVEL.findall(text)))


class Known(dict):
    """The ids of each pre-token met, by the library's model."""

    def __init__(self, model):
        self.tokenize = model.tokenize
        self.space = byte_symbols()[0x20]
        self.symbols = str.maketrans({chr(b): c for b, c in enumerate(byte_symbols())})

    def __missing__(self, word: str) -> bytes:
        if word.isascii() and not word.isspace():  # of these, only the space is written otherwise
            tokens = self.tokenize(word.replace(" ", self.space))
        else:
            tokens = self.tokenize(word.encode().decode("latin-1").translate(self.symbols))
        found = self[word] = array("I", [t.id for t in tokens]).tobytes()
        return found


@lru_cache(maxsize=2)
def encoder(file: str) -> Encoder:
    """One for each Python worker."""
    return Encoder(file)


def pack(ids: np.ndarray, plane_bits: int = 1) -> list[bytes]:
    """The compressed planes of one chunk, lowest first."""
    compress = zstandard.ZstdCompressor(level=3).compress
    n = int(ids.max(initial=0)).bit_length()
    if plane_bits == 8:
        return [compress((ids >> np.uint32(b)).astype(np.uint8).tobytes()) for b in range(0, n, 8)]
    return [compress(np.packbits((ids >> np.uint32(b)).astype(np.uint8) & 1).tobytes()) for b in range(n)]


def unpack(planes: list[bytes], n: int, plane_bits: int = 1) -> np.ndarray:
    ids = np.zeros(n, np.uint32)
    for b, plane in enumerate(planes):
        raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(plane), np.uint8)
        ids |= (raw if plane_bits == 8 else np.unpackbits(raw, count=n)).astype(np.uint32) << np.uint32(b * plane_bits)
    return ids


class FileWriter:
    """The records of one file, in order; holds a chunk of ids and the indexes."""

    def __init__(self, plane_bits: int):
        self.plane_bits, self.at = plane_bits, 0
        self.held, self.n_held = [], 0
        self.docs: list[tuple[int, int, int]] = []
        self.chunks: list[bytes] = []

    def record(self, data: bytes) -> bytes:
        self.at += len(data) + 1
        return data

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[bytes]:
        self.docs.append((doc_id or 0, doc_id is None, len(ids)))
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= CHUNK:
            ids = np.concatenate(self.held)
            whole = len(ids) // CHUNK * CHUNK
            for start in range(0, whole, CHUNK):
                yield self.chunk(ids[start : start + CHUNK])
            self.held, self.n_held = [ids[whole:]], len(ids) - whole

    def chunk(self, ids: np.ndarray) -> bytes:
        planes = pack(ids, self.plane_bits)
        self.chunks.append(struct.pack(f"<QII{len(planes)}I", self.at, len(ids), len(planes), *map(len, planes)))
        return self.record(b"".join(planes))

    def end(self) -> Iterator[bytes]:
        if not self.docs:
            return
        if self.n_held:
            yield self.chunk(np.concatenate(self.held))
        columns = list(zip(*self.docs, strict=True))
        index = zstandard.compress(b"".join(np.array(c, t).tobytes() for c, t in zip(columns, ("<i8", "u1", "<u8"), strict=True)))
        at = self.at
        yield self.record(index)
        chunks = zstandard.compress(struct.pack("<I", self.plane_bits) + b"".join(self.chunks))
        yield chunks + b"\n" + TAIL.pack(at, len(index), self.at, len(chunks), MAGIC)


def read_file(content: bytes) -> Iterator[tuple[int | None, np.ndarray]]:
    """``(doc_id, ids)`` of each document of one file, a chunk in memory at a time."""
    if not content:
        return
    at, size, chunks_at, chunks_size, magic = TAIL.unpack(content[-TAIL.size - 1 : -1])
    if magic != MAGIC:
        raise ValueError("not a file of bit planes")
    index = zstandard.decompress(content[at : at + size])
    n = len(index) // 17
    doc_ids, missing, lengths = (np.frombuffer(index, t, n, o) for t, o in (("<i8", 0), ("u1", 8 * n), ("<u8", 9 * n)))
    chunks = zstandard.decompress(content[chunks_at : chunks_at + chunks_size])
    plane_bits, where = struct.unpack_from("<I", chunks)[0], 4
    rest = np.zeros(0, np.uint32)
    for doc_id, none, length in zip(doc_ids.tolist(), missing.tolist(), lengths.tolist(), strict=True):
        parts, need = [], length
        while need:
            if not len(rest):
                offset, count, planes = struct.unpack_from("<QII", chunks, where)
                sizes = struct.unpack_from(f"<{planes}I", chunks, where + 16)
                where += 16 + 4 * planes
                cuts = np.cumsum([offset, *sizes])
                rest = unpack([content[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], count, plane_bits)
            parts.append(rest[:need])
            rest, need = rest[need:], need - len(parts[-1])
        yield None if none else doc_id, np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def write_ids(docs: DataFrame, path: str, tokenizer: str, text: str = "text", id_col: str = "doc_id", end_id: int = END_ID, plane_bits: int = 1) -> None:
    """Encode every whole text and write its ids, ``end_id`` behind each document, in ascending doc_id order over the files.

    NULL texts are empty, NULL ids come first; rows that repeat a doc_id stay, ordered by their text.  Names of the
    files follow the order.  An empty table gives a folder without ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, file, end = encoder(tokenizer), FileWriter(plane_bits), np.array([end_id], "<u4").tobytes()
        for part in sliced(batches):
            for doc_id, words in zip(*(c.to_pylist() for c in part.columns), strict=True):
                ids = np.frombuffer(own.encode(words) + end, "<u4")
                yield from map(_row, file.add(doc_id, ids))
        yield from map(_row, file.end())

    def _row(data: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["record"])

    ordered = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, "record binary").select(F.col("record").cast("string")).write.text(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """From the files: file, doc_id, at (ids before it in the file), n_tokens and ids (binary) of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                name, at, rows = batch.column(0)[i].as_py(), 0, []
                for doc_id, ids in read_file(batch.column(1)[i].as_py()):
                    rows.append((name, doc_id, at, len(ids), ids.astype("<u4").tobytes()))
                    at += len(ids)
                    if len(rows) == 256:
                        yield _rows(rows)
                        rows = []
                yield _rows(rows)

    schema = pa.schema([("file", pa.string()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * 5, schema, strict=True)], schema=schema)

    name = F.regexp_extract("path", "part-[0-9]+", 0)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where("length > 0")
    return files.select(name.alias("file"), "content").mapInArrow(run, "file string, doc_id bigint, at bigint, n_tokens bigint, ids binary")


def store_and_check(docs: DataFrame, tokenizer: str, text: str = "text", id_col: str = "doc_id", plane_bits: int = 1) -> DataFrame:
    """Write the ids of all documents, read the files back: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32 of each document.  The files stay below the shared folder."""
    spark = docs.sparkSession
    path = fresh_path(spark, "bitplanes")
    write_ids(docs, path, tokenizer, text, id_col, END_ID, plane_bits)
    found = stored(read_ids(spark, path).select("file", "doc_id", "at", "n_tokens", F.crc32("ids").alias("ids_crc32")), "read_back")
    sizes = found.groupBy("file").agg(F.sum("n_tokens").alias("n"))  # a row for each file
    before = F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("file", before.alias("before"))
    return found.join(starts, "file").select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
