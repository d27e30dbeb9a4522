"""Documents of JSON array files of any layout and size, read by byte ranges.

Spark's text reader cuts files at closing braces, so one file is as many tasks as it has blocks.  Whether a brace closes a
document depends on all text before it: on the quotes (is the brace in a string?) and on the depth.  A first pass adds up
both for each block, once for a block that starts outside a string and once for one that starts inside; running totals
over the blocks of a file, one row each, then give every block its start.  A second pass puts the documents together.
Only what crosses a block's borders is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakemart.sources import schemas
from lakemart.workspace import Stored

CLOSE = "}"
ESCAPED = re.compile(r"\\.", re.DOTALL)
TOTALS = "file string, block long, quotes long, outside long, inside long, opens_array boolean"
PIECES = "file string, block long, tail boolean, fragment boolean, text string"
#: A batch handed back to Spark holds about so many characters.
BATCH_CHARS = 8 << 20


def depth_changes(text: str) -> tuple[int, int, int]:
    """Quotes in a text that a closing brace follows, and its change of depth if it starts outside or inside a string."""
    # No document escapes a brace, so an escape never reaches over the cut.
    parts = (ESCAPED.sub("", text) if "\\" in text else text).split('"')
    change = [sum(p.count("{") + p.count("[") - p.count("]") for p in parts[side::2]) for side in (0, 1)]
    change[(len(parts) - 1) % 2] -= 1
    return len(parts) - 1, change[0], change[1]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each block of a file, in a task that reads its blocks one after the other."""
    names = ["file", "block", "quotes", "outside", "inside", "opens_array"]
    now: list | None = None
    for row in _rows(batches):
        if now is None or now[:2] != [row["file"], row["block"]]:
            if now is not None:
                yield pa.RecordBatch.from_pylist([dict(zip(names, now, strict=True))])
            now = [row["file"], row["block"], 0, 0, 0, row["value"].lstrip("\ufeff \t\r\n")[:1] == "["]
        quotes, outside, inside = depth_changes(row["value"])
        if now[2] % 2:
            outside, inside = inside, outside
        now[2], now[3], now[4] = now[2] + quotes, now[3] + outside, now[4] + inside
    if now is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(names, now, strict=True))])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole documents of each block, and what lies before the first and behind the last end of one in it."""
    out: list[dict] = []
    held, size, at, state = [], 0, None, None

    def rest() -> list[dict]:
        # Also an empty one: the next block's first piece belongs to it.  The last piece of a file has no brace behind it.
        if state is None:
            return []
        text = CLOSE.join(held) + (CLOSE if held and not state["last"] else "")
        return [{"file": at[0], "block": at[1], "tail": state["tail"], "fragment": True, "text": text}]

    for row in _rows(batches):
        if at != (row["file"], row["block"]):
            out += rest()
            at, held = (row["file"], row["block"]), []
            state = {"in_string": row["quotes_before"] % 2, "depth": row["depth_before"], "tail": row["first"], "last": row["last"]}
        quotes, *changes = depth_changes(row["value"])
        state["depth"] += changes[state["in_string"]]
        state["in_string"] = (state["in_string"] + quotes) % 2
        held.append(row["value"])
        if not state["in_string"] and state["depth"] == row["base"]:
            text = CLOSE.join(held) + CLOSE
            head = not state["tail"]
            out.append({"file": at[0], "block": at[1], "tail": False, "fragment": head, "text": text})
            held, size, state["tail"] = [], size + len(text), True
        if size > BATCH_CHARS:
            yield pa.RecordBatch.from_pylist(out, schema=_PIECE_SCHEMA)
            out, size = [], 0
    out += rest()
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=_PIECE_SCHEMA)


_PIECE_SCHEMA = pa.schema([("file", pa.string()), ("block", pa.int64()), ("tail", pa.bool_()), ("fragment", pa.bool_()), ("text", pa.string())])


def cut_files(reader, path: str | list[str]) -> DataFrame:
    """The text between closing braces of the files below ``path``, by a batch or stream reader."""
    cut = reader.option("lineSep", CLOSE).text(path)
    return cut.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def documents_of(cut: DataFrame) -> DataFrame:
    """One variant row per document of whole files that ``cut_files`` has cut, with ``_metadata.file_path``.

    A file holds an array, several of them in lines, or documents in lines, each over one line or many; the form is found for
    each file.  Elements that are no documents are rows too.  Empty files and arrays give no rows; a file that does not
    end where its array does, or is no JSON, fails.
    """
    # In the order of the file, also if Spark deals the rows anew for the join.
    cut = cut.withColumn("place", F.monotonically_increasing_id())
    totals = cut.select("file", "block", "value").mapInArrow(_totals, TOTALS)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    in_order = Window.partitionBy("file").orderBy("block")
    starts = totals.withColumn("quotes_before", F.coalesce(F.sum("quotes").over(before), F.lit(0)))
    change = F.when(F.col("quotes_before") % 2 == 0, F.col("outside")).otherwise(F.col("inside"))
    starts = starts.withColumn("change", change)
    # The brace counted behind a file's last piece is one too many, unless the file ends with one.
    file = Window.partitionBy("file")
    opens_array = F.first("opens_array").over(in_order)
    left = F.sum("change").over(file)
    starts = starts.select(
        "file", "block", "quotes_before",
        F.coalesce(F.sum("change").over(before), F.lit(0)).alias("depth_before"),
        opens_array.cast("int").alias("base"),
        (F.row_number().over(in_order) == 1).alias("first"),
        F.lead("block").over(in_order).isNull().alias("last"),
        ((F.sum("quotes").over(file) % 2 == 0) & ((left == -1) | (left == 0) & ~opens_array)).alias("whole"),
    )
    starts = Stored(starts, "array_blocks").df  # of known size: Spark broadcasts it only if it is small
    placed = cut.join(starts, ["file", "block"]).sortWithinPartitions("file", "block", "place")
    pieces = placed.select("file", "block", "value", "quotes_before", "depth_before", "base", "first", "last").mapInArrow(_pieces, PIECES)
    pieces = Stored(pieces, "array_pieces").df
    # Behind a tail come the heads of the next blocks, up to the one that ends the document and leaves a tail of its own.
    chains = Window.partitionBy("file").orderBy("block", "tail")
    joined = pieces.where("fragment").withColumn("chain", F.sum(F.col("tail").cast("int")).over(chains))
    parts = F.array_sort(F.collect_list(F.struct("block", "tail", "text")))
    stitched = joined.groupBy("file", "chain").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("text"))
    # The last chain of a file is what lies behind its last document.
    stitched = stitched.withColumn("end", F.col("chain") == F.max("chain").over(file)).drop("chain")
    found = starts.where("first").select("file", F.col("whole").alias("file_whole"))
    whole = pieces.where(~F.col("fragment")).select("file", "text", F.lit(False).alias("end"))
    text = F.regexp_replace("text", r"\A[\x{FEFF}\s]*+(?:\[?\s*\]\s*)*[\[,]?", "")
    both = whole.unionByName(stitched).join(found, "file")
    closed = F.regexp_replace(text, r"\]?\s*\z", "")
    checked = F.when(~F.col("file_whole"), F.raise_error(F.concat(F.lit("no whole JSON in "), "file")))
    inner = F.coalesce(checked.cast("string"), F.when(F.col("end"), closed).otherwise(text))
    elements = F.try_variant_get(F.parse_json(F.concat(F.lit("["), inner, F.lit("]"))), "$", "array<variant>")
    return both.select(F.explode(elements).alias(schemas.DOCUMENT_COLUMN), F.struct(F.col("file").alias("file_path")).alias("_metadata"))


def read_json_any(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Documents of JSON files of any layout; a file of any size is read by as many tasks as it has blocks."""
    return documents_of(cut_files(spark.read, path))
