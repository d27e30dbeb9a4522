"""Helpers shared by the operators: texts by the slice inside tasks, stored intermediate tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemart.workspace import Stored

#: Rows that a task turns into Python objects at a time; their texts alone are held in memory.
SLICE = 256


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage is cut and a lost executor costs its own tasks only."""
    return Stored(df, label).df


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            yield batch.slice(start, SLICE)


def map_texts(
    docs: DataFrame, text: str, keep: list[str], work: Callable[[list[bytes]], dict[str, list]], made: str
) -> DataFrame:
    """Columns ``keep`` of ``docs`` beside what ``work`` makes of the whole texts as UTF-8 bytes (NULL: empty).

    ``made`` is the schema of the columns of ``work``, in the order of its dictionary; the kept ones pass unchanged.
    """
    schema = StructType([docs.schema[c] for c in keep] + StructType.fromDDL(made).fields)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches):
            found = work(part.column(len(keep)).to_pylist()).values()
            yield pa.RecordBatch.from_arrays(
                [*(part.column(i) for i in range(len(keep))), *(v if isinstance(v, pa.Array) else pa.array(v) for v in found)], names=names
            )

    whole = F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b"")).alias("_text")
    return docs.select(*[F.col(f"`{c}`") for c in keep], whole).mapInArrow(run, schema)


def fresh_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` doesn't have yet, whatever the case of letters."""
    taken = {c.lower() for c in df.columns}
    while wanted in taken:
        wanted += "_"
    return wanted


def bounded_sample(df: DataFrame, key: str, rows: int, total: int) -> DataFrame:
    """About ``rows`` rows of the ``total`` of ``df``, never more, the same ones each time; for fitting models only.

    A threshold on the hash of ``key`` comes first, so that no task sorts what grows with the table.
    """
    share = min(1.0, 1.3 * rows / max(total, 1))
    place = F.xxhash64(F.col(f"`{key}`"), F.lit("sample"))
    return df.where(F.pmod(place, F.lit(1 << 30)) < int(share * (1 << 30))).orderBy(place).limit(rows)
