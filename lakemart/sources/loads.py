"""Batch load of one file drop into a raw table."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lakemart.functions.casts import null_if
from lakemart.sources import moves, readers, schemas
from lakemart.sources.lake import FAILED, STARTED, SUCCESS, Lake, utc_now
from lakemart.workspace import scratch, shared_folder


def read_raw(lake: Lake, table: str, path: str | list[str], run_id: str, array_files: bool = False,
             indent: int | None = None, loaded_at: dt.datetime | None = None, multiline: bool = False) -> DataFrame:
    """The rows of a file drop as the raw table takes them.

    JSON may be lines, or arrays with a known ``indent``; an indent is found from the first file.  Arrays of any other
    form, and drops that mix forms, need ``array_files``, which looks at each file.  ``multiline`` allows line breaks in
    quoted CSV fields.
    """
    if table in schemas.DELIMITED:
        df = readers.read_delimited(lake.spark, path, table, multiline)
        return readers.blank_to_null(readers.with_lineage(df, run_id, loaded_at))
    if not array_files and (found_indent := readers.array_indent(lake.spark, path)):
        array_files, indent = True, indent or found_indent
    found = readers.read_json_arrays(lake.spark, path, indent) if array_files else readers.read_json_lines(lake.spark, path)
    df = readers.with_lineage(found, run_id, loaded_at)
    return df.select(*schemas.raw_schema(table).fieldNames())


def load_raw(lake: Lake, table: str, path: str, run_id: str | None = None, array_files: bool = False,
             indent: int | None = None, archive_to: str | None = None, spread: int | None = None, multiline: bool = False,
             delete_read: bool = False, quarantine: bool = False, lengths: dict[str, int] | None = None, casts: dict[str, str] | None = None) -> int:
    """Append a file drop to a raw table, log the run and return the number of rows.

    ``archive_to`` moves the files that were read there after success, with their path below the first folder
    without wildcards, and refuses to overwrite (I10); ``delete_read`` deletes them instead.  A load first ends the moves
    of earlier loads of the table that were interrupted, so their files are not read again.  ``spread`` deals the rows to that many output files, for a few large compressed files that Spark cannot split (I7).  With ``quarantine``, records
    that can't be read or have values longer than declared (``lengths``) or of another type (``casts``) don't fail the
    load: they go to the table of rejects, and the log has their number.
    """
    run_id = run_id or str(uuid.uuid4())
    moving = bool(archive_to or delete_read)
    if moving:
        moves.recover(lake, table)
    moves.forget(lake, run_id)
    started = utc_now()
    lake.log_run(table, run_id, STARTED, started, source=path)
    try:
        with scratch(lake.spark):
            rows, failed = _append(lake, table, path, run_id, array_files, indent, archive_to, spread, multiline, moving, quarantine, lengths, casts)
    except Exception as error:
        lake.log_run(table, run_id, FAILED, started, source=path, error=str(error))
        raise
    lake.log_run(table, run_id, SUCCESS, started, rows, path, failed=failed)
    if moving:
        moves.finish(lake, run_id)
    return rows


def _append(lake: Lake, table: str, path: str, run_id: str, array_files: bool, indent: int | None, archive_to: str | None, spread: int | None,
            multiline: bool, moving: bool, quarantine: bool, lengths: dict[str, int] | None, casts: dict[str, str] | None) -> tuple[int, int]:
    """Add the rows of a run and set aside its rejects; returns the numbers of both."""
    if quarantine:
        df = inspected(lake, table, path, run_id, multiline, lengths, casts)
        seen = Observation()
        good = df.observe(seen, F.count_if(F.col(schemas.REASON).isNotNull()).alias("failed")).where(F.col(schemas.REASON).isNull())
    else:
        df = good = read_raw(lake, table, path, run_id, array_files, indent, multiline=multiline)
    if moving:
        moves.plan(lake, table, run_id, read_files(lake, df, path), _root(path), archive_to)
    rows = lake.append_raw(table, good.repartition(spread) if spread else good, run_id)
    if moving:
        moves.commit(lake, run_id)
    failed = seen.get.get("failed", 0) if quarantine else 0
    if failed:  # the files are read again only if something is wrong
        lake.append_rejects(rejects(df, table), run_id)
    return rows, failed


def read_files(lake: Lake, df: DataFrame, path: str | list[str]) -> list[str]:
    """The files of a drop, as the plan of its rows lists them, or a plain listing if the rows come from stored pieces."""
    pieces = shared_folder(lake.spark)
    files = df.inputFiles()
    return lake.spark.read.text(path).inputFiles() if any(pieces in f for f in files) else files


def inspected(lake: Lake, table: str, path: str | list[str], run_id: str, multiline: bool = False, lengths: dict[str, int] | None = None,
              casts: dict[str, str] | None = None) -> DataFrame:
    """Every record of a file drop with lineage and the reason why it can't be taken (NULL if it can)."""
    loaded_at = utc_now()  # the same in both passes
    df = readers.with_lineage(readers.read_any(lake.spark, path, table, multiline), run_id, loaded_at).drop("_metadata")
    if table in schemas.DELIMITED:
        values = {c: null_if(F.col(c), *readers.NULL_TOKENS) for c in schemas.DELIMITED[table]}
        df = df.withColumns(values)
    return df.withColumn(schemas.REASON, schemas.reason(table, lengths, casts))


def rejects(df: DataFrame, table: str) -> DataFrame:
    """The records of ``inspected`` that can't be taken, as text."""
    values = F.to_csv(F.struct(*schemas.DELIMITED[table])) if table in schemas.DELIMITED else F.to_json(schemas.DOCUMENT_COLUMN)
    bad = df.where(F.col(schemas.REASON).isNotNull())
    return bad.select(
        F.lit(table).alias("table_name"), F.coalesce(schemas.MALFORMED, values).alias("record"), F.col(schemas.REASON).alias("reason"),
        *schemas.LINEAGE.fieldNames(),
    )


def _root(path: str) -> str:
    """The folder of a path up to its first part with a wildcard; a plain file's own folder."""
    parts = path.rstrip("/").split("/")
    plain = next((i for i, p in enumerate(parts) if any(c in p for c in "*?[{")), len(parts))
    return "/".join(parts[: plain if plain < len(parts) or "." not in parts[-1] else plain - 1])
