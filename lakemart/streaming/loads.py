"""Incremental raw load and incremental latest-per-key."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakemart.functions import dates
from lakemart.operators.dedup import latest_per_key
from lakemart.sources import arrays, readers, schemas
from lakemart.sources.lake import FAILED, STARTED, SUCCESS, Lake, utc_now
from lakemart.sources.latest import LatestTable
from lakemart.workspace import delete, exists, hadoop_path, scratch, write_counted

BUCKET = "key_bucket"


def stream_raw(lake: Lake, table: str, source: str, checkpoint: str, archive_to: str | None = None,
               files_per_batch: int = 1000, array_files: bool = False) -> StreamingQuery:
    """Load the files that arrived below ``source`` since the last call, then stop.

    The checkpoint knows which files are loaded.  A micro-batch is a run whose id follows from the stream
    and the batch number, so a batch repeated after a failure replaces its own rows.  ``archive_to``
    moves finished files away (I10).  ``array_files`` takes JSON of any layout, also arrays over many lines, and splits
    large files within a batch.
    """
    by_pieces = array_files and table not in schemas.DELIMITED
    options = {"maxFilesPerTrigger": str(files_per_batch)}
    if archive_to:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive_to}
    arrived = readers.stream_files(lake.spark, source, table, by_pieces, **options)
    if not by_pieces:
        arrived = readers.with_lineage(arrived, "")

    def append(batch: DataFrame, batch_id: int) -> None:
        stream_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        run_id = str(uuid.uuid5(uuid.UUID(stream_id), str(batch_id)))
        started = utc_now()
        lake.log_run(table, run_id, STARTED, started, source=source)
        try:
            with scratch(batch.sparkSession):
                read = readers.with_lineage(arrays.documents_of(batch), "").drop("_metadata") if by_pieces else readers.blank_to_null(batch)
                rows = lake.append_raw(table, read.withColumn("_run_id", F.lit(run_id)), run_id)
        except Exception as error:
            lake.log_run(table, run_id, FAILED, started, source=source, error=str(error))
            raise
        lake.log_run(table, run_id, SUCCESS, started, rows, source)

    return arrived.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_table(lake: Lake, name: str, key: str) -> LatestTable:
    """A staged table that is kept at the latest row per key; readers see it as ``name`` in the staging layer."""
    return LatestTable(lake.spark, lake.log_folder(lake.stg, name), key, switch=lambda sql: lake.switch(lake.stg, name, sql))


def stream_latest(arrived: DataFrame, clean: Callable[[DataFrame], DataFrame], table: LatestTable, checkpoint: str,
                  now: dt.datetime | None = None, derive: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Keep ``table`` at the latest row per key while raw rows arrive.

    A micro-batch writes its own cleaned rows and switches the table to them; ``table.compact`` runs apart from the
    stream, in any process.  ``derive`` adds what follows from the other columns of a cleaned row, once the latest are known.
    """
    def derived(latest: DataFrame) -> DataFrame:
        return (derive(latest) if derive else latest).withColumn("_stg_updated_at", dates.now(now))

    def add(batch: DataFrame, batch_id: int) -> None:
        stream_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        table.add(clean(batch), f"{stream_id}-{batch_id:012d}", derived)

    return arrived.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merge_latest(spark: SparkSession, changes: DataFrame, key: str, table_path: str, merged_path: str, buckets: int = 64) -> int:
    """Merge changed rows into a table that is partitioned by a hash of its key; returns the rows written.

    Only the buckets with changes are read and replaced; choose ``buckets`` so that one is a few GB.  The
    new content is written aside first and then copied in, so a merge that is repeated after a failure
    starts from that copy, not from a table that may be half replaced.
    """
    changes = changes.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    _keep_buckets(spark, table_path, buckets)
    if not exists(spark, f"{merged_path}/_SUCCESS"):
        changed = [r[0] for r in changes.select(BUCKET).distinct().collect()]  # at most `buckets` numbers
        current = spark.read.schema(changes.schema).parquet(table_path).filter(F.col(BUCKET).isin(changed))
        latest = latest_per_key(changes.unionByName(current), [key], "_loaded_at").hint("rebalance", BUCKET)
        write_counted(latest, merged_path, "overwrite", [BUCKET])
    stored = spark.read.schema(changes.schema).parquet(merged_path)
    rows = write_counted(stored, table_path, "overwrite", [BUCKET], partitionOverwriteMode="dynamic")
    delete(spark, merged_path)
    return rows


def _keep_buckets(spark: SparkSession, table_path: str, buckets: int) -> None:
    """The number of buckets stands with the table: with another one, a key would be looked for in the wrong place."""
    fs, folder = hadoop_path(spark, table_path)
    name = f"_buckets_{buckets}"
    marks = [f.getPath().getName() for f in fs.listStatus(folder) if f.getPath().getName().startswith("_buckets_")] if fs.exists(folder) else []
    if marks and marks != [name]:
        raise ValueError(f"{table_path} was made with {marks[0].removeprefix('_buckets_')} buckets, not {buckets}")
    if not marks:
        fs.mkdirs(folder)
        fs.create(hadoop_path(spark, f"{table_path}/{name}")[1], True).close()


def read_latest(spark: SparkSession, table_path: str) -> DataFrame:
    """The merged table without its bucket column."""
    return spark.read.parquet(table_path).drop(BUCKET)
