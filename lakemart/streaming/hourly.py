"""Web events per hour and type, as a batch and as a stream (S3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakemart.operators.aggregates import count_rows
from lakemart.sources.latest import LatestTable
from lakemart.workspace import complete_folders, delete, exists, write_counted

CHANGES = "event_hour timestamp_ntz, event_type string, events bigint"


def hourly_events(events: DataFrame) -> DataFrame:
    """Event counts per hour and type over staged events; events without readable time have no hour."""
    return events.filter(F.col("event_hour").isNotNull()).groupBy("event_hour", "event_type").agg(count_rows().alias("events"))


def stream_hourly_events(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """The same counts over a stream of cleaned events, whatever the order in which they come.

    An event that arrives again replaces its earlier version, also in another hour; no event is ever too late.  A
    micro-batch only writes its own events; ``read_hourly`` counts, and ``compact_hourly`` settles what has come so far.
    """
    def add(batch: DataFrame, batch_id: int) -> None:
        add_events(batch.sparkSession, batch, path, batch_id)

    return events.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def state(spark: SparkSession, path: str) -> LatestTable:
    """The events by id: the state behind the counts."""
    return LatestTable(spark, f"{path}/events", "event_id")


def add_events(spark: SparkSession, batch: DataFrame, path: str, batch_id: int) -> None:
    """Add one micro-batch: what is read and written is the batch, whatever came before.  A repeated batch adds nothing."""
    state(spark, path).add(batch.select("event_id", "event_type", "event_hour", "_loaded_at"), f"{batch_id:012d}")


def compact_hourly(spark: SparkSession, path: str, share: float = 0.1, most_deltas: int = 16) -> str | None:
    """Settle the batches so far, apart from the stream: compact the state, and store the counts of a new base."""
    events = state(spark, path)
    made = events.compact(share, most_deltas)
    base = events.snapshot().base
    if base and not exists(spark, f"{path}/counts/{base}/_SUCCESS"):
        write_counted(hourly_events(spark.read.parquet(f"{events.folder}/base/{base}")), f"{path}/counts/{base}", "overwrite")
    known = complete_folders(spark, f"{events.folder}/base")
    for old in complete_folders(spark, f"{path}/counts"):
        if old not in known:
            delete(spark, f"{path}/counts/{old}")
    return made


def read_hourly(spark: SparkSession, path: str) -> DataFrame:
    """The counts after all batches so far: those stored with the base, less what batches since have replaced, plus
    what they have brought."""
    events = state(spark, path)
    now = events.snapshot()
    if now.empty:
        return spark.createDataFrame([], CHANGES)
    parts, moves = events.parts(now), []
    if now.base:
        stored = f"{path}/counts/{now.base}"
        settled = exists(spark, f"{stored}/_SUCCESS")
        moves.append(spark.read.schema(CHANGES).parquet(stored) if settled else hourly_events(spark.read.parquet(f"{events.folder}/base/{now.base}")))
    for name, sign in {"winners": 1, "contested": -1}.items():
        if name in parts:
            moves.append(hourly_events(spark.sql(parts[name])).withColumn("events", F.col("events") * sign))
    changes = moves[0]
    for more in moves[1:]:
        changes = changes.unionByName(more)
    return changes.groupBy("event_hour", "event_type").agg(F.sum("events").alias("events")).filter(F.col("events") > 0)
