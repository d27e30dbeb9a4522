"""Session settings that the rest of the package relies on."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: UTC makes LTZ <-> NTZ casts the identity; AQE picks joins from real sizes, splits skewed join
#: partitions and coalesces small ones, so a high initial partition number costs little.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

MB = 1 << 20
MAX_TASKS = 100_000


def get_session(app: str = "lakemart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with ``SETTINGS``; ``master`` only for local runs, a cluster names its own."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def sizes_for(input_bytes: int) -> dict[str, int]:
    """Settings by which a full shuffle of ``input_bytes`` of Parquet fits its tasks.

    Rows take about twice their Parquet size in a shuffle.  Tasks get 256 MB of it until there are
    ``MAX_TASKS``, and more beyond, as the number of shuffle blocks grows with the square.
    """
    return {
        "spark.sql.shuffle.partitions": min(max(1, -(-2 * input_bytes // (256 * MB))), MAX_TASKS),
        "spark.sql.files.maxPartitionBytes": min(max(128 * MB, input_bytes // MAX_TASKS), 1024 * MB),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": 256 * MB,
    }


@contextmanager
def sized_for(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Apply ``sizes_for`` while large input is worked on; input that the session is set up for changes nothing."""
    wanted = sizes_for(input_bytes)
    if wanted["spark.sql.shuffle.partitions"] <= int(spark.conf.get("spark.sql.shuffle.partitions")):
        yield
        return
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
