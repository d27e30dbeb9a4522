"""The layered tables: raw appended per run, staging and marts replaced as a whole."""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators.dedup import latest_per_key
from lakemart.sources import schemas
from lakemart.sources.latest import new_version
from lakemart.workspace import delete, hadoop_path, stored_bytes, unsorted_writes, write_counted

STARTED, SUCCESS, FAILED = "STARTED", "SUCCESS", "FAILED"


class Lake:
    """Databases ``raw``, ``stg`` and ``marts`` (or prefixed names) over one root folder."""

    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        self.spark = spark
        self.root = root.rstrip("/")
        self.raw, self.stg, self.marts = (prefix + layer for layer in ("raw", "stg", "marts"))

    def create(self) -> None:
        """Databases, raw tables and the run log, where they do not exist yet."""
        for layer in (self.raw, self.stg, self.marts):
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{self.root}/{layer}'")
        for table in schemas.RAW_TABLES:
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.raw_schema(table).fields)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.raw}.{table} ({columns}) USING parquet "
                f"PARTITIONED BY (_run_id) LOCATION '{self._path(self.raw, table)}'"
            )
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.RUN_LOG_SCHEMA.fields)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.raw}.{schemas.RUN_LOG} ({columns}) USING parquet "
            f"LOCATION '{self._path(self.raw, schemas.RUN_LOG)}'"
        )

    def tables(self, layer: str) -> list[str]:
        """Names of the tables in a layer."""
        return sorted(t.name for t in self.spark.catalog.listTables(layer) if not t.isTemporary)

    def table(self, layer: str, name: str) -> DataFrame:
        """I20"""
        return self.spark.table(f"{layer}.{name}")

    def bytes(self, layer: str) -> int:
        """Stored size of a layer."""
        return stored_bytes(self.spark, f"{self.root}/{layer}")

    def append_raw(self, table: str, df: DataFrame, run_id: str) -> int:
        """Add the rows of one run and return their number.

        A run is one partition, so repeating it after a failure replaces its rows and no others.
        """
        path = self._path(self.raw, table)
        columns = (schemas.REJECTS_SCHEMA if table == schemas.REJECTS else schemas.raw_schema(table)).fieldNames()
        with unsorted_writes(df.sparkSession):
            rows = write_counted(df.select(*columns), path, "overwrite", ["_run_id"], partitionOverwriteMode="dynamic")
        self.spark.sql(f"ALTER TABLE {self.raw}.{table} ADD IF NOT EXISTS PARTITION (_run_id = '{run_id}')")
        self.spark.catalog.refreshTable(f"{self.raw}.{table}")
        return rows

    def has_run(self, table: str, run_id: str) -> bool:
        """Whether the rows of a run are visible."""
        return not self.spark.sql(f"SHOW PARTITIONS {self.raw}.{table} PARTITION (_run_id = '{run_id}')").isEmpty()

    def append_rejects(self, df: DataFrame, run_id: str) -> int:
        """Set aside the records of a run that could not be taken; the first ones make the table."""
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.REJECTS_SCHEMA.fields)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.raw}.{schemas.REJECTS} ({columns}) USING parquet "
            f"PARTITIONED BY (_run_id) LOCATION '{self._path(self.raw, schemas.REJECTS)}'"
        )
        return self.append_raw(schemas.REJECTS, df, run_id)

    def rejects(self) -> DataFrame:
        """All records that loads have set aside."""
        if schemas.REJECTS in self.tables(self.raw):
            return self.table(self.raw, schemas.REJECTS)
        return self.spark.createDataFrame([], schemas.REJECTS_SCHEMA)

    def publish(self, layer: str, name: str, df: DataFrame, partition_by: list[str] | None = None, keep: int = 2) -> int:
        """Replace a table and return its row count.

        The new version is written beside the old one and the view is switched in one catalog call, so
        a reader sees one or the other; ``keep`` versions stay for queries that still run.  With
        ``partition_by``, AQE first gathers the rows of each partition and splits the large ones.
        """
        version = f"{self._path(layer, name)}/{new_version()}"
        if partition_by:
            df = df.hint("rebalance", *partition_by)
        rows = write_counted(df, version, partition_by=partition_by)
        columns = ", ".join(f"`{c}`" for c in df.columns)  # a partitioned file layout has them in another order
        self.switch(layer, name, f"SELECT {columns} FROM parquet.`{version}`")
        for old in self._versions(self._path(layer, name))[:-keep]:
            delete(self.spark, old)
        return rows

    def switch(self, layer: str, name: str, sql: str) -> None:
        """Let ``name`` be what ``sql`` says, in one catalog call."""
        self.spark.sql(f"CREATE OR REPLACE VIEW {layer}.{name} AS {sql}")

    def log_folder(self, layer: str, name: str) -> str:
        """Where a table that is kept as a log has its files."""
        return self._path(layer, f"{name}_log")

    def log_run(self, table: str, run_id: str, status: str, started_at: dt.datetime, rows: int | None = None,
                source: str | None = None, error: str | None = None, failed: int = 0) -> None:
        """Append one entry; a run has one when it starts and one when it ends."""
        entry = (run_id, table, source, rows, failed, status, error and error[:2000], started_at.isoformat(" "),
                 None if status == STARTED else utc_now().isoformat(" "), self.user)
        columns = [F.lit(value).cast(f.dataType).alias(f.name) for value, f in zip(entry, schemas.RUN_LOG_SCHEMA.fields)]
        self.spark.range(0, 1, 1, 1).select(*columns).write.mode("append").insertInto(f"{self.raw}.{schemas.RUN_LOG}")

    @cached_property
    def user(self) -> str:
        """F26"""
        return self.spark.sql("SELECT current_user()").first()[0]

    def runs(self) -> DataFrame:
        """The latest entry of each run; an unfinished run has no completion time yet."""
        entries = self.table(self.raw, schemas.RUN_LOG).withColumn("_ended", F.col("completed_at").isNotNull())
        return latest_per_key(entries, ["run_id"], "_ended").drop("_ended")

    def _path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def _versions(self, folder: str) -> list[str]:
        fs, path = hadoop_path(self.spark, folder)
        return sorted(s.getPath().toString() for s in fs.listStatus(path))


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
