"""Read files are moved away or deleted by a manifest, so that an interrupted load ends right on repetition.

What is to be done with the files of a run is written down before its rows become visible.  A run is committed when
its partition is in the catalog (a run that repeats an earlier one: when it says so): from then on its moves are due, whoever
does them, as often as they are tried.
Renames are calls to the storage's name service, not data work; Spark's tasks can't make them, a pool of threads does.
"""

from __future__ import annotations

from collections import Counter
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from lakemart.sources.lake import Lake
from lakemart.workspace import complete_folders, delete, exists, hadoop_path, write_text

MANIFEST = "table_name string, source string, target string, repeats boolean"
COMMITTED = "_committed"
THREADS = 16


def plan(lake: Lake, table: str, run_id: str, files: list[str], root: str, folder: str | None) -> None:
    """Write down that ``files`` go below ``folder`` with their path below ``root``, or are deleted (None)."""
    below = hadoop_path(lake.spark, root)[1].toUri().getPath().rstrip("/") + "/"

    def target(file: str) -> str | None:
        if folder is None:
            return None
        path = hadoop_path(lake.spark, file)[1]
        inside = path.toUri().getPath().partition(below)[2]
        return f"{folder.rstrip('/')}/{inside or path.getName()}"

    repeats = lake.has_run(table, run_id)
    rows = [(table, file, target(file), repeats) for file in sorted(files)]
    goals = Counter(row[2] for row in rows if row[2])
    if taken := [goal for goal, n in goals.items() if n > 1]:
        raise OSError(f"several files would become {taken[0]}")
    lake.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(_path(lake, run_id))


def forget(lake: Lake, run_id: str) -> None:
    """A run that starts anew owes nothing that an earlier try of it had planned."""
    delete(lake.spark, _path(lake, run_id))


def commit(lake: Lake, run_id: str) -> None:
    """The rows of the run are visible."""
    write_text(lake.spark, f"{_path(lake, run_id)}/{COMMITTED}", "")


def unfinished(lake: Lake) -> list[str]:
    """Runs whose files are not all moved, committed or not."""
    return complete_folders(lake.spark, _folder(lake))


def finish(lake: Lake, run_id: str) -> int:
    """Do what is left of a run's moves and forget them; returns the number of files that were still in place."""
    rows = lake.spark.read.schema(MANIFEST).parquet(_path(lake, run_id)).collect()  # names that the load's driver has listed
    with ThreadPoolExecutor(THREADS) as pool:
        moved = sum(pool.map(lambda row: _done(lake, row["source"], row["target"]), rows))
    delete(lake.spark, _path(lake, run_id))
    return moved


def recover(lake: Lake, table: str) -> list[str]:
    """Finish the moves of all committed runs of ``table``; returns these runs.  Others may be loads that still run."""
    due = []
    for run_id in unfinished(lake):
        first = lake.spark.read.schema(MANIFEST).parquet(_path(lake, run_id)).where(F.col("table_name") == table).first()
        if first and (exists(lake.spark, f"{_path(lake, run_id)}/{COMMITTED}") or (not first["repeats"] and lake.has_run(table, run_id))):
            finish(lake, run_id)
            due.append(run_id)
    return due


def _done(lake: Lake, file: str, target: str | None) -> bool:
    """Move or delete one file if it is still there; a file of that name that is not ours is never replaced."""
    if target is None:
        fs, path = hadoop_path(lake.spark, file)
        return fs.delete(path, False)
    fs, source = hadoop_path(lake.spark, file)
    goal = hadoop_path(lake.spark, target)[1]
    if not fs.exists(source):
        if fs.exists(goal):
            return False  # by an earlier try
        raise OSError(f"{file} is gone, but not to {target}")
    fs.mkdirs(goal.getParent())
    if fs.exists(goal) or not fs.rename(source, goal):
        raise OSError(f"could not move {file} to {target}")
    return True


def _folder(lake: Lake) -> str:
    return f"{lake.root}/_moves/{lake.raw}"


def _path(lake: Lake, run_id: str) -> str:
    return f"{_folder(lake)}/{run_id}"
