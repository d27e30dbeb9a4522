"""The latest row per key while rows arrive, as a log-structured merge.

What arrives is written as deltas, and nothing else: a batch costs what it brings.  Reads resolve the deltas against the
base, whose rows are only compared where a delta has their key; as long as deltas are small, Spark broadcasts their keys
and the base is not shuffled.  Deltas that are a large share of the table are compared with all of it in one shuffle, as
joins by their keys would shuffle the base once each.  Compaction runs apart from the stream, writes a new base or one delta for many, and
names it in a new state file, so that readers see one state or the other.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lakemart.operators.dedup import latest_per_key
from lakemart.workspace import complete_folders, delete, exists, file_names, read_text, stored_bytes, write_counted, write_text


#: Deltas beyond this share of a table are many: worth a new base, and read with all rows at once.
MANY = 0.1


def new_version() -> str:
    """A folder name that sorts by time."""
    return f"{dt.datetime.now(dt.timezone.utc):%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:8]}"


@dataclass(frozen=True)
class Snapshot:
    """A base folder, if there is one, the deltas on top of it, and those that it already holds."""

    base: str | None
    deltas: tuple[str, ...]
    folded: tuple[str, ...] = ()

    @property
    def empty(self) -> bool:
        return self.base is None and not self.deltas


class LatestTable:
    """Table of the row with the greatest ``latest`` for each key, below one folder.

    Ties are broken by the other columns in their order, but for ``untied`` ones.  ``switch`` is called with the
    SQL of the current state whenever that changes, for a catalog view.  One writer may add deltas and another process
    compact at the same time.
    """

    def __init__(self, spark: SparkSession, folder: str, key: str, latest: str = "_loaded_at", untied: Sequence[str] = ("_stg_updated_at",),
                 switch: Callable[[str], None] | None = None):
        self.spark, self.folder, self.key, self.latest, self.untied = spark, folder.rstrip("/"), key, latest, tuple(untied)
        self.switch = switch

    def add(self, changes: DataFrame, delta_id: str, derive: Callable[[DataFrame], DataFrame] | None = None) -> None:
        """Add changed rows; one that is repeated after a failure is not written again.

        ``derive`` adds what follows from the other columns of a row: that breaks no tie, so only the latest rows get it.
        """
        path = self._delta(delta_id)
        if not exists(self.spark, f"{path}/_SUCCESS"):
            latest = latest_per_key(changes, [self.key], self.latest, self._tied(changes.columns))
            write_counted(derive(latest) if derive else latest, path, "overwrite")
        self._announce()

    def snapshot(self) -> Snapshot:
        """What a reader that starts now sees."""
        state = self._states()[-1:]
        known = json.loads(read_text(self.spark, f"{self.folder}/states/{state[0]}")) if state else {"base": None, "folded": []}
        folded = set(known["folded"])
        return Snapshot(known["base"], tuple(d for d in complete_folders(self.spark, f"{self.folder}/deltas") if d not in folded), tuple(known["folded"]))

    def read(self, snapshot: Snapshot | None = None, keys: DataFrame | None = None) -> DataFrame:
        """The table as of ``snapshot`` (now); with ``keys``, a frame of distinct keys, only their rows are looked at."""
        snapshot = snapshot or self.snapshot()
        if keys is None:
            return self.spark.sql(self.sql(snapshot))
        name = f"keys_{uuid.uuid4().hex}"
        keys.createOrReplaceTempView(name)
        try:
            return self.spark.sql(self.sql(snapshot, name))
        finally:
            self.spark.catalog.dropTempView(name)

    def changed_keys(self, old: Snapshot, new: Snapshot) -> DataFrame | None:
        """Distinct keys of all deltas that came after ``old``; None if the files of ``old`` are gone."""
        needed = [self._delta(d) for d in old.deltas] + ([self._base(old.base)] if old.base else [])
        if not all(exists(self.spark, f"{p}/_SUCCESS") for p in needed) or (old.base is None and new.base is not None and not old.deltas):
            return None
        later = self._later(old, new)
        if not all(exists(self.spark, self._delta(d)) for d in later):
            return None
        if not later:
            return self.read(new).select(self.key).limit(0)
        return self.spark.sql(f"SELECT DISTINCT `{self.key}` FROM {self._deltas(later)}")

    def many_changed(self, old: Snapshot, new: Snapshot) -> bool:
        """Whether the deltas that came after ``old`` are a large share of ``new``."""
        later = sum(stored_bytes(self.spark, self._delta(d)) for d in self._later(old, new))
        return later > MANY * (self._base_bytes(new) + self._delta_bytes(new))

    def marked(self, snapshot: Snapshot, keys: DataFrame, mark: str) -> DataFrame:
        """The table as of ``snapshot`` with a column that says whether a row's key is among ``keys``.

        The keys are shuffled with the rows that are compared, so this is one shuffle, however many they are.
        """
        name = f"keys_{uuid.uuid4().hex}"
        keys.createOrReplaceTempView(name)
        try:
            return self.spark.sql(self._all_at_once(snapshot, name, mark))
        finally:
            self.spark.catalog.dropTempView(name)

    def compact(self, share: float = MANY, most_deltas: int = 16, keep: int = 2) -> str | None:
        """Bound what reads have to resolve: a new base once the deltas are more than ``share`` of it, one delta for
        more than ``most_deltas``.  Returns "base", "delta" or None; ``keep`` states stay readable."""
        now = self.snapshot()
        if not now.deltas:
            return None
        if now.base is None or self._delta_bytes(now) > share * self._base_bytes(now):
            made, base = "base", new_version()
            write_counted(self.read(now), self._base(base))
        elif len(now.deltas) > most_deltas:
            made, base = "delta", now.base
            merged = f"merged-{new_version()}"
            self._note_merged(merged, now.deltas)
            write_counted(self.read(Snapshot(None, now.deltas)), self._delta(merged))
        else:
            return None
        left = set(complete_folders(self.spark, f"{self.folder}/deltas"))
        folded = [d for d in (*now.folded, *now.deltas) if d in left]
        write_text(self.spark, f"{self.folder}/states/{new_version()}.json", json.dumps({"base": base, "folded": folded}))
        self._announce()
        self._forget(keep)
        return made

    def sql(self, snapshot: Snapshot, keys: str | None = None) -> str:
        """The table as SQL; with the name of a view of distinct ``keys``, only their rows."""
        if keys is None and snapshot.base and self._delta_bytes(snapshot) > MANY * self._base_bytes(snapshot):
            return self._all_at_once(snapshot)
        parts = self.parts(snapshot, keys)
        return " UNION ALL ".join(parts[name] for name in ("kept", "winners") if name in parts)

    def parts(self, snapshot: Snapshot, keys: str | None = None) -> dict[str, str]:
        """SQL of the base rows that no delta touches (kept), those that one does (contested), and the latest of the
        latter and the deltas (winners)."""
        columns, order = self._columns(snapshot)
        listed, key = ", ".join(columns), f"`{self.key}`"

        def rows(source: str, how: str = "", other: str = "") -> str:
            wanted = f" LEFT SEMI JOIN {keys} AS w ON t.{key} <=> w.{key}" if keys else ""
            return f"SELECT {listed} FROM {source} AS t{wanted}" + (f" {how} JOIN ({other}) AS n ON t.{key} <=> n.{key}" if how else "")

        def newest(source: str) -> str:
            return f"SELECT {listed} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS _rn FROM ({source})) WHERE _rn = 1"

        base = f"parquet.`{self._base(snapshot.base)}`" if snapshot.base else None
        if not snapshot.deltas:
            return {"kept": rows(base)}
        changed = rows(self._deltas(snapshot.deltas))
        if base is None:  # a delta has one row per key
            return {"winners": newest(changed) if len(snapshot.deltas) > 1 else changed}
        touched = f"SELECT DISTINCT {key} FROM ({changed})"
        contested = rows(base, "LEFT SEMI", touched)
        return {"kept": rows(base, "LEFT ANTI", touched), "contested": contested, "winners": newest(f"{changed} UNION ALL {contested}")}

    def _all_at_once(self, snapshot: Snapshot, keys: str | None = None, mark: str | None = None) -> str:
        """SQL of the latest of all rows, compared in one shuffle; ``mark`` says whether a key is in the view ``keys``."""
        columns, order = self._columns(snapshot)
        listed, key = ", ".join(columns), f"`{self.key}`"
        folders = ([self._base(snapshot.base)] if snapshot.base else []) + [self._delta(d) for d in snapshot.deltas]
        rows = [f"SELECT {listed}{', false AS _asked' if keys else ''} FROM parquet.`{folder}`" for folder in folders]
        asked, first = "", ""
        if keys:  # a key stands behind the rows that have it
            rows.append(f"SELECT {', '.join(c if c == key else f'NULL AS {c}' for c in columns)}, true AS _asked FROM {keys}")
            asked, first = f", max(_asked) OVER (PARTITION BY {key}) AS `{mark}`", "_asked, "
        numbered = f"SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {first}{order}) AS _rn{asked} FROM ({' UNION ALL '.join(rows)})"
        return f"SELECT {listed}{f', `{mark}`' if keys else ''} FROM ({numbered}) WHERE _rn = 1{' AND NOT _asked' if keys else ''}"

    def _columns(self, snapshot: Snapshot) -> tuple[list[str], str]:
        """The columns, quoted, and the order of the rows of a key."""
        if snapshot.empty:
            raise LookupError(f"{self.folder} has no rows yet")
        names = self.spark.read.parquet(self._base(snapshot.base) if snapshot.base else self._delta(snapshot.deltas[0])).columns
        return [f"`{c}`" for c in names], ", ".join(f"`{c}` DESC NULLS FIRST" for c in [self.latest, *self._tied(names)])

    def _later(self, old: Snapshot, new: Snapshot) -> list[str]:
        """The deltas that came after ``old``, those that are in the base of ``new`` by now among them."""
        seen = {*old.deltas, *old.folded}
        return [d for d in (*new.deltas, *new.folded) if d not in seen and not self._merged_from(d) <= seen]

    def _base_bytes(self, snapshot: Snapshot) -> int:
        return stored_bytes(self.spark, self._base(snapshot.base)) if snapshot.base else 0

    def _delta_bytes(self, snapshot: Snapshot) -> int:
        return sum(stored_bytes(self.spark, self._delta(d)) for d in snapshot.deltas)

    def _tied(self, columns: Sequence[str]) -> list[str]:
        return [c for c in columns if c not in (self.key, self.latest, *self.untied)]

    def _base(self, version: str) -> str:
        return f"{self.folder}/base/{version}"

    def _delta(self, delta_id: str) -> str:
        return f"{self.folder}/deltas/{delta_id}"

    def _deltas(self, ids: Sequence[str]) -> str:
        return f"parquet.`{self._delta(ids[0] if len(ids) == 1 else '{' + ','.join(ids) + '}')}`"

    def _states(self) -> list[str]:
        return sorted(file_names(self.spark, f"{self.folder}/states"))

    def _note_merged(self, merged: str, parts: Sequence[str]) -> None:
        write_text(self.spark, f"{self.folder}/merged/{merged}.json", json.dumps(list(parts)))

    def _merged_from(self, delta_id: str) -> set[str]:
        """The deltas that a merged one is made of; another one is only itself."""
        note = f"{self.folder}/merged/{delta_id}.json"
        if not delta_id.startswith("merged-") or not exists(self.spark, note):
            return {delta_id}
        return {x for part in json.loads(read_text(self.spark, note)) for x in self._merged_from(part)}

    def _announce(self) -> None:
        """Give the current SQL to ``switch``, again if the state changed in between."""
        told = None
        while self.switch and (now := self.snapshot()) != told:
            self.switch(self.sql(now))
            told = now

    def _forget(self, keep: int) -> None:
        """Delete what only states before the last ``keep`` ones need."""
        states = self._states()
        if len(states) <= keep:
            return
        kept = [json.loads(read_text(self.spark, f"{self.folder}/states/{s}")) for s in states[-keep:]]
        for state in states[:-keep]:
            delete(self.spark, f"{self.folder}/states/{state}")
        for version in set(complete_folders(self.spark, f"{self.folder}/base")) - {k["base"] for k in kept}:
            delete(self.spark, self._base(version))
        for old in kept[0]["folded"]:
            delete(self.spark, self._delta(old))
