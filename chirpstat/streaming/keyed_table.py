"""A file table with one row a key, kept up to date by the rows that change.

    <path>/base-<id>/       key, values: every key once
    <path>/changes-<id>/    key, values, _batch: the rows that changed in some batches
    <path>/_records         which base and which changes count, in order (sources/versions.py)

A batch adds a folder of changes and a record, nothing else. The last change of a
key is its row; keys without one have their row in the base. Folders of changes
are merged with one another when there are more than `MOST_CHANGES`, and with the
base once they hold over `MOST_CHANGED` of its rows: so a batch's own output is
its changed rows, and merging rewrites a row only after as many changes as a fixed
share of the table. A merge writes new folders and then one record; readers of the
old ones are not disturbed, as the folders of the last two records are kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chirpstat.session import list_names, observed_write, path_exists, remove_path
from chirpstat.sources.versions import Record, Versions
from chirpstat.streaming.held import Held

#: Folders of changes before they are merged, and share of the base's rows that changes may hold.
MOST_CHANGES = 16
MOST_CHANGED = 0.5

EMPTY = {"base": None, "base_rows": 0, "changes": [], "changed_rows": 0, "batch": None}


def _latest(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last change of every key, with its batch."""
    values = [c for c in changes.columns if c not in keys]
    last = changes.groupBy(*keys).agg(F.max_by(F.struct(*values), "_batch").alias("_last"))
    return last.select(*keys, "_last.*")


def _merged(versions: Versions, notes: dict) -> DataFrame | None:
    """Base and changes as one table."""
    spark = versions.spark
    base = versions.spark.read.parquet(versions.folder(notes["base"])) if notes["base"] else None
    if not notes["changes"]:
        return base
    keys = notes["keys"]
    latest = _latest(spark.read.parquet(*[versions.folder(c) for c in notes["changes"]]), keys).drop("_batch")
    if base is None:
        return latest
    same = [F.col(f"b.`{k}`").eqNullSafe(F.col(f"l.`{k}`")) for k in keys]
    on = same[0]
    for s in same[1:]:
        on = on & s
    left = base.alias("b").join(latest.select(*keys).alias("l"), on, "left_anti")
    return left.unionByName(latest)


def read_keyed(spark: SparkSession, target: str) -> DataFrame | None:
    """The table as of its last record (None: it holds nothing yet)."""
    versions = Versions(spark, target)
    last = versions.last()
    return None if last is None else _merged(versions, last.notes)


class KeyedTable(Held):
    """The writing side: `write` takes the changed rows of a micro-batch."""

    def __init__(
        self, spark: SparkSession, target: str, checkpoint: str, keys: Sequence[str],
        most_changes: int = MOST_CHANGES, most_changed: float = MOST_CHANGED,
    ):
        super().__init__(spark, target, checkpoint)
        self.keys = list(keys)
        self.most_changes, self.most_changed = most_changes, most_changed

    def _left(self, run: str) -> tuple[str | None, dict]:
        own = [r for r in self.versions.records() if r.notes.get("run") == run]
        notes = own[-1].notes if own else {}
        if own and all(path_exists(self.spark, self.versions.folder(f)) for f in _folders(own[-1])):
            return None, {k: notes[k] for k in ("keys", *EMPTY)}
        if own and notes["batch"] is not None:
            # only the keys that change from now on would come back
            raise RuntimeError(f"the rows of the run {run} are no longer in {self.versions.path}; start it with a new checkpoint")
        return None, {"keys": self.keys, **EMPTY}

    def _state(self, last: Record) -> dict:
        return {k: last.notes[k] for k in ("keys", *EMPTY)}

    def write(self, batch: DataFrame, batch_id: int) -> None:
        run = self._begin_batch()
        folder = self.versions.new_version(f"changes-{batch_id}")
        path = self.versions.folder(folder)
        rows = batch.withColumn("_batch", F.lit(batch_id).cast("long"))
        count = observed_write(rows, lambda r: r.write.parquet(path))["rows"]
        last = self._own(run, folder)
        state = {**self._state(last), "batch": batch_id}
        if count:
            state["changes"] = [*state["changes"], folder]
            state["changed_rows"] += count
        self._point_at(None, last, run, state)
        self._merge(run)
        self._clean()

    def _merge(self, run: str) -> None:
        last = self._own(run)
        state = self._state(last)
        if state["changed_rows"] > self.most_changed * max(1, state["base_rows"]):
            folder = self.versions.new_version("base")
            path = self.versions.folder(folder)
            rows = observed_write(_merged(self.versions, state), lambda r: r.write.parquet(path))["rows"]
            state |= {"base": folder, "base_rows": rows, "changes": [], "changed_rows": 0}
        elif len(state["changes"]) > self.most_changes:
            folder = self.versions.new_version("changes-merged")
            path = self.versions.folder(folder)
            all_ = self.spark.read.parquet(*[self.versions.folder(c) for c in state["changes"]])
            rows = observed_write(_latest(all_, self.keys), lambda r: r.write.parquet(path))["rows"]
            state |= {"changes": [folder], "changed_rows": rows}
        else:
            return
        self._point_at(None, self._own(run, folder), run, state)

    def _clean(self) -> None:
        """Remove folders that the last two records do not name (one run at a time writes here), and older records."""
        self.versions.prune_records(keep=2)
        used = {f for record in self.versions.records() for f in _folders(record)}
        for name in list_names(self.spark, self.versions.path):
            if name.startswith(("base-", "changes-")) and name not in used:
                remove_path(self.spark, self.versions.folder(name))


def _folders(record: Record) -> list[str]:
    base = record.notes.get("base")
    return [*([base] if base else []), *record.notes.get("changes", [])]
