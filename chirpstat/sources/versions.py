"""A table that is replaced as a whole: version folders behind numbered records.

    <path>/<version>/           one folder a version, written by Spark
    <path>/_records/<number>    one small JSON file a change, written once

The whole record with the highest number points at the table's content. A version
is written first and its record last, so a write that dies at any point leaves the
version before it readable, and a reader never sees half of one. Records are
created, never rewritten or renamed, so no store needs an atomic rename; a record
that was cut off is no JSON object and is passed over. Two writers cannot make the
same record: the one that comes second takes the next number, or fails if it
asked to follow a given record.

Superseded versions stay for readers that are at work on them: `prune` keeps the
newest few. Only records, one small file a kept version, are read on the driver.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from chirpstat.session import create_text, list_changed, list_names, path_exists, read_text, remove_path

RECORDS = "_records"


class Overtaken(RuntimeError):
    """Another writer has changed the table since it was looked at."""


@dataclass(frozen=True)
class Record:
    """One change of the table: the version it points at (None: no content yet) and what the writer noted."""

    number: int
    version: str | None
    notes: dict = field(default_factory=dict)


class Versions:
    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet"):
        self.spark, self.path, self.fmt = spark, path.rstrip("/"), fmt

    def folder(self, version: str) -> str:
        return f"{self.path}/{version}"

    def new_version(self, prefix: str = "version") -> str:
        """A name no other writer uses."""
        return f"{prefix}-{uuid.uuid4().hex[:12]}"

    def _numbers(self) -> list[int]:
        return sorted(int(n) for n in list_names(self.spark, f"{self.path}/{RECORDS}") if n.isdigit())

    def _record(self, number: int) -> Record | None:
        """The record, or None if it was cut off or has just been pruned."""
        try:
            body = json.loads(read_text(self.spark, f"{self.path}/{RECORDS}/{number:012d}"))
            return Record(number, body["version"], body["notes"])
        except ValueError:
            return None
        except Exception:
            if path_exists(self.spark, f"{self.path}/{RECORDS}/{number:012d}"):
                raise
            return None

    def records(self) -> list[Record]:
        """All whole records, oldest first."""
        return [r for n in self._numbers() if (r := self._record(n)) is not None]

    def last(self) -> Record | None:
        """The record that points at the content now."""
        for number in reversed(self._numbers()):
            record = self._record(number)
            if record is not None:
                return record
        return None

    def point_at(self, version: str | None, after: Record | None = None, follow: bool = False, **notes) -> Record:
        """Make `version` the content. With `follow`, only if `after` is still the last record (else Overtaken)."""
        text = json.dumps({"version": version, "notes": notes}, sort_keys=True)
        while True:
            last = self.last()
            if follow and (last and last.number) != (after and after.number):
                raise Overtaken(f"{self.path} was changed by another writer (record {last and last.number})")
            number = max(self._numbers(), default=0) + 1
            if create_text(self.spark, f"{self.path}/{RECORDS}/{number:012d}", text):
                return Record(number, version, notes)

    def read(self, record: Record | None = None) -> DataFrame | None:
        """The content now, or as of a kept record; None if there is none."""
        record = record or self.last()
        if record is None or record.version is None:
            return None
        return self.spark.read.format(self.fmt).load(self.folder(record.version))

    def prune_records(self, keep: int = 2) -> list[Record]:
        """Delete all but the newest `keep` records; returns the deleted ones."""
        old = self.records()[:-keep]
        for record in old:
            remove_path(self.spark, f"{self.path}/{RECORDS}/{record.number:012d}")
        return old

    def prune(self, keep: int = 2, abandoned_after: float = 86_400.0) -> None:
        """Delete all but the newest `keep` records and their versions, and folders without
        a record that have not changed for `abandoned_after` seconds (writes that died)."""
        used = {r.version for r in self.records()[-keep:]}
        for record in self.prune_records(keep):
            if record.version is not None and record.version not in used:
                remove_path(self.spark, self.folder(record.version))
        limit = (time.time() - abandoned_after) * 1000
        for name, changed in list_changed(self.spark, self.path).items():
            if name not in used and not name.startswith(("_", ".")) and changed <= limit:
                remove_path(self.spark, self.folder(name))
