"""Which run of a stream a table belongs to."""

from __future__ import annotations

import json
import threading

from pyspark.sql import SparkSession

from chirpstat.session import read_text, remove_path
from chirpstat.sources.versions import Overtaken, Record, Versions


class Held:
    """A stream's hold on the table it writes, batch by batch. The table shows one run at a time."""

    def __init__(self, spark: SparkSession, target: str, checkpoint: str, fmt: str = "parquet"):
        self.spark, self.checkpoint, self.fmt = spark, checkpoint.rstrip("/"), fmt
        self.versions = Versions(spark, target, fmt)
        self._run: str | None = None
        self._lock = threading.Lock()  # the caller's thread and the first batch both claim

    def _left(self, run: str) -> tuple[str | None, dict]:
        """What a run finds when it claims the table: the version and notes it has left there, if any."""
        raise NotImplementedError

    def claim(self, run: str) -> None:
        """Make this run the one whose results the table shows."""
        with self._lock:
            while self._run is None:
                last = self.versions.last()
                if last is None or last.notes.get("run") != run:
                    version, notes = self._left(run)
                    try:
                        self._point_at(version, last, run, notes)
                    except Overtaken:  # another run claimed it just now: this one came later
                        continue
                self._run = run

    def _point_at(self, version: str | None, last: Record | None, run: str, notes: dict) -> None:
        self.versions.point_at(version, last, follow=True, run=run, checkpoint=self.checkpoint, **notes)

    def _begin_batch(self) -> str:
        """The run that the batch belongs to, with the table claimed for it."""
        run = json.loads(read_text(self.spark, f"{self.checkpoint}/metadata"))["id"]
        self.claim(run)
        return run

    def _own(self, run: str, *written: str) -> Record:
        """The last record, which must be the run's; otherwise what the batch has written goes."""
        last = self.versions.last()
        if last is None or last.notes.get("run") != run:
            for folder in written:
                remove_path(self.spark, self.versions.folder(folder))
            raise Overtaken(f"{self.versions.path} now belongs to the run {last and last.notes.get('run')}")
        return last
