"""Tweets laid out for timeline lookups, in runs that new tweets are added to.

    <path>/run-<id>/     tweets sorted by author, time and id (`write_by_author`)
    <path>/_records      which runs count (sources/versions.py)

New tweets become a run of their own; the others are not touched. A timeline reads
all runs, and in each only the row groups that the author's range touches. To keep
runs few, `FAN` runs of about the same size (within a factor of `FAN`) are merged
into one: a tweet is rewritten once for every `FAN`-fold growth of the run it is
in, so adding a small share of tweets rewrites about that share, and there are at
most `FAN` runs for each such size.

Runs and merges are written first and their record last. Two writers may add at
the same time: each adds its run to whatever the last record says. A merge that
another writer has overtaken is dropped and left to a later one.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

from chirpstat.operators.select import ROWS_PER_FILE, write_by_author
from chirpstat.session import path_exists, remove_path
from chirpstat.sources.versions import RECORDS, Overtaken, Record, Versions

FAN = 8

Run = dict  # folder, rows


class AuthorTable:
    def __init__(self, spark: SparkSession, path: str, fan: int = FAN, rows_per_file: int = ROWS_PER_FILE):
        self.spark, self.fan, self.rows_per_file = spark, fan, rows_per_file
        self.versions = Versions(spark, path)

    def runs(self, record: Record | None = None) -> list[Run]:
        record = record or self.versions.last()
        return list(record.notes["runs"]) if record else []

    def _write(self, tweets: DataFrame, partitions: int | None) -> Run:
        folder = self.versions.new_version("run")
        rows = write_by_author(tweets, self.versions.folder(folder), partitions, self.rows_per_file)
        return {"folder": folder, "rows": rows}

    def add(self, tweets: DataFrame, partitions: int | None = None) -> int:
        """Add tweets (those with an id); returns how many. `partitions` as in `write_by_author`."""
        run = self._write(tweets, partitions)
        if not run["rows"]:
            remove_path(self.spark, self.versions.folder(run["folder"]))
            return 0
        while True:
            last = self.versions.last()
            try:
                self.versions.point_at(None, last, follow=True, runs=[*self.runs(last), run])
                break
            except Overtaken:  # another writer added a run: this one is added to that
                continue
        while self._merge(partitions):
            pass
        self._clean()
        return run["rows"]

    def _size(self, run: Run) -> int:
        """Runs of one size are within a factor of `fan` of each other."""
        return int(math.log(max(1, run["rows"]), self.fan) + 1e-9)

    def _merge(self, partitions: int | None) -> bool:
        """Merge the smallest runs of one size, if there are `fan` of them."""
        last = self.versions.last()
        by_size: dict[int, list[Run]] = {}
        for run in self.runs(last):
            by_size.setdefault(self._size(run), []).append(run)
        for size in sorted(by_size):
            group = by_size[size]
            if len(group) < self.fan:
                continue
            merged = self._write(self._read(group), partitions)
            kept = [r for r in self.runs(last) if r not in group]
            try:
                self.versions.point_at(None, last, follow=True, runs=[*kept, merged])
            except Overtaken:
                remove_path(self.spark, self.versions.folder(merged["folder"]))
                return False
            return True
        return False

    def _clean(self) -> None:
        """Remove runs that only records older than the last two name."""
        old = self.versions.prune_records(keep=2)
        used = {r["folder"] for record in self.versions.records() for r in self.runs(record)}
        for folder in {r["folder"] for record in old for r in self.runs(record)} - used:
            remove_path(self.spark, self.versions.folder(folder))

    def _read(self, runs: list[Run]) -> DataFrame:
        return self.spark.read.parquet(*[self.versions.folder(r["folder"]) for r in runs])

    def read(self) -> DataFrame | None:
        """All tweets of the table (None: there are none yet)."""
        runs = self.runs()
        return self._read(runs) if runs else None


def read_author_table(spark: SparkSession, path: str) -> DataFrame:
    """A table of `AuthorTable`, or the single folder that `write_by_author` writes."""
    if path_exists(spark, f"{path.rstrip('/')}/{RECORDS}"):
        tweets = AuthorTable(spark, path).read()
        if tweets is None:
            raise ValueError(f"{path} has no tweets yet")
        return tweets
    return spark.read.parquet(path)
