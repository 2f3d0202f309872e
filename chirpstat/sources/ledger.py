"""A ledger of what a job has read of a topic: from which offset to which, run by run.

A topic scan "to the latest offset" is planned anew by every query, so two queries
of one job may see different ends, and nothing says later what a result was made
of. A job with a ledger reads on from the offsets at which the run before ended,
takes its own end from the messages it has really read, and records both with its
result. So

* every message is read by one run, and a result over all runs needs only the new
  messages and what the runs before have kept (`plans/jobs.run_daily_trend_since`);
* a run can be done again over exactly its messages (`Ledger.replay`).

Offsets are a partition -> offset map, the end being the first offset not read.
A topic is anything that gives Kafka-shaped rows from given offsets: `kafka_since`
asks the broker for them, `messages_since` filters a table of messages, where the
comparison reaches the Parquet scan.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chirpstat.sources.io import read_topic
from chirpstat.sources.versions import Record, Versions

Offsets = dict[int, int]

#: Messages from `start` (empty: the beginning) up to `end` (None: what is there now).
Topic = Callable[[Offsets, Offsets | None], DataFrame]

# --- Fixed value: how the Kafka source names the first offset of a partition ----
EARLIEST = -2


def offsets_json(topic: str, offsets: Offsets) -> str:
    """Offsets in the form of the Kafka source's startingOffsets and endingOffsets."""
    return json.dumps({topic: {str(p): o for p, o in sorted(offsets.items())}})


def between(messages: DataFrame, start: Offsets, end: Offsets | None) -> DataFrame:
    """The messages from `start` on (all of a partition it does not name) and before `end` (none of such a partition)."""
    p, o = F.col("partition"), F.col("offset")
    if start:
        # the plain comparison reaches the Parquet scan, the look-up is exact per partition
        messages = messages.where(~p.isin(*start) | (o >= min(start.values())))
        messages = messages.where(F.coalesce(o >= F.try_element_at(_map(start), p), F.lit(True)))
    if end is not None:
        messages = messages.where(p.isin(*end) & (o < max(end.values(), default=0)))
        messages = messages.where(F.coalesce(o < F.try_element_at(_map(end), p), F.lit(False)))
    return messages


def _map(offsets: Offsets) -> Column:
    partitions, firsts = F.lit([int(p) for p in offsets]), F.lit([int(o) for o in offsets.values()])
    return F.map_from_arrays(partitions.cast("array<int>"), firsts.cast("array<bigint>"))


def kafka_since(spark: SparkSession, bootstrap_servers: str, topic: str, partitions: list[int] | None = None, **kwargs) -> Topic:
    """A broker's topic. The source wants the start of every partition once one is given: name in
    `partitions` those that a growing topic has got since, and they are read from their beginning."""

    def read(start: Offsets, end: Offsets | None) -> DataFrame:
        if end is not None:  # only the partitions that the run has read, whatever the topic has got since
            first = {p: start.get(p, EARLIEST) for p in end}
            options = {"ending_offsets": offsets_json(topic, end), "partitions": sorted(end)}
        else:
            first, options = {p: EARLIEST for p in partitions or ()} | start, {}
        starting = offsets_json(topic, first) if first else "earliest"
        return read_topic(spark, bootstrap_servers, topic, starting_offsets=starting, **options, **kwargs)

    return read


def messages_since(read: Callable[[], DataFrame]) -> Topic:
    """A table of messages with `partition` and `offset`, as it is at each run.
    Messages without either have no place in a topic and are left out."""
    return lambda start, end: between(read().where("partition IS NOT NULL AND offset IS NOT NULL"), start, end)


@dataclass(frozen=True)
class Reading:
    """What one run has read, and where its result lies."""

    start: Offsets
    end: Offsets
    record: Record


class Ledger:
    """Readings behind the records of a folder (sources/versions.py). Runs follow one another:
    one that was begun before another ended fails (`Overtaken`) when it is recorded."""

    def __init__(self, spark: SparkSession, path: str):
        self.versions = Versions(spark, path)

    @staticmethod
    def _reading(record: Record) -> Reading:
        start, end = ({int(p): o for p, o in record.notes[k].items()} for k in ("start", "end"))
        return Reading(start, end, record)

    def readings(self) -> list[Reading]:
        """All runs, oldest first. A ledger is not pruned: a run is one small file."""
        return [self._reading(r) for r in self.versions.records()]

    def last(self) -> Reading | None:
        record = self.versions.last()
        return self._reading(record) if record else None

    def add(self, before: Reading | None, read_to: Offsets, version: str | None, **notes) -> Reading:
        """Record a run that went on from `before` and read up to `read_to`."""
        start = before.end if before else {}
        ends = {str(p): o for p, o in sorted({**start, **read_to}.items())}
        starts = {str(p): o for p, o in sorted(start.items())}
        after = before.record if before else None
        return self._reading(self.versions.point_at(version, after, follow=True, start=starts, end=ends, **notes))

    def replay(self, topic: Topic, reading: Reading) -> DataFrame:
        """Exactly the messages a run has read, as far as the topic still has them."""
        return topic(reading.start, reading.end)
