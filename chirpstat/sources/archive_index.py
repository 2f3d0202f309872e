"""Ids of an archive, so that appends at different times keep one message an id.

Beside the archive lies an index, in runs of one append each:

    <index>/<run>/ids      bucket, id: every id once, sorted by bucket and id
    <index>/<run>/blooms   bucket, bits: one 32,768-bit Bloom filter a bucket
    <index>/_records       which runs count, and whether an append is going on

An append asks the filters first (about 1 % of new ids pass by chance), then looks
up those that pass among the ids themselves, exactly; only they are joined, and
the ids of the archive are never shuffled as long as few messages are known
already. All of it is built-in expressions: Spark's bitmap aggregates make and
merge the filters. Runs are merged, and buckets multiplied with the number of ids,
when there are many (`MOST_RUNS`) or filters fill up.

An append writes the archive and the index, and no store does both at once. It
therefore notes that it has begun; an append that finds such a note of one that
died, or an archive without an index, makes the index anew from the archive.
Messages without an id are always appended. One append at a time: one that was
begun while another was at work fails (`Overtaken`) before its ids count.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chirpstat.functions.parse import parse_tweets
from chirpstat.session import land, list_names, observed_write, path_exists, remove_path, scratch_path
from chirpstat.sources.io import dedupe_by_id
from chirpstat.sources.versions import Record, Versions

# --- Fixed value: bits of the bitmaps that Spark's bitmap aggregates make -------
FILTER_BITS = 32_768

#: Bits an id sets, and ids a filter is made for (13 bits an id).
HASHES = 7
IDS_PER_BUCKET = 2_500

#: Runs after which they are merged into one.
MOST_RUNS = 8


def bucket_of(id_: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(id_), F.lit(buckets).cast("long"))


def positions(id_: Column) -> Column:
    """The bits of an id in its bucket's filter."""
    first = F.pmod(F.shiftrightunsigned(F.xxhash64(id_), 32), F.lit(FILTER_BITS).cast("long"))
    step = F.pmod(F.xxhash64(F.lit(1), id_), F.lit(FILTER_BITS // 2).cast("long")) * 2 + 1
    return F.array(*[(first + j * step) % FILTER_BITS for j in range(HASHES)])


def may_hold(bits: Column, places: Column) -> Column:
    """Whether all these bits of a filter are set."""

    def is_set(p: Column) -> Column:
        byte = F.conv(F.hex(F.substring(bits, (F.floor(p / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.floor(byte / F.pow(F.lit(2), p % 8)).cast("int") % 2 == 1

    return F.forall(places, is_set)


class ArchiveIndex:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.records = Versions(spark, path)

    # What the last record says
    def _last(self) -> Record | None:
        return self.records.last()

    @staticmethod
    def _runs(record: Record | None) -> list[str]:
        return list(record.notes["runs"]) if record else []

    def _part(self, run: str, part: str) -> str:
        return f"{self.records.folder(run)}/{part}"

    def _read(self, runs: list[str], part: str) -> DataFrame:
        return self.spark.read.parquet(*[self._part(r, part) for r in runs])

    def ids(self) -> DataFrame | None:
        """bucket and id of every archived message that has one (None: no index yet)."""
        runs = self._runs(self._last())
        return self._read(runs, "ids") if runs else None

    def known(self, ids: DataFrame) -> DataFrame:
        """Which of `ids` (one column id, each once, none null) are in the archive. Lands those that pass the filters."""
        record = self._last()
        runs = self._runs(record)
        if not runs:
            return ids.limit(0)
        filters = self._read(runs, "blooms").groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        placed = ids.select("id", bucket_of(F.col("id"), record.notes["buckets"]).alias("bucket"), positions(F.col("id")).alias("places"))
        passed = placed.join(filters, "bucket").where(may_hold(F.col("bits"), F.col("places"))).select("bucket", "id")
        return self._read(runs, "ids").join(land(passed, self.spark, "passed-filter"), ["bucket", "id"]).select("id")

    def _write_run(self, ids: DataFrame, buckets: int) -> tuple[str, int]:
        """Write a run of `ids` (column id, each once); its name and number of ids."""
        run = self.records.new_version("run")
        path = self._part(run, "ids")
        placed = ids.select(bucket_of(F.col("id"), buckets).alias("bucket"), "id")
        placed = placed.repartition("bucket").sortWithinPartitions("bucket", "id")
        count = observed_write(placed, lambda rows: rows.write.parquet(path))["rows"]
        bits = self.spark.read.schema(placed.schema).parquet(path)
        bits = bits.select("bucket", F.explode(positions(F.col("id"))).alias("p"))
        bits.groupBy("bucket").agg(F.bitmap_construct_agg("p").alias("bits")).write.parquet(self._part(run, "blooms"))
        return run, count

    def _remade(self, ids: DataFrame, count: int) -> dict:
        """Notes of an index that is one run of `ids`, with buckets to match."""
        buckets = max(16, math.ceil(count / IDS_PER_BUCKET))
        run, count = self._write_run(ids, buckets)
        return {"runs": [run], "buckets": buckets, "ids": count}

    def make_ready(self, archive: str, fmt: str = "parquet") -> None:
        """Make the index anew from the archive if there is none, or if an append died."""
        last = self._last()
        if last is not None and not last.notes.get("begun"):
            return
        if path_exists(self.spark, archive):
            messages = self.spark.read.format(fmt).load(archive)
            ids = land(parse_tweets(messages, fields=("id",)).where("id IS NOT NULL").distinct(), self.spark, "archived-ids")
            notes = self._remade(ids, ids.count())
        else:
            notes = {"runs": [], "buckets": 16, "ids": 0}
        self.records.point_at(None, last, follow=True, **notes)
        self._clean()

    def begin(self) -> Record:
        """Note that an append has begun."""
        last = self._last()
        notes = {k: last.notes[k] for k in ("runs", "buckets", "ids")}
        return self.records.point_at(None, last, follow=True, begun=True, **notes)

    def finish(self, begun: Record, ids: DataFrame) -> None:
        """Add the ids of the append that `begun` noted."""
        notes = {k: begun.notes[k] for k in ("runs", "buckets", "ids")}
        if notes["ids"]:
            run, count = self._write_run(ids, notes["buckets"])
            if count:
                notes = {**notes, "runs": [*notes["runs"], run], "ids": notes["ids"] + count}
        else:  # the first ids say how many buckets to begin with
            ids = land(ids, self.spark, "first-ids")
            count = ids.count()
            if count:
                notes = self._remade(ids, count)
        if len(notes["runs"]) > MOST_RUNS or notes["ids"] > 2 * IDS_PER_BUCKET * notes["buckets"]:
            notes = self._remade(self._read(notes["runs"], "ids").select("id"), notes["ids"])
        self.records.point_at(None, begun, follow=True, **notes)
        self._clean()

    def _clean(self) -> None:
        """Remove the runs that do not count (one append at a time writes any) and old records."""
        used = set(self._runs(self._last()))
        for name in list_names(self.spark, self.records.path):
            if name.startswith("run-") and name not in used:
                remove_path(self.spark, self.records.folder(name))
        self.records.prune_records(keep=2)


def append_new(raw: DataFrame, archive: str, index: str | None = None, fmt: str = "parquet", **options: str) -> dict[str, int]:
    """Append the messages whose id the archive does not hold yet; of several with one id in
    `raw`, the first (`dedupe_by_id`). Messages without an id are all appended.

    The input is read and parsed once and landed in the shared folder for the
    length of the append. Returns how many messages were appended (`rows`) and
    how many of them have an id (`ids`).
    """
    spark = raw.sparkSession
    own = ArchiveIndex(spark, index or f"{archive.rstrip('/')}-ids")
    own.make_ready(archive, fmt)
    path = scratch_path(spark, "append")
    try:
        incoming = land(dedupe_by_id(raw, id_as="_id").select("value", "_id"), spark, "append", path)
        with_id = incoming.where("_id IS NOT NULL")
        known = land(own.known(with_id.select(F.col("_id").alias("id"))).withColumnRenamed("id", "_id"), spark, "known-ids")
        new = with_id.join(known, "_id", "left_anti").select("value", "_id")
        fresh = new.unionByName(incoming.where("_id IS NULL"))
        begun = own.begin()
        counts = observed_write(
            fresh, lambda rows: rows.select("value").write.format(fmt).mode("append").options(**options).save(archive), ids=F.count("_id")
        )
        own.finish(begun, new.select(F.col("_id").alias("id")))
        return counts
    finally:
        remove_path(spark, path)
