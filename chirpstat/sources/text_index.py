"""Tweets with a trigram index of their texts, for searches that read a part of them.

    <path>/run-<id>/tweets/    tweets, newest last, numbered in blocks of `block_rows`
    <path>/run-<id>/grams/     (gram, block): the blocks in which a text has a trigram
    <path>/_records            which runs count (sources/versions.py)

A phrase can only be in a block that has all its trigrams. A search reads the
phrase's trigrams from the index (sorted by gram, so the filter skips the rest of
it), counts them per block, and reads the tweets of the blocks that have all of
them: their numbers become ranges that the Parquet scan checks against the
statistics of row groups and pages. The phrase is then looked for in the texts
themselves (`text_search`), so the result is the one of a full scan.

Trigrams are taken of lower-case texts, for searches in either letter case. A
phrase of under three characters has none, and one that is in more than
`max_blocks` blocks gains nothing: both read all tweets. New tweets are added as a
run of their own; `compact` writes all runs into one. Each run is written first and
named by a record last, so a writer that dies leaves the index as it was. Null texts
are kept and found by no phrase; tweets without an id are left out, as in every
selection.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chirpstat.operators.quality import valid_tweets
from chirpstat.operators.select import SELECT_COLUMNS, text_search
from chirpstat.session import land, land_counted, remove_path, scratch_path
from chirpstat.sources.versions import Overtaken, Record, Versions

#: Tweets a block (a power of two). Smaller blocks are told apart better; the index
#: has at most one row for each trigram and block.
BLOCK_ROWS = 4096
#: Row groups, the unit that a scan skips, are kept small.
ROW_GROUP_BYTES = 16 << 20
#: Blocks whose numbers the driver takes, and ranges that they are put into.
MAX_BLOCKS = 10_000
MAX_RANGES = 64
GRAM = 3

Run = dict  # folder, rows


def folded(text: Column) -> Column:
    """Lower case in which a part of a text is folded as in the whole (a final sigma is not told apart)."""
    return F.translate(F.lower(text), "ς", "σ")


def trigrams(text: Column) -> Column:
    """The distinct trigrams of a text's folded form; none for texts under three characters."""
    size = F.length(text) - (GRAM - 1)
    starts = F.when(size > 0, F.sequence(F.lit(1), size)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda at: F.substr(text, at, F.lit(GRAM))))


def ranges(blocks: list[int], most: int = MAX_RANGES) -> list[tuple[int, int]]:
    """Block numbers as at most `most` ranges (both ends included) that cover them, joined over the smallest gaps."""
    blocks = sorted(set(blocks))
    gaps = sorted(((b - a, k) for k, (a, b) in enumerate(zip(blocks, blocks[1:]), 1) if b - a > 1), reverse=True)
    cuts = [0, *sorted(k for _, k in gaps[: most - 1]), len(blocks)]
    return [(blocks[lo], blocks[hi - 1]) for lo, hi in zip(cuts, cuts[1:]) if lo < hi]


class TextIndex:
    def __init__(self, spark: SparkSession, path: str, block_rows: int = BLOCK_ROWS, row_group_bytes: int = ROW_GROUP_BYTES):
        if block_rows < 1 or block_rows & (block_rows - 1):
            raise ValueError("block_rows must be a power of two")
        self.spark, self.block_rows, self.row_group_bytes = spark, block_rows, row_group_bytes
        self.versions = Versions(spark, path)

    def runs(self, record: Record | None = None) -> list[Run]:
        record = record or self.versions.last()
        return list(record.notes["runs"]) if record else []

    def _folder(self, run: Run, part: str) -> str:
        return f"{self.versions.folder(run['folder'])}/{part}"

    def _write(self, tweets: DataFrame) -> Run:
        run = {"folder": self.versions.new_version("run")}
        keys = ["created_at", "id"]
        staged = [scratch_path(self.spark, "text-index") for _ in range(2)]
        try:
            # landed, as the bounds of a range exchange are sampled from its input
            landed, found = land_counted(tweets, self.spark, "text-index", staged[0])
            placed = landed.repartitionByRange(*keys).sortWithinPartitions(*keys)
            # the upper bits of this number are the part, so no block lies in two parts
            block = F.shiftright(F.monotonically_increasing_id(), self.block_rows.bit_length() - 1)
            placed.withColumn("_block", block).write.option("parquet.block.size", self.row_group_bytes).parquet(self._folder(run, "tweets"))
            texts = self.spark.read.parquet(self._folder(run, "tweets")).select("_block", folded(F.col("text")).alias("text"))
            # texts of a block lie together, so most repeats of a trigram go before the shuffle
            grams = texts.select(F.explode(trigrams(F.col("text"))).alias("gram"), F.col("_block").alias("block")).distinct()
            grams = land(grams, self.spark, "text-index", staged[1])
            # block numbers deal a trigram that is everywhere to several tasks
            grams.repartitionByRange("gram", "block").sortWithinPartitions("gram", "block").write.option(
                "parquet.block.size", self.row_group_bytes
            ).parquet(self._folder(run, "grams"))
        finally:
            for path in staged:
                remove_path(self.spark, path)
        return run | {"rows": found["rows"]}

    def add(self, tweets: DataFrame) -> int:
        """Add typed tweets (those with an id) as a run; returns how many."""
        run = self._write(valid_tweets(tweets))
        if not run["rows"]:
            remove_path(self.spark, self.versions.folder(run["folder"]))
            return 0
        while True:
            last = self.versions.last()
            try:
                self.versions.point_at(None, last, follow=True, runs=[*self.runs(last), run])
                return run["rows"]
            except Overtaken:  # another writer added a run: this one is added to that
                continue

    def compact(self) -> None:
        """Write all runs into one. Fails (Overtaken) if another writer changes the index meanwhile."""
        last = self.versions.last()
        if len(self.runs(last)) < 2:
            return
        run = self._write(self._read(self.runs(last)).drop("_block"))
        try:
            self.versions.point_at(None, last, follow=True, runs=[run])
        except Overtaken:
            remove_path(self.spark, self.versions.folder(run["folder"]))
            raise
        # runs that only records older than the last two name
        old = self.versions.prune_records(keep=2)
        used = {r["folder"] for record in self.versions.records() for r in self.runs(record)}
        for folder in {r["folder"] for record in old for r in self.runs(record)} - used:
            remove_path(self.spark, self.versions.folder(folder))

    def _read(self, runs: list[Run], part: str = "tweets") -> DataFrame:
        return self.spark.read.parquet(*[self._folder(r, part) for r in runs])

    def read(self) -> DataFrame | None:
        """All tweets (None: there are none yet)."""
        runs = self.runs()
        return self._read(runs).drop("_block") if runs else None

    def blocks(self, run: Run, phrase: str, max_blocks: int = MAX_BLOCKS) -> list[int] | None:
        """Numbers of the run's blocks that have all trigrams of the phrase; None if that excludes too little."""
        grams = self.spark.range(1).select(trigrams(folded(F.lit(phrase))).alias("grams")).first()["grams"]
        if not grams:
            return None
        postings = self._read([run], "grams").where(F.col("gram").isin(grams))
        full = postings.groupBy("block").count().where(F.col("count") == len(grams))
        found = [r["block"] for r in full.select("block").limit(max_blocks + 1).collect()]
        return None if len(found) > max_blocks else found

    def candidates(self, phrase: str, max_blocks: int = MAX_BLOCKS) -> DataFrame | None:
        """The tweets of all blocks that may hold the phrase (None: there are no tweets yet)."""
        parts = []
        for run in self.runs():
            tweets = self._read([run])
            found = self.blocks(run, phrase, max_blocks)
            if found is not None:
                near = [F.col("_block").between(lo, hi) for lo, hi in ranges(found)]
                tweets = tweets.where(reduce(Column.__or__, near) if near else F.lit(False))
            parts.append(tweets.drop("_block"))
        return reduce(DataFrame.unionByName, parts) if parts else None

    def search(
        self,
        phrase: str,
        lang: str | None = None,
        exclude_retweets: bool = True,
        n: int = 10,
        columns: tuple[str, ...] = SELECT_COLUMNS,
        ignore_case: bool = False,
        max_blocks: int = MAX_BLOCKS,
    ) -> DataFrame:
        """`text_search` over the index: the same rows, from the blocks that may hold the phrase."""
        tweets = self.candidates(phrase, max_blocks)
        if tweets is None:
            raise ValueError(f"{self.versions.path} has no tweets yet")
        return text_search(tweets, phrase, lang, exclude_retweets, n, columns, ignore_case)
