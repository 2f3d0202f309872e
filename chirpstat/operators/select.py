"""Row selections: one user's timeline and a text search, newest first, at most n.

Up to MERGED_ROWS rows, a filter and a top-n (TakeOrderedAndProject): every task
keeps at most n rows, and one task merges them. For a larger n that merge would
not scale; there the matching rows are landed in range-sorted parts, and only as
many parts are read as hold the newest n (see `newest`). Both give the same
rows. Over a columnar snapshot the equality and language predicates are pushed
into the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chirpstat.operators.quality import valid_tweets
from chirpstat.session import land, land_counted, remove_path, scratch_path

# --- Fixed values: stand-in for the API-side retweet test ---------------------
# The tweet schema has no retweet flag; a retweet's text starts with this.
RETWEET_PREFIX = "RT @"

SELECT_COLUMNS = ("id", "created_at", "text")


#: Largest n that one task merges.
MERGED_ROWS = 10_000


def _newest_order() -> list[Column]:
    return [F.col("created_at").desc_nulls_last(), F.col("id").desc_nulls_last()]


def newest(df: DataFrame, n: int, columns: Sequence[str], merged_rows: int = MERGED_ROWS) -> DataFrame:
    """The newest n rows (ties broken by id), newest first, `columns` only.

    Up to `merged_rows`, one task merges them. Beyond, the rows of `df` are landed
    once, dealt by ranges of (time, id) and sorted in each part; the parts are
    counted, and the result is all rows of the leading parts and the first rows
    of the part in which the n-th lies, in order: sorted by their place, which a
    range exchange deals into parts again. No task holds more than a part, and the
    driver gets one count per part.
    """
    if n <= merged_rows:
        return df.orderBy(*_newest_order()).select(*columns).limit(n)
    keys = list(dict.fromkeys([*columns, "created_at", "id"]))
    parts = df.select(*keys).repartitionByRange(*_newest_order()).sortWithinPartitions(*_newest_order())
    spark = df.sparkSession
    # the upper bits of this number are the part, the lower ones the place in it
    landed = land(parts.withColumn("_place", F.monotonically_increasing_id()), spark, "newest")
    part = F.shiftright("_place", 33)
    left = n
    for r in landed.groupBy(part.alias("part")).count().orderBy("part").collect():
        if r["count"] >= left:
            last = (r["part"] << 33) + left
            return landed.where(F.col("_place") < F.lit(last)).orderBy("_place").select(*columns)
        left -= r["count"]
    return landed.orderBy("_place").select(*columns)


# Rows per file of the author-ordered table: files (and their row-group
# statistics) stay a few hundred MB however few range partitions are used.
ROWS_PER_FILE = 5_000_000


def write_by_author(
    tweets: DataFrame, path: str, partitions: int | None = None, rows_per_file: int = ROWS_PER_FILE
) -> int:
    """Write typed tweets as Parquet laid out for timeline lookups; returns how many.

    Valid rows (with an id; the others, unparsable messages among them, would
    share one key) are range-partitioned and sorted by (author_username,
    created_at, id), so every file and row group covers a narrow, ordered slice
    of authors. A later `user_timeline` over this table pushes
    `author_username = u` into the Parquet scan and skips row groups by their
    min/max statistics instead of reading every tweet. The time and id keys
    let the range partitioner split an author holding a third of all rows
    over many files instead of one task.

    The range bounds are sampled from the input, so the tweets are landed
    first: the messages behind them are read and parsed once.

    `partitions` (default: `spark.sql.shuffle.partitions`) should be sized to
    the data, about one per few hundred MB; `rows_per_file` caps each file
    either way (a partition's consecutive files keep their order).
    """
    keys = ["author_username", "created_at", "id"]
    spark = tweets.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    staged = scratch_path(spark, "by-author")
    try:
        landed, found = land_counted(valid_tweets(tweets), spark, "by-author", staged)
        (
            landed.repartitionByRange(n, *keys)
            .sortWithinPartitions(*keys)
            .write.mode("overwrite")
            .option("maxRecordsPerFile", rows_per_file)
            .parquet(path)
        )
        return found["rows"]
    finally:
        remove_path(spark, staged)


def user_timeline(
    df: DataFrame, username: str, n: int = 10, columns: tuple[str, ...] = SELECT_COLUMNS
) -> DataFrame:
    """The user's newest n tweets (ties broken by id, newest first)."""
    rows = df.filter(F.col("author_username") == F.lit(username))
    return newest(rows, n, columns)


def text_search(
    df: DataFrame,
    phrase: str,
    lang: str | None = None,
    exclude_retweets: bool = True,
    n: int = 10,
    columns: tuple[str, ...] = SELECT_COLUMNS,
    ignore_case: bool = False,
) -> DataFrame:
    """Newest n tweets whose text contains `phrase` (case-sensitive by default).

    `lang` keeps one language; `exclude_retweets` drops texts that start with
    the retweet prefix; `ignore_case` matches the phrase in any letter case.
    """
    if ignore_case:
        cond = F.lower(F.col("text")).contains(F.lower(F.lit(phrase)))
    else:
        cond = F.col("text").contains(F.lit(phrase))
    if lang is not None:
        cond = cond & (F.col("lang") == F.lit(lang))
    if exclude_retweets:
        cond = cond & ~F.col("text").startswith(F.lit(RETWEET_PREFIX))
    return newest(df.filter(cond), n, columns)
