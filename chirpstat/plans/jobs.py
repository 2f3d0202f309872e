"""The two batch jobs: user analysis (five results) and daily trend (one result).

Shape of the user-analysis plan, chosen for very large topics:

1. parse the messages once and land the typed tweets as Parquet in the shared
   checkpoint folder (one snapshot for all five results, lineage cut there);
2. one aggregate per author over that snapshot carries every per-author
   measure; it is tiny next to the tweets and is landed too;
3. top, famous and low-follower results are projections + sorts of the
   per-author table, the fame distribution is a sum over it, and only the
   per-tweet flag result re-reads the tweet snapshot.

So the tweets are parsed once, scanned twice in full (flag write, aggregate) and
shuffled once, instead of being re-read and re-parsed for every action. All
records and those without an id are counted while the tweets are landed, and the
rows of each result while it is written (`observe`), so no count is a pass of its
own. The results go to their sink unordered, as a table keeps no order. The snapshot is removed from the shared
folder when the job ends, whether it succeeds or fails.

The daily job parses only `created_at`, the retweet count and `id`; one per-day
aggregate (totals over all rows and over rows with an id) is landed, and yields
the invalid-record log line and either form of the result.
"""

from __future__ import annotations

import functools
import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chirpstat.functions.parse import day_of, encode_json, parse_tweets
from chirpstat.functions.schema import (
    DAILY_FIELDS,
    DAY,
    FAME_POINT,
    LOW_FOLLOWER_POINT,
    USER_ANALYSIS_TARGETS,
)
from chirpstat.operators import analyses as A
from chirpstat.operators.quality import count_invalid, valid_tweets
from chirpstat.session import land, land_counted, remove_path, scratch_path
from chirpstat.sources.ledger import Ledger, Topic
from chirpstat.sources.io import Sink, archive_raw, publish, write_result

LOG = logging.getLogger(__name__)


@dataclass
class UserAnalysis:
    top_tweeters: DataFrame
    famous_top_tweeters: DataFrame
    is_famous_tweeters: DataFrame
    fame_distribution: DataFrame
    low_follower_activity: DataFrame
    counts: DataFrame
    snapshot_paths: tuple[str, ...] = ()

    def by_target(self) -> dict[str, DataFrame]:
        return dict(
            zip(
                USER_ANALYSIS_TARGETS,
                (
                    self.top_tweeters,
                    self.famous_top_tweeters,
                    self.is_famous_tweeters,
                    self.fame_distribution,
                    self.low_follower_activity,
                ),
            )
        )


#: How the per-author results are ordered where they are shown.
_ORDERS = {
    "top_tweeters": A.top_tweeters_order,
    "famous_top_tweeters": A.famous_order,
    "low_follower_activity_tweeters": A.low_follower_order,
}


def plan_user_analysis(
    spark: SparkSession,
    raw: DataFrame,
    fame_point: int = FAME_POINT,
    low_point: int = LOW_FOLLOWER_POINT,
    snapshot: bool = True,
) -> UserAnalysis:
    """Build the five user-analysis results over one snapshot of `raw`.

    With `snapshot=True` this is not a plan alone: it runs two writes, of the
    parsed tweets and of the per-author table, to the shared folder; every
    result is then a cheap plan over those files, and the caller removes
    `snapshot_paths`. If a write fails, what was written is removed.
    """
    paths: tuple[str, ...] = ()
    tweets = parse_tweets(raw)
    try:
        if snapshot:
            paths += (scratch_path(spark, "tweets"),)
            tweets, found = land_counted(tweets, spark, "tweets", paths[-1], invalid=F.count_if(F.col("id").isNull()))
        valid = valid_tweets(tweets)
        stats = A.author_stats(valid, fame_point, low_point)
        if snapshot:
            paths += (scratch_path(spark, "author_stats"),)
            stats = land(stats, spark, "author_stats", paths[-1])
    except Exception:
        for path in paths:
            remove_path(spark, path)
        raise
    return UserAnalysis(
        top_tweeters=A.top_tweeters_from_stats(stats),
        famous_top_tweeters=A.famous_top_tweeters_from_stats(stats),
        is_famous_tweeters=A.add_is_famous(valid, fame_point),
        fame_distribution=A.fame_distribution_from_stats(stats),
        low_follower_activity=A.low_follower_activity_from_stats(stats),
        counts=_known_counts(spark, found) if snapshot else count_invalid(tweets),
        snapshot_paths=paths,
    )


def _known_counts(spark: SparkSession, found: dict[str, int]) -> DataFrame:
    """`count_invalid`'s row from counts that are known already."""
    return spark.range(1).select(F.lit(found["rows"]).cast("long").alias("total"), F.lit(found["invalid"]).cast("long").alias("invalid"))


def run_user_analysis(
    spark: SparkSession,
    raw: DataFrame,
    sink: Sink | None,
    fame_point: int = FAME_POINT,
    low_point: int = LOW_FOLLOWER_POINT,
    keep_snapshot: bool = False,
    preview: int = 0,
) -> dict[str, bool]:
    """Land the tweets and the per-author table, then write each of the five
    results (and show `preview` rows of each); a failing write fails the job.

    The landed tables are removed from the shared folder at the end, also
    after a failure, unless `keep_snapshot` is set.
    """
    plan = plan_user_analysis(spark, raw, fame_point, low_point)
    try:
        counts = plan.counts.first()
        LOG.info("%d records, %d without an id (left out)", counts["total"], counts["invalid"])
        written = {}
        for name, df in plan.by_target().items():
            if preview:
                order = _ORDERS.get(name)
                A.top_n(df.orderBy(*order()) if order else df, preview).show(truncate=False)
            written[name] = sink is not None and write_result(df, name, sink)
        return written
    finally:
        if not keep_snapshot:
            for path in plan.snapshot_paths:
                remove_path(spark, path)


def plan_daily_trend(spark: SparkSession, raw: DataFrame, drop_invalid: bool = False) -> DataFrame:
    """Daily totals. By default rows without an id are counted too.

    The one aggregate needs only `created_at` and the retweet count, so the
    JSON parse is limited to those fields (and `id` when invalid rows are
    dropped).
    """
    tweets = parse_tweets(raw, fields=DAILY_FIELDS + (("id",) if drop_invalid else ()))
    if drop_invalid:
        tweets = valid_tweets(tweets)
    return A.daily_trends(tweets)


def run_daily_trend(
    spark: SparkSession, raw: DataFrame, sink: Sink | None = None, drop_invalid: bool = False,
    name: str = "daily_trend", preview: int = 0,
) -> DataFrame:
    """Compute the daily trend, log how many records lack an id, write it when a
    sink is given. Returns the result.

    One scan: a per-day table holding totals over all rows and over rows with
    an id (`daily_stats`, one row per day) is landed in the shared folder and
    feeds the log line, the preview (`preview` rows shown), the emptiness test,
    the write and the returned result, so the topic is parsed once and all of
    them tell the same. The table stays, as the result is read from it.
    """
    stats = land(A.daily_stats(parse_tweets(raw, fields=DAILY_FIELDS + ("id",))), spark, "daily_stats")
    totals = stats.agg(F.sum("rows").alias("rows"), F.sum("valid_rows").alias("valid")).first()
    if totals is not None and totals["rows"]:
        invalid = totals["rows"] - totals["valid"]
        if invalid:
            LOG.info(
                "%d of %d records have no id; they are %s", invalid, totals["rows"],
                "left out" if drop_invalid else "counted in the daily totals",
            )
    result = A.daily_trends_from_stats(stats, drop_invalid)
    if preview:
        result.show(preview, truncate=False)
    if sink is not None:
        write_result(A.daily_trends_from_stats(stats, drop_invalid, sort=False), name, sink)
    return result


#: Runs whose per-day totals are kept apart before they are merged.
MOST_PARTS = 16


def run_daily_trend_since(
    spark: SparkSession, topic: Topic, ledger_path: str, sink: Sink | None = None, drop_invalid: bool = False,
    name: str = "daily_trend", most_parts: int = MOST_PARTS,
) -> DataFrame:
    """The daily trend over all runs, reading only the messages that are new since the last one.

    One scan of the new messages: one aggregate per day and topic partition gives
    the run's totals and the end of what it has read. Both are recorded in the
    ledger at `ledger_path` (sources/ledger.py); the result is the sum of all
    runs' totals, a few rows a run, which are merged once there are more than
    `most_parts`. A run that dies is not recorded, and the next one reads its
    messages. Returns the result; writes it when a sink is given.
    """
    ledger = Ledger(spark, ledger_path)
    before = ledger.last()
    notes = before.record.notes if before else {"parts": [], "merged": []}
    tweets = parse_tweets(topic(before.end if before else {}, None), fields=DAILY_FIELDS + ("id",), keep=("partition", "offset"))
    totals = tweets.groupBy(day_of("created_at").alias(DAY), "partition").agg(*A.daily_measures(), F.max("offset").alias("last_offset"))
    part = ledger.versions.new_version("part")
    kept = land(totals, spark, part, ledger.versions.folder(part))
    ends = kept.groupBy("partition").agg(F.max("last_offset").alias("last")).collect()  # a row a topic partition
    parts, merged = [*notes["parts"], part], []
    if not ends and notes["parts"]:  # nothing new
        remove_path(spark, ledger.versions.folder(part))
        parts = notes["parts"]
    if len(parts) > most_parts:
        parts, merged = [ledger.versions.new_version("part")], parts
        land(_sum_parts(spark, ledger, merged), spark, parts[0], ledger.versions.folder(parts[0]))
    ledger.add(before, {r["partition"]: r["last"] + 1 for r in ends}, None, parts=parts, merged=merged)
    for old in notes["merged"]:  # a run after they were merged, nothing reads them any more
        remove_path(spark, ledger.versions.folder(old))
    stats = _sum_parts(spark, ledger, parts)
    if sink is not None:
        write_result(A.daily_trends_from_stats(stats, drop_invalid, sort=False), name, sink)
    return A.daily_trends_from_stats(stats, drop_invalid)


def _sum_parts(spark: SparkSession, ledger: Ledger, parts: list[str]) -> DataFrame:
    """Per day, the measures summed over the runs' parts."""
    measures = ("rows", "retweets", "valid_rows", "valid_retweets")
    rows = [spark.read.parquet(ledger.versions.folder(p)).select(DAY, *measures) for p in parts]
    return functools.reduce(DataFrame.unionByName, rows).groupBy(DAY).agg(*[F.sum(c).alias(c) for c in measures])


def deliver(
    spark: SparkSession, selected: DataFrame, archive_path: str | None = None, archive_fmt: str = "parquet",
    publish_path: str | None = None, bootstrap_servers: str | None = None, topic: str | None = None,
    archive_options: dict[str, str] | None = None,
) -> DataFrame:
    """Encode selected tweets (all their columns), archive them and publish them.

    The selection runs once: its messages are landed in the shared folder and
    both writes read them there. Returns the landed messages.
    """
    messages = land(encode_json(selected), spark, "selected")
    if archive_path is not None:
        archive_raw(messages, archive_path, fmt=archive_fmt, **(archive_options or {}))
    if publish_path is not None or topic is not None:
        publish(messages, bootstrap_servers, topic, path=publish_path)
    return messages
