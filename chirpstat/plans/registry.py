"""Registered queries over the driver's tables, with their DuckDB oracles.

Every query reads the whole `events` table through the topic-shaped adapter
(sources/fixtures.py), so its work grows with the table, and runs the real
message path: JSON bytes -> from_json -> typed tweets -> analysis. Each
oracle is the same question asked of the DuckDB view `T` (FIXTURES.md).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chirpstat.functions.parse import encode_json, flatten_metrics, parse_tweets
from chirpstat.functions.schema import (
    AUTHOR_FIELDS,
    AUTHOR_KEYS,
    FAME_FIELDS,
    FOLLOWER_FIELDS,
    RAW_MESSAGE_SCHEMA,
    SEARCH_FIELDS,
    TIMELINE_FIELDS,
    TWEET_SCHEMA,
    USER_ANALYSIS_TARGETS,
)
from chirpstat.operators import analyses as A
from chirpstat.operators.quality import count_invalid, valid_tweets
from chirpstat.operators.select import text_search, user_timeline, write_by_author
from chirpstat.plans.jobs import deliver, plan_daily_trend, run_daily_trend, run_daily_trend_since, run_user_analysis
from chirpstat.session import path_exists, scratch_path
from chirpstat.sources.fixtures import (
    TWEETS_VIEW_SQL,
    event_topic,
    read_event_messages,
    read_event_messages_stream,
)
from chirpstat.sources.archive_index import append_new
from chirpstat.sources.author_table import AuthorTable
from chirpstat.sources.io import Sink, archive_raw, publish, read_messages, read_result, write_result
from chirpstat.sources.ledger import messages_since
from chirpstat.sources.text_index import TextIndex
from chirpstat.streaming import stream as S

# --- Fixed values: parameters of the registered selections --------------------
TIMELINE_USER = "user_7"
SEARCH_PHRASE = "click"
SEARCH_LANG = "tr"
TOP_N = 10
LARGE_N = 100_000

Query = Callable[[SparkSession, str], DataFrame]


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_event_messages(spark, sf_dir)


def _tweets(spark: SparkSession, sf_dir: str, fields=None) -> DataFrame:
    return parse_tweets(_raw(spark, sf_dir), fields=fields)


def _valid(spark: SparkSession, sf_dir: str, fields=None) -> DataFrame:
    return valid_tweets(_tweets(spark, sf_dir, fields))


def q_parse_tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_metrics(_tweets(spark, sf_dir))


def q_count_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_invalid(_tweets(spark, sf_dir, ("id",)))


def q_top_tweeters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.top_tweeters(_valid(spark, sf_dir, AUTHOR_FIELDS))


def q_top_tweeters_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.top_n(A.top_tweeters(_valid(spark, sf_dir, AUTHOR_FIELDS)), TOP_N)


def q_famous_top_tweeters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.famous_top_tweeters(_valid(spark, sf_dir, FOLLOWER_FIELDS))


def q_famous_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.top_n(A.famous_top_tweeters(_valid(spark, sf_dir, FOLLOWER_FIELDS)), TOP_N)


def q_is_famous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_metrics(A.add_is_famous(_valid(spark, sf_dir)))


def q_fame_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.fame_distribution(A.add_is_famous(_valid(spark, sf_dir, FAME_FIELDS)))


def q_low_follower_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.low_follower_activity(_valid(spark, sf_dir, FOLLOWER_FIELDS))


def q_low_follower_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.top_n(A.low_follower_activity(_valid(spark, sf_dir, FOLLOWER_FIELDS)), TOP_N)


def q_daily_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_daily_trend(spark, _raw(spark, sf_dir))


def q_daily_trend_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.top_n(plan_daily_trend(spark, _raw(spark, sf_dir)), TOP_N)


def q_daily_trend_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_daily_trend(spark, _raw(spark, sf_dir), drop_invalid=True)


def q_user_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_timeline(_valid(spark, sf_dir, TIMELINE_FIELDS), TIMELINE_USER, TOP_N)


def q_text_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_search(_valid(spark, sf_dir, SEARCH_FIELDS), SEARCH_PHRASE, SEARCH_LANG, True, TOP_N)


def q_encode_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed tweets -> JSON messages -> parsed again: the same rows come back."""
    return flatten_metrics(parse_tweets(encode_json(_tweets(spark, sf_dir))))


def _later_copies(raw: DataFrame) -> DataFrame:
    """The same messages sent again with another text, at later offsets."""
    changed = F.regexp_replace(F.col("value").cast("string"), '("text":"[^"]*)"', '$1 again"').cast("binary")
    return raw.withColumn("value", changed).withColumn("offset", F.col("offset") + 1_000_000_000_000)


def q_archive_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message sent twice with different texts, archived with id
    de-duplication, read back: the first message of every id, all without one."""
    raw = _raw(spark, sf_dir)
    target = scratch_path(spark, "archive-dedup")
    archive_raw(_later_copies(raw).unionByName(raw), target, dedupe=True)
    return flatten_metrics(parse_tweets(read_messages(spark, target)))


def q_archive_dedup_appends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages archived, then all again with other texts in a later append: the
    index beside the archive keeps the first message of every id, and all without one."""
    raw = _raw(spark, sf_dir)
    target = scratch_path(spark, "archive-appends")
    append_new(raw, target)
    append_new(_later_copies(raw), target)
    return flatten_metrics(parse_tweets(read_messages(spark, target)))


def q_archive_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw messages appended to the archive and read back."""
    target = scratch_path(spark, "archive")
    archive_raw(_raw(spark, sf_dir), target)
    return flatten_metrics(parse_tweets(read_messages(spark, target)))


def q_publish_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed tweets published as messages to a topic stand-in and read back."""
    target = scratch_path(spark, "published")
    publish(_tweets(spark, sf_dir), path=target)
    return flatten_metrics(parse_tweets(read_messages(spark, target)))


def _dual_path(side: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = scratch_path(spark, "dual-path")
        paths = {"archive": f"{root}/archived", "publish": f"{root}/published"}
        stream = read_event_messages_stream(spark, sf_dir)
        queries = S.start_dual_path(stream, paths["archive"], f"{root}/checkpoints", publish_path=paths["publish"], availableNow=True)
        for query in queries:
            query.awaitTermination()
        return flatten_metrics(parse_tweets(read_messages(spark, paths[side])))

    run.__name__ = f"dual_path_{side}"
    return run


# topic folder -> folder of the five results that one run of the job has written
_RESULTS: dict[str, str] = {}


def _user_analysis_results(spark: SparkSession, sf_dir: str) -> str:
    """Where run_user_analysis has written its results for this topic (one run for each state of it)."""
    topic = event_topic(spark, sf_dir)
    base = _RESULTS.get(topic)
    if base is None or not path_exists(spark, f"{base}/{USER_ANALYSIS_TARGETS[-1]}/_SUCCESS"):
        base = scratch_path(spark, "user-analysis")
        run_user_analysis(spark, _raw(spark, sf_dir), Sink(base=base, on_empty="overwrite"))
        _RESULTS[topic] = base
    return base


def _job(target: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return flatten_metrics(spark.read.parquet(f"{_user_analysis_results(spark, sf_dir)}/{target}"))

    run.__name__ = f"job_{target}"
    return run


def _daily_job(drop_invalid: bool) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = scratch_path(spark, "daily-trend")
        run_daily_trend(spark, _raw(spark, sf_dir), Sink(base=base, on_empty="overwrite"), drop_invalid)
        return spark.read.parquet(f"{base}/daily_trend")

    return run


def q_timeline_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The timeline with an n above the table's matches: no one-task merge."""
    return user_timeline(_valid(spark, sf_dir, TIMELINE_FIELDS), TIMELINE_USER, LARGE_N)


def q_search_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_search(_valid(spark, sf_dir, SEARCH_FIELDS), SEARCH_PHRASE, SEARCH_LANG, True, LARGE_N)


def _text_search_indexed(n: int) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The search through the trigram index of all tweets, added in two runs."""
        index = TextIndex(spark, scratch_path(spark, "text-index-table"))
        raw = _raw(spark, sf_dir)
        for part in range(2):
            index.add(parse_tweets(raw.where(F.pmod("offset", F.lit(2)) == part), fields=SEARCH_FIELDS))
        return index.search(SEARCH_PHRASE, SEARCH_LANG, True, n)

    return query


def q_selection_delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A search's tweets with all their columns, archived and published, read back from the topic."""
    root = scratch_path(spark, "selection")
    found = text_search(
        _valid(spark, sf_dir), SEARCH_PHRASE, SEARCH_LANG, True, LARGE_N, columns=tuple(TWEET_SCHEMA.fieldNames())
    )
    deliver(spark, found, archive_path=f"{root}/archived", publish_path=f"{root}/published")
    return flatten_metrics(parse_tweets(read_messages(spark, f"{root}/published")))


def q_timeline_by_author(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The timeline from the author-ordered table."""
    path = scratch_path(spark, "by-author-table")
    write_by_author(_tweets(spark, sf_dir, TIMELINE_FIELDS), path)
    return user_timeline(spark.read.parquet(path), TIMELINE_USER, TOP_N)


def q_timeline_by_author_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The timeline from the author-ordered table, to which the tweets were added in several runs."""
    table = AuthorTable(spark, scratch_path(spark, "by-author-runs"), fan=2)
    raw = _raw(spark, sf_dir)
    for part in range(3):
        table.add(parse_tweets(raw.where(F.pmod("offset", F.lit(3)) == part), fields=TIMELINE_FIELDS))
    return user_timeline(table.read(), TIMELINE_USER, TOP_N)


def q_job_daily_trend_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily trend over a growing topic: each run reads on from where the last one ended."""
    source, ledger = scratch_path(spark, "growing-topic"), scratch_path(spark, "ledger")
    raw = _raw(spark, sf_dir)
    middle = raw.agg((F.min("offset") + F.max("offset")) / 2).first()[0]
    for half in (raw.where(F.col("offset") < middle), raw.where(F.col("offset") >= middle)):
        half.write.mode("append").parquet(source)
        topic = messages_since(lambda: spark.read.schema(RAW_MESSAGE_SCHEMA).parquet(source))
        result = run_daily_trend_since(spark, topic, ledger)
    return result


def q_daily_trend_stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that is run twice on one checkpoint, with more messages arriving in between."""
    source, checkpoint = scratch_path(spark, "restart-topic"), scratch_path(spark, "restart-checkpoint")
    raw = _raw(spark, sf_dir)
    for half in (0, 1):
        raw.where(F.pmod("offset", F.lit(2)) == half).write.mode("append").parquet(source)
        stream = spark.readStream.schema(RAW_MESSAGE_SCHEMA).option("maxFilesPerTrigger", 4).parquet(source)
        result = S.run_complete(
            spark, S.daily_trend_stream(stream), "daily_trend_stream_restart", checkpoint, state_partitions=_cores(spark)
        )
    return result.orderBy(*A.daily_order())


def _cores(spark: SparkSession) -> int:
    """One state partition per core of the cluster (the state is one row per key)."""
    return spark.sparkContext.defaultParallelism


def q_top_tweeters_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = S.top_tweeters_stream(read_event_messages_stream(spark, sf_dir))
    return S.run_complete(
        spark, stream, "top_tweeters_stream", order=A.top_tweeters_order(), state_partitions=_cores(spark)
    )


def q_daily_trend_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = S.daily_trend_stream(read_event_messages_stream(spark, sf_dir))
    return S.run_complete(
        spark, stream, "daily_trend_stream", order=A.daily_order(), state_partitions=_cores(spark)
    )


def q_daily_trend_stream_takeover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams, each with a checkpoint of its own, one after the other on one target.

    The first reads half of the messages in many micro-batches, the second all of
    them in few: the target shows the second one's result, whatever the batch numbers.
    """
    source, target = scratch_path(spark, "takeover-topic"), scratch_path(spark, "takeover-result")
    raw = _raw(spark, sf_dir)
    raw.where(F.pmod("offset", F.lit(2)) == 0).write.parquet(source)
    many = spark.readStream.schema(RAW_MESSAGE_SCHEMA).option("maxFilesPerTrigger", 2).parquet(source)
    for stream in (many, read_event_messages_stream(spark, sf_dir)):
        checkpoint = scratch_path(spark, "takeover-checkpoint")
        result = S.run_complete(
            spark, S.daily_trend_stream(stream), "takeover", checkpoint, target, state_partitions=_cores(spark)
        )
    return result


def q_top_tweeters_stream_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Author counts as a file table that each trigger changes by the changed authors only."""
    stream = S.top_tweeters_stream(read_event_messages_stream(spark, sf_dir, files_per_trigger=4))
    return S.run_keyed(spark, stream, AUTHOR_KEYS, "top-tweeters-keyed", state_partitions=_cores(spark))


def _replaced(layout: str, results: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """A result of half of the tweets, then of all, then an empty one, which is skipped; read back."""
        sink = Sink(base=scratch_path(spark, f"{layout}-results"), layout=layout)
        valid = _valid(spark, sf_dir, FOLLOWER_FIELDS)
        for rows in (valid.where(F.pmod(F.xxhash64("id"), F.lit(2)) == 0), valid, valid.where("follower_count < -1")):
            write_result(results(rows), "result", sink)
        return read_result(spark, "result", sink)

    run.__name__ = f"{layout}_results"
    return run


QUERIES: dict[str, Query] = {
    "parse_tweets": q_parse_tweets,
    "count_invalid": q_count_invalid,
    "top_tweeters": q_top_tweeters,
    "top_tweeters_top10": q_top_tweeters_top10,
    "famous_top_tweeters": q_famous_top_tweeters,
    "famous_top10": q_famous_top10,
    "is_famous": q_is_famous,
    "fame_distribution": q_fame_distribution,
    "low_follower_activity": q_low_follower_activity,
    "low_follower_top10": q_low_follower_top10,
    "daily_trend": q_daily_trend,
    "daily_trend_top10": q_daily_trend_top10,
    "daily_trend_valid": q_daily_trend_valid,
    "user_timeline": q_user_timeline,
    "text_search": q_text_search,
    "encode_round_trip": q_encode_round_trip,
    "archive_dedup": q_archive_dedup,
    "archive_dedup_appends": q_archive_dedup_appends,
    "archive_round_trip": q_archive_round_trip,
    "publish_round_trip": q_publish_round_trip,
    "dual_path_archive": _dual_path("archive"),
    "dual_path_publish": _dual_path("publish"),
    "timeline_large": q_timeline_large,
    "search_large": q_search_large,
    "text_search_indexed": _text_search_indexed(TOP_N),
    "search_large_indexed": _text_search_indexed(LARGE_N),
    "selection_delivered": q_selection_delivered,
    "timeline_by_author": q_timeline_by_author,
    "timeline_by_author_runs": q_timeline_by_author_runs,
    "job_daily_trend_since": q_job_daily_trend_since,
    "job_top_tweeters": _job("top_tweeters"),
    "job_famous_top_tweeters": _job("famous_top_tweeters"),
    "job_is_famous_tweeters": _job("isFamous_tweeters"),
    "job_fame_distribution": _job("fame_distribution_tweeters"),
    "job_low_follower_activity": _job("low_follower_activity_tweeters"),
    "job_daily_trend": _daily_job(False),
    "job_daily_trend_valid": _daily_job(True),
    "top_tweeters_stream": q_top_tweeters_stream,
    "daily_trend_stream": q_daily_trend_stream,
    "daily_trend_stream_restart": q_daily_trend_stream_restart,
    "daily_trend_stream_takeover": q_daily_trend_stream_takeover,
    "top_tweeters_stream_keyed": q_top_tweeters_stream_keyed,
    "result_replaced_plain": _replaced("plain", A.famous_top_tweeters),
    "result_replaced_versions": _replaced("versions", A.famous_top_tweeters),
}


# --- Oracles (DuckDB over the pre-registered `events` view) --------------------

_ALL_COLUMNS = (
    "id, text, created_at, author_id, author_username, follower_count, friends_count, "
    "retweet_count, reply_count, like_count, quote_count, impression_count, lang, source"
)
_TOP = "SELECT author_id, author_username, count(id) AS tweet_sayisi FROM T WHERE id IS NOT NULL GROUP BY 1, 2"
_FAMOUS = (
    "SELECT author_id, author_username, max(follower_count) AS max_follower_count, "
    "count(id) AS tweet_sayisi FROM T WHERE id IS NOT NULL GROUP BY 1, 2"
)
_LOW = (
    "SELECT author_id, author_username, max(follower_count) AS max_follower_count, "
    "count(id) AS tweet_sayisi FROM T WHERE id IS NOT NULL AND follower_count < 100 GROUP BY 1, 2"
)
_IS_FAMOUS = f"SELECT {_ALL_COLUMNS}, coalesce(follower_count >= 100000, false) AS \"isFamous\" FROM T WHERE id IS NOT NULL"
_FAME_DIST = (
    "SELECT coalesce(follower_count >= 100000, false) AS \"isFamous\", count(*) AS \"count\" "
    "FROM T WHERE id IS NOT NULL GROUP BY 1"
)
_DAILY = (
    "SELECT date_trunc('day', created_at) AS day, count(*) AS toplam_tweet_sayisi, "
    "CAST(sum(retweet_count) AS BIGINT) AS toplam_retweet_sayisi FROM T {where} GROUP BY 1"
)
_TIMELINE = "SELECT id, created_at, text FROM T WHERE id IS NOT NULL AND author_username = 'user_7'"
_SEARCH = (
    "SELECT id, created_at, text FROM T WHERE id IS NOT NULL AND contains(text, 'click') "
    "AND lang = 'tr' AND NOT starts_with(text, 'RT @')"
)
_NEWEST = "ORDER BY created_at DESC NULLS LAST, id DESC NULLS LAST"
_AUTHOR_ORDER = "author_id ASC NULLS LAST, author_username ASC NULLS LAST"

_FIRST_OF_EACH_ID = (
    f"SELECT {_ALL_COLUMNS} FROM T UNION ALL SELECT {_ALL_COLUMNS.replace('text,', 'text || {again} AS text,', 1)} "
    "FROM T WHERE id IS NULL"
).replace("{again}", "' again'")

_BODIES = {
    "parse_tweets": f"SELECT {_ALL_COLUMNS} FROM T",
    "count_invalid": "SELECT count(*) AS total, count(*) FILTER (WHERE id IS NULL) AS invalid FROM T",
    "top_tweeters": _TOP,
    "top_tweeters_top10": f"{_TOP} ORDER BY tweet_sayisi DESC, {_AUTHOR_ORDER} LIMIT 10",
    "famous_top_tweeters": _FAMOUS,
    "famous_top10": f"{_FAMOUS} ORDER BY max_follower_count DESC NULLS LAST, {_AUTHOR_ORDER} LIMIT 10",
    "is_famous": _IS_FAMOUS,
    "fame_distribution": _FAME_DIST,
    "low_follower_activity": _LOW,
    "low_follower_top10": f"{_LOW} ORDER BY max_follower_count ASC NULLS LAST, {_AUTHOR_ORDER} LIMIT 10",
    "daily_trend": _DAILY.format(where=""),
    "daily_trend_top10": _DAILY.format(where="") + " ORDER BY day DESC NULLS LAST LIMIT 10",
    "daily_trend_valid": _DAILY.format(where="WHERE id IS NOT NULL"),
    "user_timeline": f"{_TIMELINE} {_NEWEST} LIMIT 10",
    "text_search": f"{_SEARCH} {_NEWEST} LIMIT 10",
    "timeline_large": f"{_TIMELINE} {_NEWEST} LIMIT 100000",
    "search_large": f"{_SEARCH} {_NEWEST} LIMIT 100000",
    "text_search_indexed": f"{_SEARCH} {_NEWEST} LIMIT 10",
    "search_large_indexed": f"{_SEARCH} {_NEWEST} LIMIT 100000",
    "selection_delivered": f"{_SEARCH.replace('id, created_at, text', _ALL_COLUMNS, 1)} {_NEWEST} LIMIT 100000",
    "timeline_by_author": f"{_TIMELINE} {_NEWEST} LIMIT 10",
    "archive_round_trip": f"SELECT {_ALL_COLUMNS} FROM T",
    "publish_round_trip": f"SELECT {_ALL_COLUMNS} FROM T",
    "dual_path_archive": f"SELECT {_ALL_COLUMNS} FROM T",
    "dual_path_publish": f"SELECT {_ALL_COLUMNS} FROM T",
    "encode_round_trip": f"SELECT {_ALL_COLUMNS} FROM T",
    "archive_dedup": _FIRST_OF_EACH_ID,
    "archive_dedup_appends": _FIRST_OF_EACH_ID,
    "timeline_by_author_runs": f"{_TIMELINE} {_NEWEST} LIMIT 10",
    "job_daily_trend_since": _DAILY.format(where=""),
    "job_top_tweeters": _TOP,
    "job_famous_top_tweeters": _FAMOUS,
    "job_is_famous_tweeters": _IS_FAMOUS,
    "job_fame_distribution": _FAME_DIST,
    "job_low_follower_activity": _LOW,
    "job_daily_trend": _DAILY.format(where=""),
    "job_daily_trend_valid": _DAILY.format(where="WHERE id IS NOT NULL"),
    "top_tweeters_stream": _TOP,
    "daily_trend_stream": _DAILY.format(where=""),
    "daily_trend_stream_restart": _DAILY.format(where=""),
    "daily_trend_stream_takeover": _DAILY.format(where=""),
    "top_tweeters_stream_keyed": _TOP,
    "result_replaced_plain": _FAMOUS,
    "result_replaced_versions": _FAMOUS,
}

ORACLE_SQL: dict[str, str] = {name: f"WITH {TWEETS_VIEW_SQL.strip()}\n{body}" for name, body in _BODIES.items()}
