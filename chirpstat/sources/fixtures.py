"""Turn the driver's `events` table into topic-shaped tweet messages.

No broker is reachable here, so a Parquet table stands in for the topic. Each
events row becomes one tweet object, encoded as JSON bytes in `value`, so every
analysis still runs the real path: bytes -> from_json -> typed rows. The
mapping is a plain projection: it runs per partition with no shuffle and grows
linearly with the table.
"""

from __future__ import annotations

import os
import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chirpstat.functions.schema import CREATED_AT_FORMAT, DEFAULT_TOPIC, RAW_MESSAGE_SCHEMA
from chirpstat.session import checkpoint_root, path_exists, remove_path, scratch_path

# --- Fixed values: the events -> tweet mapping --------------------------------
# k is the integer in events.props ({"k": 0..99}).
#   id               = event_id as text, null when k = 0 (about 1 % invalid rows)
#   text             = 'RT @x: ' when k % 10 = 0, then event_type || ' k=' || k
#   created_at       = ts cut to the second, as yyyy-MM-ddTHH:mm:ssZ
#   author_id        = user_id as text;  author_username = 'user_' || user_id
#   follower_count   = floor(value * value) as int
#   friends_count    = k * 7
#   public_metrics   = retweet k, reply k*2, like k*3, quote k % 10, impression k*100
#   lang             = 'tr' when k is even, else 'en';  source = event_type
EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")


def events_path(sf_dir: str) -> str:
    return os.path.join(sf_dir, "events.parquet")


def _k() -> Column:
    return F.from_json(F.col("props"), "k INT").getField("k")


def events_as_tweets(events: DataFrame) -> DataFrame:
    """events rows -> tweet-shaped struct column `tweet` plus the event time."""
    k = F.col("k")
    tweet = F.struct(
        F.when(k != 0, F.col("event_id").cast("string")).alias("id"),
        F.concat(
            F.when(k % 10 == 0, F.lit("RT @x: ")).otherwise(F.lit("")),
            F.col("event_type"),
            F.lit(" k="),
            k.cast("string"),
        ).alias("text"),
        F.date_format(F.col("ts"), CREATED_AT_FORMAT).alias("created_at"),
        F.col("user_id").cast("string").alias("author_id"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("author_username"),
        F.floor(F.col("value") * F.col("value")).cast("int").alias("follower_count"),
        (k * 7).alias("friends_count"),
        F.struct(
            k.alias("retweet_count"),
            (k * 2).alias("reply_count"),
            (k * 3).alias("like_count"),
            (k % 10).alias("quote_count"),
            (k * 100).alias("impression_count"),
        ).alias("public_metrics"),
        F.when(k % 2 == 0, F.lit("tr")).otherwise(F.lit("en")).alias("lang"),
        F.col("event_type").alias("source"),
    )
    return events.withColumn("k", _k()).select(
        "event_id", "ts", tweet.alias("tweet")
    )


def events_as_messages(events: DataFrame, topic: str = DEFAULT_TOPIC) -> DataFrame:
    """events rows -> rows shaped like Spark's Kafka source (value = JSON bytes)."""
    tweets = events_as_tweets(events)
    return tweets.select(
        F.lit(None).cast("binary").alias("key"),
        F.to_json(F.col("tweet")).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


#: Partitions of the topic stand-in, as a broker's topic has a fixed number of them.
TOPIC_PARTITIONS = 16

# (shared folder, source, topic, partitions) -> (state of the source, folder of the messages)
_TOPICS: dict[tuple, tuple[tuple, str]] = {}
_TOPICS_LOCK = threading.Lock()


def source_state(spark: SparkSession, path: str) -> tuple:
    """What a table's files are now: their number and a digest of every file's
    path, length and time of change, from Spark's own listing (any store)."""
    files = spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")
    listed = files.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(20,0)")).alias("digest"),
        F.sum("length").alias("bytes"),
    ).first()
    return tuple(listed)


def event_topic(
    spark: SparkSession, sf_dir: str, topic: str = DEFAULT_TOPIC, partitions: int | None = TOPIC_PARTITIONS
) -> str:
    """Publish the whole events table as a topic stand-in; return its folder.

    The messages are written as Parquet files (Kafka-source columns) in the
    shared checkpoint folder, the way the ingestion side writes a topic once
    for many readers: dealt round-robin over `partitions` files, whatever the
    table's size (None: the table's own splits, with no shuffle). A topic is
    reused while the table's files are the same; a table whose files have
    changed is published anew and the old copy is removed.
    """
    src = events_path(sf_dir)
    root = checkpoint_root(spark)
    key = (root, src, topic, partitions)
    with _TOPICS_LOCK:
        state = source_state(spark, src)
        known = _TOPICS.get(key)
        if known is not None and known[0] == state and path_exists(spark, os.path.join(known[1], "_SUCCESS")):
            return known[1]
        path = scratch_path(spark, "topic")
        spark.catalog.refreshByPath(src)
        events = spark.read.parquet(src).select(*EVENT_COLUMNS)
        if partitions is not None:
            events = events.repartition(partitions)
        events_as_messages(events, topic).write.parquet(path)
        _TOPICS[key] = (state, path)
        if known is not None:
            remove_path(spark, known[1])
        return path


def read_event_messages(spark: SparkSession, sf_dir: str, topic: str = DEFAULT_TOPIC) -> DataFrame:
    """Batch read of the events topic stand-in (every message of the table)."""
    return spark.read.schema(RAW_MESSAGE_SCHEMA).parquet(event_topic(spark, sf_dir, topic))


def read_event_messages_stream(
    spark: SparkSession, sf_dir: str, topic: str = DEFAULT_TOPIC, files_per_trigger: int = TOPIC_PARTITIONS // 2
) -> DataFrame:
    """Streaming read of the events topic stand-in, at most so many message files in a micro-batch."""
    reader = spark.readStream.schema(RAW_MESSAGE_SCHEMA).option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(event_topic(spark, sf_dir, topic))


# DuckDB view with the same mapping, used as `T` by the oracle queries.
TWEETS_VIEW_SQL = """
T AS (
  SELECT CASE WHEN k <> 0 THEN CAST(event_id AS VARCHAR) END AS id,
         (CASE WHEN k % 10 = 0 THEN 'RT @x: ' ELSE '' END) || event_type || ' k=' || k AS text,
         date_trunc('second', ts) AS created_at,
         CAST(user_id AS VARCHAR) AS author_id,
         'user_' || user_id AS author_username,
         CAST(floor(value * value) AS INT) AS follower_count,
         k * 7 AS friends_count,
         k AS retweet_count, k * 2 AS reply_count, k * 3 AS like_count,
         k % 10 AS quote_count, k * 100 AS impression_count,
         CASE WHEN k % 2 = 0 THEN 'tr' ELSE 'en' END AS lang,
         event_type AS source
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS INT) AS k FROM events)
)"""
