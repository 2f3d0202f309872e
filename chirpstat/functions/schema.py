"""Fixed schemas and names that the tweet analyses are defined against.

Everything here is a declared constant: nothing is inferred from the data, so a
changed producer can never silently change a result type.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# --- Fixed values: the tweet message contract -------------------------------
# Field names, order and types of one tweet message, every field nullable.
PUBLIC_METRICS_SCHEMA = StructType(
    [
        StructField("retweet_count", IntegerType(), True),
        StructField("reply_count", IntegerType(), True),
        StructField("like_count", IntegerType(), True),
        StructField("quote_count", IntegerType(), True),
        StructField("impression_count", IntegerType(), True),
    ]
)

TWEET_SCHEMA = StructType(
    [
        StructField("id", StringType(), True),
        StructField("text", StringType(), True),
        StructField("created_at", StringType(), True),
        StructField("author_id", StringType(), True),
        StructField("author_username", StringType(), True),
        StructField("follower_count", IntegerType(), True),
        StructField("friends_count", IntegerType(), True),
        StructField("public_metrics", PUBLIC_METRICS_SCHEMA, True),
        StructField("lang", StringType(), True),
        StructField("source", StringType(), True),
    ]
)

# Only `created_at` values of exactly this shape are accepted as timestamps
# (`\z` is the very end of the text: a trailing newline does not match).
CREATED_AT_REGEX = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z\z"
# The same shape as a datetime pattern, used when writing timestamps back out.
CREATED_AT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"

# --- Fixed values: output column names of the results -----------------------
TWEET_COUNT = "tweet_sayisi"
MAX_FOLLOWERS = "max_follower_count"
IS_FAMOUS = "isFamous"
DAY = "day"
DAY_TWEETS = "toplam_tweet_sayisi"
DAY_RETWEETS = "toplam_retweet_sayisi"
AUTHOR_KEYS = ("author_id", "author_username")

# Tweet fields each result reads; `parse_tweets(fields=...)` parses only these.
AUTHOR_FIELDS = ("id", "author_id", "author_username")
FOLLOWER_FIELDS = AUTHOR_FIELDS + ("follower_count",)
FAME_FIELDS = ("id", "follower_count")
DAILY_FIELDS = ("created_at", "public_metrics.retweet_count")
TIMELINE_FIELDS = ("id", "created_at", "text", "author_username")
SEARCH_FIELDS = ("id", "created_at", "text", "lang")

# --- Fixed values: defaults of the analyses ----------------------------------
FAME_POINT = 100000
LOW_FOLLOWER_POINT = 100
DEFAULT_TOPIC = "raw-tweets-stream"

# Result names of the user-analysis job, one per analysis.
USER_ANALYSIS_TARGETS = (
    "top_tweeters",
    "famous_top_tweeters",
    "isFamous_tweeters",
    "fame_distribution_tweeters",
    "low_follower_activity_tweeters",
)

# Shape of a message as Spark's Kafka source yields it; a Parquet table with
# these columns stands in for a topic wherever no broker is reachable.
RAW_MESSAGE_SCHEMA = StructType(
    [
        StructField("key", BinaryType(), True),
        StructField("value", BinaryType(), True),
        StructField("topic", StringType(), True),
        StructField("partition", IntegerType(), True),
        StructField("offset", LongType(), True),
        StructField("timestamp", TimestampType(), True),
        StructField("timestampType", IntegerType(), True),
    ]
)
