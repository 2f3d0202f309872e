"""The per-author, per-tweet and per-day analyses over typed tweets.

Every grouping here is an algebraic aggregate (count, max, sum), so Spark runs
it as a partial aggregate inside each scan task followed by one hash shuffle of
at most one row per key per task. A key that holds a third of all rows (a hot
author, the null-author group, a busy day) is therefore reduced to a single row
per task before it reaches the network; no task ever sees a whole group.

Sorts use the result's own columns plus the group keys as tie-breakers, so
every order is total and every top-n is deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chirpstat.functions.parse import day_of
from chirpstat.functions.schema import (
    AUTHOR_KEYS,
    DAY,
    DAY_RETWEETS,
    DAY_TWEETS,
    FAME_POINT,
    IS_FAMOUS,
    LOW_FOLLOWER_POINT,
    MAX_FOLLOWERS,
    TWEET_COUNT,
)


def _author_order() -> list[Column]:
    return [F.col(k).asc_nulls_last() for k in AUTHOR_KEYS]


def top_tweeters_order() -> list[Column]:
    return [F.col(TWEET_COUNT).desc(), *_author_order()]


def famous_order() -> list[Column]:
    return [F.col(MAX_FOLLOWERS).desc_nulls_last(), *_author_order()]


def low_follower_order() -> list[Column]:
    return [F.col(MAX_FOLLOWERS).asc_nulls_last(), *_author_order()]


def daily_order() -> list[Column]:
    return [F.col(DAY).desc_nulls_last()]


def _first(df: DataFrame, n: int | None) -> DataFrame:
    return df if n is None else df.limit(n)


def top_tweeters(df: DataFrame, sort: bool = True, n: int | None = None) -> DataFrame:
    """Tweets per author, most active first (all authors, or the first `n`).

    Columns: author_id, author_username, tweet_sayisi (= count of non-null ids).
    `sort=False` leaves the order to the reader (a table sink, a stream).
    """
    counts = df.groupBy(*AUTHOR_KEYS).agg(F.count("id").alias(TWEET_COUNT))
    return _first(counts.orderBy(*top_tweeters_order()), n) if sort else counts


def famous_top_tweeters(df: DataFrame, n: int | None = None) -> DataFrame:
    """Largest follower count seen per author and the author's tweet count.

    No fame threshold is applied: every author is listed (or the first `n`),
    largest first.
    """
    stats = df.groupBy(*AUTHOR_KEYS).agg(
        F.max("follower_count").alias(MAX_FOLLOWERS),
        F.count("id").alias(TWEET_COUNT),
    )
    return _first(stats.orderBy(*famous_order()), n)


def is_famous(follower_count: str | Column = "follower_count", point: int = FAME_POINT) -> Column:
    """True when the follower count is at least `point`; False otherwise, also for null."""
    fc = F.col(follower_count) if isinstance(follower_count, str) else follower_count
    return F.when(fc >= point, F.lit(True)).otherwise(F.lit(False))


def add_is_famous(df: DataFrame, point: int = FAME_POINT) -> DataFrame:
    """All columns plus the per-tweet `isFamous` flag; the row count is unchanged."""
    return df.withColumn(IS_FAMOUS, is_famous("follower_count", point))


def fame_distribution(is_famous_df: DataFrame) -> DataFrame:
    """Tweets per `isFamous` value (at most two rows): isFamous, count."""
    return is_famous_df.groupBy(IS_FAMOUS).count()


def low_follower_activity(
    df: DataFrame, point: int = LOW_FOLLOWER_POINT, n: int | None = None
) -> DataFrame:
    """Activity of authors below `point` followers, smallest following first
    (all such authors, or the first `n`).

    Rows are filtered before grouping, so the max and the count cover only the
    author's rows under the limit, and rows with an unknown count are left out.
    """
    stats = (
        df.filter(F.col("follower_count") < point)
        .groupBy(*AUTHOR_KEYS)
        .agg(
            F.max("follower_count").alias(MAX_FOLLOWERS),
            F.count("id").alias(TWEET_COUNT),
        )
    )
    return _first(stats.orderBy(*low_follower_order()), n)


def daily_trends(df: DataFrame, sort: bool = True, n: int | None = None) -> DataFrame:
    """Per day: all tweets (`count(*)`) and the sum of their retweets, newest day
    first (all days, or the newest `n`).

    Rows with no parsable `created_at` form one null day, listed last.
    `sort=False` leaves the order to the reader (a table sink, a stream).
    """
    totals = df.groupBy(day_of("created_at").alias(DAY)).agg(
        F.count(F.lit(1)).alias(DAY_TWEETS),
        F.sum(F.col("public_metrics.retweet_count")).alias(DAY_RETWEETS),
    )
    return _first(totals.orderBy(*daily_order()), n) if sort else totals


def daily_stats(df: DataFrame) -> DataFrame:
    """Per day, totals over all rows and over rows with an id, in one aggregate.

    Lets the daily job report how many records lack an id and produce either
    form of the daily trend from one scan (one row per day, so tiny).
    """
    return df.groupBy(day_of("created_at").alias(DAY)).agg(*daily_measures())


def daily_measures() -> list[Column]:
    """The aggregates of `daily_stats`; sums of them over parts of the rows are those of all rows."""
    rt = F.col("public_metrics.retweet_count")
    has_id = F.col("id").isNotNull()
    return [
        F.count(F.lit(1)).alias("rows"),
        F.sum(rt).alias("retweets"),
        F.count_if(has_id).alias("valid_rows"),
        F.sum(F.when(has_id, rt)).alias("valid_retweets"),
    ]


def daily_trends_from_stats(stats: DataFrame, drop_invalid: bool = False, sort: bool = True) -> DataFrame:
    """The daily trend over all rows, or (drop_invalid) over rows with an id only."""
    if drop_invalid:
        out = stats.filter(F.col("valid_rows") > 0).select(
            DAY, F.col("valid_rows").alias(DAY_TWEETS), F.col("valid_retweets").alias(DAY_RETWEETS)
        )
    else:
        out = stats.select(DAY, F.col("rows").alias(DAY_TWEETS), F.col("retweets").alias(DAY_RETWEETS))
    return out.orderBy(*daily_order()) if sort else out


def top_n(sorted_df: DataFrame, n: int = 10) -> DataFrame:
    """First n rows of a sorted result.

    Sort + limit plans as TakeOrderedAndProject: each task keeps its own n
    best rows and only n x tasks rows are merged, with no range shuffle.
    """
    return sorted_df.limit(n)


# --- One-shuffle form for the user-analysis job --------------------------------


def author_stats(
    df: DataFrame, fame_point: int = FAME_POINT, low_point: int = LOW_FOLLOWER_POINT
) -> DataFrame:
    """Everything the per-author results need, in one aggregate over the tweets.

    top_tweeters, famous_top_tweeters and low_follower_activity all group by
    the same keys; computing their measures together means the tweets are
    scanned and shuffled once instead of three times. The per-author rows are
    small (one per author) and the three results are cheap projections of it.
    """
    fc = F.col("follower_count")
    low = fc < low_point
    return df.groupBy(*AUTHOR_KEYS).agg(
        F.count("id").alias(TWEET_COUNT),
        F.max(fc).alias(MAX_FOLLOWERS),
        F.count_if(low).alias("low_rows"),
        F.count(F.when(low, F.col("id"))).alias("low_tweets"),
        F.max(F.when(low, fc)).alias("low_max_followers"),
        F.count_if(fc >= fame_point).alias("famous_rows"),
        F.count(F.lit(1)).alias("rows"),
    )


def top_tweeters_from_stats(stats: DataFrame) -> DataFrame:
    """Unordered, for a table sink (order: `top_tweeters_order`)."""
    return stats.select(*AUTHOR_KEYS, TWEET_COUNT)


def famous_top_tweeters_from_stats(stats: DataFrame) -> DataFrame:
    """Unordered, for a table sink (order: `famous_order`)."""
    return stats.select(*AUTHOR_KEYS, MAX_FOLLOWERS, TWEET_COUNT)


def low_follower_activity_from_stats(stats: DataFrame) -> DataFrame:
    """Unordered, for a table sink (order: `low_follower_order`)."""
    return stats.filter(F.col("low_rows") > 0).select(
        *AUTHOR_KEYS,
        F.col("low_max_followers").alias(MAX_FOLLOWERS),
        F.col("low_tweets").alias(TWEET_COUNT),
    )


def fame_distribution_from_stats(stats: DataFrame) -> DataFrame:
    """isFamous, count from the per-author counts (a sum over one row per author)."""
    totals = stats.agg(
        F.sum("famous_rows").alias("t"), (F.sum("rows") - F.sum("famous_rows")).alias("f")
    )
    return (
        totals.select(
            F.explode(
                F.array(
                    F.struct(F.lit(True).alias(IS_FAMOUS), F.col("t").alias("count")),
                    F.struct(F.lit(False).alias(IS_FAMOUS), F.col("f").alias("count")),
                )
            ).alias("r")
        )
        .select("r.*")
        .filter(F.col("count") > 0)
    )
