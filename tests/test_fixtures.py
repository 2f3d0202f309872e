"""The events adapter reproduces the numbers FIXTURES.md documents for it."""

import pytest
from pyspark.sql import functions as F

from chirpstat.functions.parse import parse_tweets
from chirpstat.operators.analyses import add_is_famous
from chirpstat.operators.quality import valid_tweets
from chirpstat.sources.fixtures import read_event_messages

# sf dir -> rows, authors, null ids, days, isFamous false / true over valid rows
EXPECTED = {
    "/root/testdata/sf0.001": (1000, 15, 14, 30, 985, 1),
    "/root/testdata/sf0.01": (10000, 150, 93, 30, 9891, 16),
}


@pytest.mark.parametrize("sf", list(EXPECTED))
def test_adapter_matches_fixture_table(spark, sf):
    tweets = parse_tweets(read_event_messages(spark, sf))
    got = tweets.agg(
        F.count(F.lit(1)),
        F.count_distinct("author_id"),
        F.count_if(F.col("id").isNull()),
        F.count_distinct(F.col("created_at").cast("date")),
    ).first()
    flags = {r.isFamous: r["count"] for r in add_is_famous(valid_tweets(tweets)).groupBy("isFamous").count().collect()}
    assert (*got, flags.get(False, 0), flags.get(True, 0)) == EXPECTED[sf]


def _rows(spark, n):
    return spark.range(n).selectExpr(
        "id AS event_id", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS ts", "id AS user_id", "'a' AS event_type", "1.0D AS value",
        "'{\"k\": 1}' AS props",
    )


@pytest.mark.parametrize("prefix", ["", "file://"])
def test_changed_table_is_published_anew(spark, scratch, prefix):
    import os

    from chirpstat.sources.fixtures import event_topic

    folder = f"{prefix}{scratch}"
    _rows(spark, 10).coalesce(1).write.parquet(f"{folder}/events.parquet")
    first = event_topic(spark, folder)
    assert read_event_messages(spark, folder).count() == 10
    assert event_topic(spark, folder) == first  # unchanged: the same topic
    _rows(spark, 25).coalesce(1).write.mode("overwrite").parquet(f"{folder}/events.parquet")
    assert read_event_messages(spark, folder).count() == 25
    assert not os.path.exists(first)  # the stale copy is gone


def test_topic_partitions_do_not_depend_on_the_table(spark, scratch):
    from chirpstat.sources.fixtures import TOPIC_PARTITIONS, event_topic

    for n in (1000, 4000):
        folder = f"{scratch}/{n}"
        _rows(spark, n).repartition(3).write.parquet(f"{folder}/events.parquet")
        assert len(spark.read.parquet(event_topic(spark, folder)).inputFiles()) == TOPIC_PARTITIONS
        assert len(spark.read.parquet(event_topic(spark, folder, partitions=None)).inputFiles()) == 3
