"""Batch jobs: one snapshot, five outputs; daily trend with a sink."""

import os

from tests_util import sorted_rows

from chirpstat.functions.schema import USER_ANALYSIS_TARGETS
from chirpstat.operators import analyses as A
from chirpstat.operators.quality import valid_tweets
from chirpstat.plans.jobs import plan_user_analysis, run_daily_trend, run_user_analysis
from chirpstat.functions.parse import parse_tweets
from chirpstat.sources.fixtures import read_event_messages
from chirpstat.sources.io import Sink

SF = "/root/testdata/sf0.001"


def test_user_analysis_writes_five_results(spark, scratch):
    from chirpstat.session import checkpoint_root

    raw = read_event_messages(spark, SF)
    job_dir = os.path.join(checkpoint_root(spark).removeprefix("file:"), "chirpstat")
    before = set(os.listdir(job_dir)) if os.path.isdir(job_dir) else set()
    written = run_user_analysis(spark, raw, Sink(base=scratch))
    assert list(written) == list(USER_ANALYSIS_TARGETS) and all(written.values())
    # The snapshot and the per-author table are removed once the results are written.
    assert set(os.listdir(job_dir)) == before
    valid = valid_tweets(parse_tweets(raw))
    expect = {
        "top_tweeters": A.top_tweeters(valid),
        "famous_top_tweeters": A.famous_top_tweeters(valid),
        "isFamous_tweeters": A.add_is_famous(valid),
        "fame_distribution_tweeters": A.fame_distribution(A.add_is_famous(valid)),
        "low_follower_activity_tweeters": A.low_follower_activity(valid),
    }
    for name, df in expect.items():
        back = spark.read.parquet(os.path.join(scratch, name))
        assert back.columns == df.columns, name
        assert sorted_rows(back) == sorted_rows(df), name


def test_plan_without_snapshot_matches(spark):
    raw = read_event_messages(spark, SF)
    a = plan_user_analysis(spark, raw, snapshot=False)
    b = plan_user_analysis(spark, raw, snapshot=True)
    for name in ("top_tweeters", "famous_top_tweeters", "fame_distribution", "low_follower_activity"):
        assert sorted_rows(getattr(a, name)) == sorted_rows(getattr(b, name)), name
    c = a.counts.first()
    assert (c.total, c.invalid) == (1000, 14)


def test_properties_on_events(spark):
    raw = read_event_messages(spark, SF)
    tweets = parse_tweets(raw)
    valid = valid_tweets(tweets)
    n_valid = valid.count()
    assert sum(r.tweet_sayisi for r in A.top_tweeters(valid).collect()) == n_valid
    assert sum(r["count"] for r in A.fame_distribution(A.add_is_famous(valid)).collect()) == n_valid
    assert sum(r.toplam_tweet_sayisi for r in A.daily_trends(tweets).collect()) == tweets.count()
    assert A.add_is_famous(valid).count() == n_valid
    # Low-follower activity with a point above every count equals famous over rows that have one.
    low_all = A.low_follower_activity(valid, point=10**9)
    famous = A.famous_top_tweeters(valid.filter("follower_count IS NOT NULL"))
    assert sorted_rows(low_all) == sorted_rows(famous)


def test_daily_trend_job_sink(spark, scratch):
    raw = read_event_messages(spark, SF)
    run_daily_trend(spark, raw, Sink(base=scratch))
    back = spark.read.parquet(os.path.join(scratch, "daily_trend"))
    assert back.count() == 30
    assert back.columns == ["day", "toplam_tweet_sayisi", "toplam_retweet_sayisi"]


def test_daily_trend_job_empty_input_keeps_previous(spark, scratch):
    raw = read_event_messages(spark, SF)
    run_daily_trend(spark, raw, Sink(base=scratch))
    run_daily_trend(spark, raw.limit(0), Sink(base=scratch))
    assert spark.read.parquet(os.path.join(scratch, "daily_trend")).count() == 30
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_failing_sink_fails_the_job(spark, scratch):
    import pytest

    raw = read_event_messages(spark, SF)
    with pytest.raises(Exception):
        run_user_analysis(spark, raw, Sink(fmt="no_such_format_xyz", base=scratch))


def test_daily_job_reports_invalid_and_matches_plan(spark, caplog):
    import logging

    from chirpstat.plans.jobs import plan_daily_trend

    raw = read_event_messages(spark, SF)
    with caplog.at_level(logging.INFO, logger="chirpstat.plans.jobs"):
        got = run_daily_trend(spark, raw)
    assert "14 of 1000 records have no id" in caplog.text
    assert sorted_rows(got) == sorted_rows(plan_daily_trend(spark, raw))
    valid = run_daily_trend(spark, raw, drop_invalid=True)
    assert sorted_rows(valid) == sorted_rows(plan_daily_trend(spark, raw, drop_invalid=True))
    assert [r.day for r in got.collect()] == sorted((r.day for r in got.collect()), reverse=True)


def _leftovers(spark):
    import os

    from chirpstat.session import checkpoint_root, list_names

    names = list_names(spark, os.path.join(checkpoint_root(spark), "chirpstat"))
    return {n for n in names if n.startswith(("tweets-", "author_stats-"))}


def test_snapshots_are_removed_also_after_a_failure(spark, scratch):
    import pytest

    before = _leftovers(spark)
    raw = read_event_messages(spark, SF)
    run_user_analysis(spark, raw, Sink(base=scratch))
    with pytest.raises(Exception):
        run_user_analysis(spark, raw, Sink(fmt="no_such_format_xyz", base=scratch))
    assert _leftovers(spark) == before


def test_daily_job_parses_every_message_once(spark, scratch):
    import json

    from pyspark.sql import functions as F

    reads = spark.sparkContext.accumulator(0)

    @F.udf("binary")
    def counted(i):
        reads.add(1)
        return json.dumps({"id": str(i), "created_at": "2024-01-01T00:00:00Z"}).encode()

    raw = spark.range(1000).select(counted.asNondeterministic()("id").alias("value"))
    result = run_daily_trend(spark, raw, Sink(base=scratch))
    assert [r.toplam_tweet_sayisi for r in result.collect()] == [1000]
    assert reads.value == 1000


def test_selection_is_delivered_whole(spark, scratch):
    from chirpstat.functions.schema import TWEET_SCHEMA
    from chirpstat.operators.select import text_search
    from chirpstat.plans.jobs import deliver

    tweets = valid_tweets(parse_tweets(read_event_messages(spark, SF)))
    found = text_search(tweets, "click", n=100_000, columns=tuple(TWEET_SCHEMA.fieldNames()))
    deliver(spark, found, archive_path=f"{scratch}/a", publish_path=f"{scratch}/p")
    want = sorted_rows(found)
    assert len(want) > 10
    for side in "ap":
        assert sorted_rows(parse_tweets(spark.read.parquet(f"{scratch}/{side}"))) == want
