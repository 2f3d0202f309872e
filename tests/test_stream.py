"""Streaming forms equal their batch twins; restarts add nothing; dual path."""

import os

import pytest
from pyspark.sql import functions as F
from tests_util import sorted_rows

from chirpstat.functions.parse import parse_tweets
from chirpstat.operators import analyses as A
from chirpstat.operators.quality import valid_tweets
from chirpstat.sources.fixtures import event_topic, read_event_messages
from chirpstat.functions.schema import RAW_MESSAGE_SCHEMA
from chirpstat.streaming import stream as S

SF = "/root/testdata/sf0.001"


def _stream(spark):
    return spark.readStream.schema(RAW_MESSAGE_SCHEMA).option("maxFilesPerTrigger", 2).parquet(event_topic(spark, SF))


def test_daily_trend_stream_equals_batch(spark, scratch):
    got = S.run_complete(spark, S.daily_trend_stream(_stream(spark)), "d", checkpoint=os.path.join(scratch, "ck"))
    want = A.daily_trends(parse_tweets(read_event_messages(spark, SF)))
    assert sorted_rows(got) == sorted_rows(want)


def test_top_tweeters_stream_restart_adds_nothing(spark, scratch):
    ck, out = os.path.join(scratch, "ck"), os.path.join(scratch, "out")
    first = sorted_rows(S.run_complete(spark, S.top_tweeters_stream(_stream(spark)), "t", ck, out))
    again = sorted_rows(S.run_complete(spark, S.top_tweeters_stream(_stream(spark)), "t", ck, out))
    want = sorted_rows(A.top_tweeters(valid_tweets(parse_tweets(read_event_messages(spark, SF)))))
    assert first == want and again == want


def test_dual_path_archives_and_republishes_every_message(spark, scratch):
    root = os.path.join(scratch, "ck")
    archive, publish = os.path.join(scratch, "archive"), os.path.join(scratch, "published")
    for _ in range(2):  # the second run resumes from the checkpoints and adds nothing
        qs = S.start_dual_path(_stream(spark), archive, root, publish_path=publish, availableNow=True)
        for q in qs:
            q.awaitTermination()
    raw = read_event_messages(spark, SF).select("value")
    want = sorted_rows(raw)
    assert sorted_rows(spark.read.parquet(archive)) == want
    assert sorted_rows(spark.read.parquet(publish)) == want


def test_state_partitions_apply_to_a_new_query_only(spark, scratch):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    ck, out = os.path.join(scratch, "ck"), os.path.join(scratch, "out")
    got = S.run_complete(spark, S.daily_trend_stream(_stream(spark)), "d", ck, out, state_partitions=3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert sorted(os.listdir(os.path.join(ck, "state", "0"))) == ["0", "1", "2", "_metadata"]
    assert sorted_rows(got) == sorted_rows(A.daily_trends(parse_tweets(read_event_messages(spark, SF))))


def test_streams_handle_null_keys_like_batch(spark, scratch):
    import json

    from conftest import messages

    rows = [
        {"id": "1", "author_id": None, "author_username": None, "created_at": "bad", "public_metrics": {"retweet_count": 2}},
        {"id": "2", "author_id": None, "author_username": None, "created_at": None},
        {"id": None, "author_id": "a", "author_username": "u", "created_at": "2024-01-01T00:00:00Z"},
        {"id": "3", "author_id": "a", "author_username": "u", "created_at": "2024-01-01T10:00:00Z", "public_metrics": {"retweet_count": 5}},
    ]
    raw = messages(spark, [json.dumps(r) for r in rows] + ["junk"])
    src = os.path.join(scratch, "src")
    raw.write.parquet(src)
    stream = lambda: spark.readStream.schema("value binary").parquet(src)
    daily = S.run_complete(spark, S.daily_trend_stream(stream()), "d", os.path.join(scratch, "ck1"), os.path.join(scratch, "o1"))
    top = S.run_complete(spark, S.top_tweeters_stream(stream()), "t", os.path.join(scratch, "ck2"), os.path.join(scratch, "o2"))
    batch = parse_tweets(spark.read.parquet(src))
    assert sorted_rows(daily) == sorted_rows(A.daily_trends(batch))
    assert sorted_rows(top) == sorted_rows(A.top_tweeters(valid_tweets(batch)))
    assert {(r.author_id, r.tweet_sayisi) for r in top.collect()} == {(None, 2), ("a", 1)}


def changelog_writer(path):
    """File stand-in for an upserting store: appends each batch's changed rows with their batch id."""

    def write(batch, batch_id):
        batch.withColumn("_batch", F.lit(batch_id)).write.mode("append").parquet(path)

    return write


def test_update_mode_changelog_equals_batch(spark, scratch):
    from chirpstat.functions.schema import AUTHOR_KEYS

    log = os.path.join(scratch, "changes")
    q = S.start_update(
        spark, S.top_tweeters_stream(_stream(spark)), changelog_writer(log), os.path.join(scratch, "ck"),
        state_partitions=4, availableNow=True,
    )
    q.awaitTermination()
    changes = spark.read.parquet(log)
    assert changes.select("_batch").distinct().count() > 1  # several triggers, each with changed keys only
    values = [c for c in changes.columns if c not in (*AUTHOR_KEYS, "_batch")]
    latest = changes.groupBy(*AUTHOR_KEYS).agg(F.max_by(F.struct(*values), F.col("_batch")).alias("_v"))
    got = latest.select(*AUTHOR_KEYS, "_v.*")
    want = A.top_tweeters(valid_tweets(parse_tweets(read_event_messages(spark, SF))), sort=False)
    assert sorted_rows(got) == sorted_rows(want)


def test_mongo_upsert_options():
    assert S.mongo_upsert_options("top_tweeters", ["author_id", "author_username"], database="tweet_results") == {
        "collection": "top_tweeters", "operationType": "replace", "idFieldList": "author_id,author_username",
        "upsertDocument": "true", "database": "tweet_results",
    }


def test_mongo_upsert_fails_loudly_without_connector(spark):
    write = S.mongo_upsert("top_tweeters", ["author_id"], database="tweet_results")
    with pytest.raises(Exception, match="mongodb"):
        write(spark.createDataFrame([("a", 1)], "author_id string, tweet_sayisi long"), 0)


def test_restart_with_default_target_gives_the_same_rows(spark, scratch):
    ck = os.path.join(scratch, "ck")
    first = sorted_rows(S.run_complete(spark, S.daily_trend_stream(_stream(spark)), "d", ck))
    again = sorted_rows(S.run_complete(spark, S.daily_trend_stream(_stream(spark)), "d", ck))
    assert len(first) == 30 and first == again
    left = S._batches(spark, f"{ck}-result")
    assert 1 <= len(left) <= 2  # the last result and the one before it


def test_lost_result_of_a_finished_stream_is_an_error(spark, scratch):
    ck = os.path.join(scratch, "ck")
    S.run_complete(spark, S.daily_trend_stream(_stream(spark)), "d", ck)
    with pytest.raises(RuntimeError, match="finished batches"):
        S.run_complete(spark, S.daily_trend_stream(_stream(spark)), "d", ck, target=os.path.join(scratch, "elsewhere"))


def test_empty_stream_gives_an_empty_result(spark, scratch):
    src = os.path.join(scratch, "src")
    spark.createDataFrame([], "value binary").write.parquet(src)
    stream = spark.readStream.schema("value binary").parquet(src)
    got = S.run_complete(spark, S.daily_trend_stream(stream), "d", os.path.join(scratch, "ck"))
    assert got.count() == 0 and got.columns == ["day", "toplam_tweet_sayisi", "toplam_retweet_sayisi"]


def test_half_written_result_is_not_read(spark, scratch):
    out = os.path.join(scratch, "out")
    spark.range(3).write.parquet(os.path.join(out, "batch-4"))
    os.makedirs(os.path.join(out, "batch-5"))
    assert S.read_complete(spark, out).count() == 3
    assert S.read_complete(spark, os.path.join(scratch, "none")) is None


def _split_sources(spark, scratch):
    """The messages of two thirds and of all of the topic, as two folders of files."""
    raw = read_event_messages(spark, SF)
    parts = {"most": raw.where("offset % 3 > 0"), "all": raw}
    for name, rows in parts.items():
        rows.repartition(4).write.parquet(os.path.join(scratch, name))
    return lambda name: spark.readStream.schema(RAW_MESSAGE_SCHEMA).option("maxFilesPerTrigger", 1).parquet(os.path.join(scratch, name))


def test_new_checkpoint_on_an_old_target(spark, scratch):
    """The highest batch id is the first run's; the second run's result is what counts."""
    source, out = _split_sources(spark, scratch), os.path.join(scratch, "out")
    first = S.run_complete(spark, S.daily_trend_stream(source("all")), "d", os.path.join(scratch, "ck1"), out)
    assert sum(r.toplam_tweet_sayisi for r in first.collect()) == 1000
    most = spark.read.schema(RAW_MESSAGE_SCHEMA).parquet(os.path.join(scratch, "most"))
    one_batch = spark.readStream.schema(RAW_MESSAGE_SCHEMA).parquet(os.path.join(scratch, "most"))
    second = S.run_complete(spark, S.daily_trend_stream(one_batch), "d", os.path.join(scratch, "ck2"), out)
    assert sorted_rows(second) == sorted_rows(A.daily_trends(parse_tweets(most)))
    manifest = S.Versions(spark, out).last()
    assert manifest.notes["batch"] == 0 and manifest.notes["checkpoint"] == os.path.join(scratch, "ck2")
    # the first run, started again with nothing new, shows its own result if that is still kept, else says so
    with pytest.raises(RuntimeError, match="finished batches"):
        S.run_complete(spark, S.daily_trend_stream(source("all")), "d", os.path.join(scratch, "ck1"), out)


def test_new_checkpoint_with_nothing_to_read_shows_no_old_rows(spark, scratch):
    out, none = os.path.join(scratch, "out"), os.path.join(scratch, "none")
    S.run_complete(spark, S.daily_trend_stream(_stream(spark)), "d", os.path.join(scratch, "ck1"), out)
    os.makedirs(none)  # no file: no batch runs
    empty = spark.readStream.schema("value binary").parquet(none)
    assert S.run_complete(spark, S.daily_trend_stream(empty), "d", os.path.join(scratch, "ck2"), out).count() == 0
    assert S.read_complete(spark, out) is None
    # the first run takes its target back: its last result is still kept
    again = S.run_complete(spark, S.daily_trend_stream(_stream(spark)), "d", os.path.join(scratch, "ck1"), out)
    assert sorted_rows(again) == sorted_rows(A.daily_trends(parse_tweets(read_event_messages(spark, SF))))


def test_overtaken_run_cannot_replace_the_new_ones_result(spark, scratch):
    out, ck = os.path.join(scratch, "out"), [os.path.join(scratch, f"ck{i}") for i in (1, 2)]
    for c, run in zip(ck, ("one", "two")):
        os.makedirs(c)
        with open(os.path.join(c, "metadata"), "w") as f:
            f.write('{"id": "%s"}' % run)
    one, two = (S._Target(spark, out, c, "parquet") for c in ck)
    one.write(spark.range(1), 0)
    one.write(spark.range(2), 1)
    two.claim("two")
    assert S.read_complete(spark, out) is None
    with pytest.raises(S.Overtaken, match="two"):
        one.write(spark.range(3), 2)
    assert S.read_complete(spark, out) is None
    two.write(spark.range(9), 0)
    assert S.read_complete(spark, out).count() == 9 and S._batches(spark, out) == [0]


def test_target_from_before_the_manifest_goes_on(spark, scratch):
    ck, out = os.path.join(scratch, "ck"), os.path.join(scratch, "out")
    want = sorted_rows(S.run_complete(spark, S.daily_trend_stream(_stream(spark)), "d", ck, out))
    last = S.Versions(spark, out).last()
    os.rename(os.path.join(out, last.version), os.path.join(out, f"batch-{last.notes['batch']}"))
    os.rename(os.path.join(out, "_records"), os.path.join(scratch, "gone"))
    assert sorted_rows(S.run_complete(spark, S.daily_trend_stream(_stream(spark)), "d", ck, out)) == want
