"""Runs that read on from the offsets of the last one."""

import json
import os

import pytest
from tests_util import sorted_rows

from chirpstat.functions.parse import parse_tweets
from chirpstat.functions.schema import RAW_MESSAGE_SCHEMA
from chirpstat.operators import analyses as A
from chirpstat.plans import cli
from chirpstat.plans.jobs import plan_daily_trend, run_daily_trend_since
from chirpstat.sources import ledger as L
from chirpstat.sources.fixtures import read_event_messages
from chirpstat.sources.io import Sink, read_result
from chirpstat.sources.versions import Overtaken

SF = "/root/testdata/sf0.001"


class Topic:
    """A folder that grows, as a topic of three partitions."""

    def __init__(self, spark, scratch):
        self.spark, self.path = spark, os.path.join(scratch, "topic")
        raw = read_event_messages(spark, SF)
        self.raw = raw.selectExpr("value", "CAST(offset % 3 AS int) AS partition", "offset")
        self.read = L.messages_since(lambda: spark.read.parquet(self.path))

    def add(self, condition):
        self.raw.where(condition).write.mode("append").parquet(self.path)

    def all(self):
        return self.spark.read.parquet(self.path)


def test_runs_over_a_growing_topic_equal_one_run_over_all(spark, scratch):
    topic, ledger = Topic(spark, scratch), os.path.join(scratch, "ledger")
    # partition 2 is new in the second step; the last step brings nothing
    steps = ["offset < 300 AND partition < 2", "offset BETWEEN 300 AND 700 OR (offset < 300 AND partition = 2)", "offset > 700", "false"]
    for n, step in enumerate(steps):
        topic.add(step)
        got = run_daily_trend_since(spark, topic.read, ledger, most_parts=2)
        assert sorted_rows(got) == sorted_rows(plan_daily_trend(spark, topic.all())), n
        valid = plan_daily_trend(spark, topic.all(), drop_invalid=True)
    assert sorted_rows(run_daily_trend_since(spark, topic.read, ledger, drop_invalid=True)) == sorted_rows(valid)
    readings = L.Ledger(spark, ledger).readings()
    assert len(readings) == 5 and readings[0].start == {} and set(readings[0].end) == {0, 1}
    for a, b in zip(readings, readings[1:]):
        assert b.start == a.end
    assert readings[-1].end == readings[2].end == {0: 1000, 1: 998, 2: 999}
    kept = [d for d in os.listdir(ledger) if d.startswith("part-")]
    assert len(kept) <= 3  # merged parts are removed


def test_a_run_can_be_replayed(spark, scratch):
    topic, ledger = Topic(spark, scratch), os.path.join(scratch, "ledger")
    for step in ("offset < 400", "offset BETWEEN 400 AND 800", "offset > 800"):
        topic.add(step)
        run_daily_trend_since(spark, topic.read, ledger)
    own = L.Ledger(spark, ledger)
    for reading, step in zip(own.readings(), ("offset < 400", "offset BETWEEN 400 AND 800", "offset > 800"), strict=True):
        assert sorted_rows(own.replay(topic.read, reading)) == sorted_rows(topic.all().where(step))
    again = A.daily_trends(parse_tweets(own.replay(topic.read, own.readings()[1])))
    assert sum(r.toplam_tweet_sayisi for r in again.collect()) == 401


def test_new_messages_only_are_read(spark, scratch):
    from pyspark.sql import functions as F

    reads = spark.sparkContext.accumulator(0)

    @F.udf("binary")
    def counted(v):
        reads.add(1)
        return v

    topic, ledger = Topic(spark, scratch), os.path.join(scratch, "ledger")
    for step, new in (("offset < 900", 900), ("offset >= 900", 100)):
        topic.add(step)
        before = reads.value
        run_daily_trend_since(
            spark, lambda s, e: topic.read(s, e).withColumn("value", counted.asNondeterministic()("value")), ledger, Sink(base=scratch)
        )
        assert reads.value - before == new  # each parsed once, the old ones not at all
    assert read_result(spark, "daily_trend", Sink(base=scratch)).count() == 30
    plan = topic.read({0: 900, 1: 900, 2: 900}, None)._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "Or(Not(In(partition, [0,1,2])),GreaterThanOrEqual(offse" in pushed


def test_a_run_that_dies_is_not_recorded(spark, scratch):
    from pyspark.sql import functions as F

    topic, ledger = Topic(spark, scratch), os.path.join(scratch, "ledger")
    topic.add("offset < 500")
    run_daily_trend_since(spark, topic.read, ledger)
    topic.add("offset >= 500")
    dies = F.when(F.col("offset") == 800, F.raise_error(F.lit("dies")).cast("binary")).otherwise(F.col("value"))
    with pytest.raises(Exception, match="dies"):
        run_daily_trend_since(spark, lambda s, e: topic.read(s, e).withColumn("value", dies), ledger)
    assert len(L.Ledger(spark, ledger).readings()) == 1
    assert sorted_rows(run_daily_trend_since(spark, topic.read, ledger)) == sorted_rows(plan_daily_trend(spark, topic.all()))


def test_two_runs_at_once_do_not_count_twice(spark, scratch):
    own = L.Ledger(spark, scratch)
    before = own.last()
    own.add(before, {0: 5}, None, parts=[])
    with pytest.raises(Overtaken):
        own.add(before, {0: 7}, None, parts=[])
    assert own.last().end == {0: 5}


def test_empty_topic(spark, scratch):
    none = spark.createDataFrame([], RAW_MESSAGE_SCHEMA)
    for _ in range(2):
        assert run_daily_trend_since(spark, L.messages_since(lambda: none), os.path.join(scratch, "l")).count() == 0


def test_kafka_offsets(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(L, "read_topic", lambda spark, servers, topic, **kw: calls.append((servers, topic, kw)))
    topic = L.kafka_since(spark, "h:1", "t", partitions=[0, 1, 2])
    plain = L.kafka_since(spark, "h:1", "t")
    plain({}, None), plain({0: 5}, None), topic({0: 5, 1: 7}, None), plain({0: 5}, {0: 9, 1: 2}), plain({}, {0: 9})
    start = [c[2]["starting_offsets"] for c in calls]
    end = [c[2].get("ending_offsets") for c in calls]
    assert start[0] == "earliest" and end[:3] == [None] * 3
    assert [json.loads(s) for s in start[1:]] == [{"t": {"0": 5}}, {"t": {"0": 5, "1": 7, "2": -2}}, {"t": {"0": 5, "1": -2}}, {"t": {"0": -2}}]
    assert [json.loads(e) for e in end[3:]] == [{"t": {"0": 9, "1": 2}}, {"t": {"0": 9}}]
    assert [c[2].get("partitions") for c in calls] == [None] * 3 + [[0, 1], [0]]
    from chirpstat.sources.io import kafka_read_options

    options = kafka_read_options("h:1", "t", start[3], end[3], partitions=[0, 1])
    assert options["assign"] == '{"t": [0, 1]}' and "subscribe" not in options


def test_offsets_of_many_partitions(spark):
    rows = spark.range(4000).selectExpr("CAST(id AS int) AS partition", "CAST(5 AS long) AS offset")
    got = L.between(rows, {p: 4 + p % 3 for p in range(1500)}, {p: 6 for p in range(2000)})
    assert got.count() == 1000 + 500


def test_daily_trend_cli_with_a_ledger(spark, scratch):
    topic = Topic(spark, scratch)
    args = ["daily-trend", "t", "--input-path", topic.path, "--sink-base", scratch, "--preview", "0", "--ledger", os.path.join(scratch, "ledger")]
    for step in ("offset < 400", "offset >= 400"):
        topic.add(step)
        assert cli.main(args, spark) == 0
    assert sum(r.toplam_tweet_sayisi for r in spark.read.parquet(os.path.join(scratch, "daily_trend")).collect()) == 1000
