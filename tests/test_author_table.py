"""The author-ordered table in runs."""

import os

import pytest
from tests_util import sorted_rows

from chirpstat.functions.parse import parse_tweets
from chirpstat.operators.quality import valid_tweets
from chirpstat.operators.select import user_timeline
from chirpstat.plans import cli
from chirpstat.sources.author_table import AuthorTable, read_author_table
from chirpstat.sources.fixtures import event_topic, read_event_messages
from chirpstat.sources.versions import Overtaken

SF = "/root/testdata/sf0.001"


def _tweets(spark, lo, hi, text="x"):
    return spark.range(lo, hi).selectExpr(
        "CAST(id AS string) AS id", "CONCAT('user_', id % 7) AS author_username",
        "CAST(TIMESTAMP_NTZ '2024-01-01 00:00:00' AS timestamp_ntz) + make_interval(0, 0, 0, 0, 0, CAST(id AS int), 0) AS created_at", f"'{text}' AS text",
    )


def test_runs_equal_one_table(spark, scratch):
    raw = read_event_messages(spark, SF)
    table = AuthorTable(spark, os.path.join(scratch, "t"), fan=3)
    assert table.read() is None
    for part in range(5):
        assert table.add(parse_tweets(raw.where(f"offset % 5 = {part}"))) > 0
    valid = valid_tweets(parse_tweets(raw))
    assert sorted_rows(table.read()) == sorted_rows(valid)
    for user in ("user_7", "nobody"):
        assert user_timeline(table.read(), user, 10).collect() == user_timeline(valid, user, 10).collect()
    assert table.add(parse_tweets(raw.limit(0))) == 0 and len(table.runs()) == 3  # three of five merged into one


def test_adding_a_hundredth_rewrites_about_a_hundredth(spark, scratch):
    table = AuthorTable(spark, os.path.join(scratch, "t"), fan=4)
    table.add(_tweets(spark, 0, 2000), partitions=2)
    first = table.runs()[0]["folder"]
    written, seen = 0, {first}
    for n in range(9):
        table.add(_tweets(spark, 2000 + 20 * n, 2020 + 20 * n), partitions=2)
        for run in table.runs():
            if run["folder"] not in seen:
                seen.add(run["folder"])
                written += run["rows"]
    assert written <= 2 * 9 * 20 and first in {r["folder"] for r in table.runs()}
    assert len(table.runs()) < 8 and table.read().count() == 2180
    named = {r["folder"] for record in table.versions.records() for r in table.runs(record)}
    assert {n for n in os.listdir(table.versions.path) if n.startswith("run-")} == named


def test_timeline_skips_the_rest_of_every_run(spark, scratch):
    table = AuthorTable(spark, os.path.join(scratch, "t"))
    for n in range(2):
        table.add(_tweets(spark, 100 * n, 100 * n + 100), partitions=2)
    plan = user_timeline(table.read(), "user_3", 5)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(author_username,user_3)" in plan


def test_two_writers_both_add(spark, scratch, monkeypatch):
    one, two = (AuthorTable(spark, os.path.join(scratch, "t")) for _ in range(2))
    one.add(_tweets(spark, 0, 10))
    real, raced = one.versions.point_at, []

    def point_at(*args, **kwargs):
        if not raced:
            raced.append(two.add(_tweets(spark, 10, 20)))
        return real(*args, **kwargs)

    monkeypatch.setattr(one.versions, "point_at", point_at)
    assert one.add(_tweets(spark, 20, 30)) == 10 and raced == [10]
    assert one.read().count() == 30


def test_overtaken_merge_is_dropped(spark, scratch, monkeypatch):
    table = AuthorTable(spark, os.path.join(scratch, "t"), fan=2)
    table.add(_tweets(spark, 0, 10))
    real, calls = table.versions.point_at, []

    def point_at(*args, **kwargs):
        calls.append(1)
        if len(calls) == 2:  # the merge
            raise Overtaken("another writer")
        return real(*args, **kwargs)

    monkeypatch.setattr(table.versions, "point_at", point_at)
    table.add(_tweets(spark, 10, 20))
    assert len(table.runs()) == 2 and table.read().count() == 20


def test_cli_adds_runs(spark, scratch):
    topic, out = event_topic(spark, SF), os.path.join(scratch, "t")
    for _ in range(2):
        assert cli.main(["index-timelines", "t", "--input-path", topic, "--out", out, "--add"], spark) == 0
    assert read_author_table(spark, out).count() == 2 * valid_tweets(parse_tweets(read_event_messages(spark, SF))).count()
    assert cli.main(["timeline", "t", "--table", out, "--user", "user_7", "--max-tweets", "4", "--sink-base", scratch, "--preview", "0"], spark) == 0
    assert spark.read.parquet(os.path.join(scratch, "timeline")).count() == 4
    empty = os.path.join(scratch, "none")
    AuthorTable(spark, empty).versions.point_at(None, runs=[])
    with pytest.raises(ValueError, match="no tweets"):
        read_author_table(spark, empty)
