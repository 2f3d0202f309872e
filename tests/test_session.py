"""Shared-folder helpers."""

import os

from chirpstat.session import cached, checkpoint_root, land, path_exists, scratch_path


def test_checkpoint_root_is_the_session_setting(spark):
    assert checkpoint_root(spark) == spark.sparkContext.getCheckpointDir()


def test_scratch_paths_are_fresh_and_under_the_root(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(checkpoint_root(spark))


def test_land_round_trip_cuts_lineage(spark):
    df = spark.range(100).selectExpr("id", "id * 2 AS twice")
    landed = land(df, spark, "t")
    assert sorted(map(tuple, landed.collect())) == sorted(map(tuple, df.collect()))
    plan = landed._jdf.queryExecution().optimizedPlan().toString()
    assert "Range" not in plan and "Relation" in plan


def test_cached_releases(spark):
    df = spark.range(10)
    with cached(df) as d:
        assert d.count() == 10
        assert d.is_cached
    assert not df.is_cached


def test_path_exists(spark, scratch):
    assert path_exists(spark, scratch)
    assert not path_exists(spark, os.path.join(scratch, "nope"))
