"""Results that are replaced as a whole: version records, staged swaps, one evaluation."""

import json
import os

import pytest
from pyspark.sql import functions as F

from chirpstat.session import create_text, land_counted, list_names, read_text
from chirpstat.sources import io
from chirpstat.sources.io import Sink, read_result, write_result
from chirpstat.sources.versions import Overtaken, Versions

LAYOUTS = pytest.mark.parametrize("layout", ["plain", "versions"])


def _numbers(df):
    return sorted(r[0] for r in df.collect())


def _failing(spark):
    """Rows of which a task writes some, then dies."""
    boom = F.when(F.col("id") == 900, F.raise_error(F.lit("task dies"))).otherwise(F.col("id"))
    return spark.range(0, 1000, 1, 4).select(boom.cast("long").alias("id"))


@LAYOUTS
def test_result_is_replaced(spark, scratch, layout):
    sink = Sink(base=scratch, layout=layout)
    assert read_result(spark, "r", sink) is None
    for n in (3, 5, 2):
        assert write_result(spark.range(n), "r", sink)
        assert _numbers(read_result(spark, "r", sink)) == list(range(n))
    if layout == "plain":
        assert os.listdir(scratch) == ["r"] and _numbers(spark.read.parquet(f"{scratch}/r")) == [0, 1]
    else:
        assert len(os.listdir(f"{scratch}/r")) == 3  # two versions and the records


@LAYOUTS
@pytest.mark.parametrize("on_empty", ["skip", "overwrite"])
def test_failing_task_leaves_the_previous_result(spark, scratch, layout, on_empty):
    sink = Sink(base=scratch, layout=layout, on_empty=on_empty)
    write_result(spark.range(3), "r", sink)
    with pytest.raises(Exception, match="task dies"):
        write_result(_failing(spark), "r", sink)
    assert _numbers(read_result(spark, "r", sink)) == [0, 1, 2]
    assert [n for n in os.listdir(scratch) if n != "r"] == []
    assert write_result(spark.range(4), "r", sink) and _numbers(read_result(spark, "r", sink)) == [0, 1, 2, 3]


@pytest.mark.parametrize("dies_at", [1, 2, 3])
def test_plain_swap_that_dies_between_its_renames(spark, scratch, dies_at, monkeypatch):
    sink = Sink(base=scratch)
    write_result(spark.range(3), "r", sink)
    moves = []

    def move(session, path, to, real=io.move_path):
        moves.append(to)
        if len(moves) == dies_at:
            raise KeyboardInterrupt  # the driver is killed here
        real(session, path, to)

    monkeypatch.setattr(io, "move_path", move)
    with pytest.raises(KeyboardInterrupt):
        write_result(spark.range(5), "r", sink)
    monkeypatch.undo()
    # once the new result is whole it may already be the one that is read; before that, the old one is
    assert _numbers(read_result(spark, "r", sink)) == ([0, 1, 2] if dies_at < 3 else [0, 1, 2, 3, 4])
    assert write_result(spark.range(2), "r", sink)
    assert _numbers(spark.read.parquet(f"{scratch}/r")) == [0, 1] and os.listdir(scratch) == ["r"]


def test_old_result_goes_back_if_no_new_one_is_whole(spark, scratch):
    sink = Sink(base=scratch)
    write_result(spark.range(3), "r", sink)
    os.rename(f"{scratch}/r", f"{scratch}/_old-r")
    assert _numbers(read_result(spark, "r", sink)) == [0, 1, 2]
    assert write_result(spark.range(0), "r", sink) is False
    assert _numbers(spark.read.parquet(f"{scratch}/r")) == [0, 1, 2]


@LAYOUTS
def test_skipped_and_written_results_are_evaluated_once(spark, scratch, layout):
    runs = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(i):
        runs.add(1)
        return i

    rows = spark.range(100).select(counted.asNondeterministic()("id").alias("id"))
    sink = Sink(base=scratch, layout=layout)
    assert write_result(rows, "full", sink) and runs.value == 100
    assert write_result(rows.where("id < 0"), "full", sink) is False and runs.value == 200
    assert _numbers(read_result(spark, "full", sink)) == list(range(100))
    assert write_result(rows.where("id < 0"), "none", sink) is False and read_result(spark, "none", sink) is None
    assert write_result(rows.where("id < 0"), "full", Sink(base=scratch, layout=layout, on_empty="overwrite"))
    assert read_result(spark, "full", sink).count() == 0 and runs.value == 400


def test_appends_are_evaluated_once_and_skipped(spark, scratch):
    sink = Sink(base=scratch, mode="append")
    assert write_result(spark.range(2), "r", sink) and write_result(spark.range(2), "r", sink)
    assert write_result(spark.range(0), "r", sink) is False
    assert _numbers(spark.read.parquet(f"{scratch}/r")) == [0, 0, 1, 1]


def test_counts_of_a_landing(spark):
    rows = spark.createDataFrame([("1",), (None,), ("2",), (None,)], "id string")
    landed, found = land_counted(rows, spark, "t", missing=F.count_if(F.col("id").isNull()))
    assert found == {"rows": 4, "missing": 2} and landed.count() == 4
    assert land_counted(rows.limit(0), spark, "t", most=F.max("id"))[1] == {"rows": 0, "most": 0}


def test_reader_of_an_older_version_is_not_disturbed(spark, scratch):
    sink = Sink(base=scratch, layout="versions")
    write_result(spark.range(3), "r", sink)
    reading = read_result(spark, "r", sink)
    write_result(spark.range(5), "r", sink)
    assert _numbers(reading) == [0, 1, 2]


def test_cut_off_record_is_passed_over(spark, scratch):
    table = Versions(spark, scratch)
    spark.range(3).write.parquet(table.folder("a"))
    table.point_at("a")
    number = 2
    assert create_text(spark, f"{scratch}/_records/{number:012d}", '{"version": "b", "no')
    assert table.last().version == "a" and [r.version for r in table.records()] == ["a"]
    spark.range(4).write.parquet(table.folder("c"))
    assert table.point_at("c").number == 3 and table.read().count() == 4


def test_two_writers(spark, scratch):
    a, b = Versions(spark, scratch), Versions(spark, scratch)
    first = a.point_at("x")
    assert b.point_at("y", first, follow=True).number == 2
    with pytest.raises(Overtaken):
        a.point_at("z", first, follow=True)
    with pytest.raises(Overtaken):
        a.point_at("z", None, follow=True)
    assert a.point_at("w").number == 3 and b.last().version == "w"
    assert not create_text(spark, f"{scratch}/_records/{3:012d}", "{}")
    assert json.loads(read_text(spark, f"{scratch}/_records/{3:012d}")) == {"notes": {}, "version": "w"}


def test_prune_keeps_what_is_pointed_at_and_young_folders(spark, scratch):
    table = Versions(spark, scratch)
    for v in "abcd":
        spark.range(1).write.parquet(table.folder(v))
        if v != "d":  # d is being written by someone
            table.point_at(v)
    table.prune(keep=2)
    assert list_names(spark, scratch) == ["_records", "b", "c", "d"]
    table.prune(keep=1, abandoned_after=0)
    assert list_names(spark, scratch) == ["_records", "c"] and table.read().count() == 1
