"""De-duplication of an archive over several appends, by the id index beside it."""

import json
import os

import pytest
from conftest import messages
from pyspark.sql import functions as F

from chirpstat.functions.parse import parse_tweets
from chirpstat.sources import archive_index as ai
from chirpstat.sources.versions import Overtaken


def _messages(spark, ids, text="a"):
    return messages(spark, ["junk" if i is None else json.dumps({"id": str(i), "text": text}) for i in ids])


def _archived(spark, path):
    rows = parse_tweets(spark.read.parquet(path), fields=("id", "text")).collect()
    return sorted((r.id or "", r.text or "") for r in rows)


def test_appends_with_common_ids_keep_one_message_each(spark, scratch):
    path = os.path.join(scratch, "archive")
    assert ai.append_new(_messages(spark, [1, 2, 3, 3, None, None], "a"), path) == {"rows": 5, "ids": 3}
    assert ai.append_new(_messages(spark, [3, 4, 2, None], "b"), path) == {"rows": 2, "ids": 1}
    assert ai.append_new(_messages(spark, [1, 2, 3, 4], "c"), path) == {"rows": 0, "ids": 0}
    assert ai.append_new(_messages(spark, [], "d"), path) == {"rows": 0, "ids": 0}
    assert ai.append_new(_messages(spark, [5], "e"), path) == {"rows": 1, "ids": 1}
    assert _archived(spark, path) == [("", "")] * 3 + [("1", "a"), ("2", "a"), ("3", "a"), ("4", "b"), ("5", "e")]
    index = ai.ArchiveIndex(spark, path + "-ids")
    assert sorted(r.id for r in index.ids().collect()) == ["1", "2", "3", "4", "5"]


def test_first_append_without_any_id(spark, scratch):
    path = os.path.join(scratch, "archive")
    assert ai.append_new(_messages(spark, [None, None]), path) == {"rows": 2, "ids": 0}
    assert ai.append_new(_messages(spark, [1, None]), path) == {"rows": 2, "ids": 1}
    assert ai.append_new(_messages(spark, [1]), path) == {"rows": 0, "ids": 0}


def test_archive_without_an_index_gets_one(spark, scratch):
    path = os.path.join(scratch, "archive")
    _messages(spark, [1, 2, 2, None], "old").write.parquet(path)
    assert ai.append_new(_messages(spark, [2, 3], "new"), path) == {"rows": 1, "ids": 1}
    assert _archived(spark, path) == [("", ""), ("1", "old"), ("2", "old"), ("2", "old"), ("3", "new")]


@pytest.mark.parametrize("step", ["archive", "index"])
def test_append_that_dies_half_way(spark, scratch, step, monkeypatch):
    """Before or after the archive was written: the next append sees what the archive holds."""
    path = os.path.join(scratch, "archive")
    ai.append_new(_messages(spark, [1, 2], "a"), path)

    def die(*args, **kwargs):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(ai, "observed_write", die) if step == "archive" else m.setattr(ai.ArchiveIndex, "finish", die)
        with pytest.raises(KeyboardInterrupt):
            ai.append_new(_messages(spark, [2, 3], "b"), path)
    archived = 2 if step == "archive" else 3
    assert len(_archived(spark, path)) == archived
    assert ai.append_new(_messages(spark, [1, 2, 3, 4], "c"), path)["rows"] == 4 - archived
    assert [i for i, _ in _archived(spark, path)] == ["1", "2", "3", "4"]


def test_an_append_that_was_overtaken_fails(spark, scratch):
    path = os.path.join(scratch, "archive")
    ai.append_new(_messages(spark, [1], "a"), path)
    one, two = (ai.ArchiveIndex(spark, path + "-ids") for _ in range(2))
    begun = one.begin()
    two.make_ready(path)  # takes the first for dead
    with pytest.raises(Overtaken):
        one.finish(begun, spark.createDataFrame([("9",)], "id string"))
    assert [r.id for r in two.ids().collect()] == ["1"]


def test_full_filters_and_merged_runs_lose_nothing(spark, scratch, monkeypatch):
    """Filters that let all ids pass are still followed by an exact look-up; runs are merged."""
    monkeypatch.setattr(ai, "MOST_RUNS", 2)
    path = os.path.join(scratch, "archive")
    merged = 0
    for n in range(4):
        lo, hi = 300 * n, 300 * n + 600  # half of them known
        rows = spark.range(lo, hi).select(F.to_json(F.struct(F.col("id").cast("string").alias("id"))).cast("binary").alias("value"))
        assert ai.append_new(rows, path)["rows"] == (600 if n == 0 else 300)
        notes = ai.ArchiveIndex(spark, path + "-ids").records.last().notes
        assert len(notes["runs"]) <= 2 and notes["ids"] == hi
        merged += n > 0 and len(notes["runs"]) == 1
        kept = [d for d in os.listdir(path + "-ids") if d.startswith("run-")]
        assert sorted(kept) == sorted(notes["runs"])
    assert merged and len(_archived(spark, path)) == 1500
    index = ai.ArchiveIndex(spark, path + "-ids")
    all_set = spark.range(1).select(F.expr(f"unhex(repeat('FF', {ai.FILTER_BITS // 8}))").alias("bits")).first().bits
    run = index.records.last().notes["runs"][0]
    wide = index._read([run], "blooms").select("bucket", F.lit(bytearray(all_set)).alias("bits")).collect()
    spark.createDataFrame(wide, "bucket long, bits binary").write.mode("overwrite").parquet(index._part(run, "blooms"))
    got = index.known(spark.range(1400, 1700).select(F.col("id").cast("string").alias("id")))
    assert sorted(int(r.id) for r in got.collect()) == list(range(1400, 1500))


def test_filters_hold_their_ids_and_few_others(spark):
    ids = spark.range(2_500).select(F.col("id").cast("string").alias("id"))
    bits = ids.select(F.explode(ai.positions(F.col("id"))).alias("p")).agg(F.bitmap_construct_agg("p").alias("bits"))
    test = spark.range(20_000).select(F.col("id").alias("n"), F.col("id").cast("string").alias("id")).crossJoin(bits)
    hit = {r.n for r in test.where(ai.may_hold(F.col("bits"), ai.positions(F.col("id")))).collect()}
    assert set(range(2_500)) <= hit and len(hit) - 2_500 < 17_500 * 0.02


def test_index_is_not_shuffled_when_few_ids_are_known(spark, scratch):
    path = os.path.join(scratch, "archive")
    ai.append_new(_messages(spark, range(50)), path)
    index = ai.ArchiveIndex(spark, path + "-ids")
    found = index.known(_messages(spark, [3]).select(F.lit("3").alias("id")))
    assert [r.id for r in found.collect()] == ["3"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_stream_archives_new_ids_only(spark, scratch):
    from chirpstat.streaming import stream as S

    source, path = os.path.join(scratch, "src"), os.path.join(scratch, "archive")
    for n, ids in enumerate(([1, 2, None], [2, 3], [3, 1, 4])):
        _messages(spark, ids, f"t{n}").coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema("value binary").option("maxFilesPerTrigger", 1).parquet(source)
    q = S.start_archive(stream, path, os.path.join(scratch, "ck"), new_ids_only=True, availableNow=True)
    q.awaitTermination()
    assert q.exception() is None and [i for i, _ in _archived(spark, path)] == ["", "1", "2", "3", "4"]
