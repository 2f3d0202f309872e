"""Author counts as a file table that changes by the changed rows only."""

import os
import random

import pytest
from tests_util import sorted_rows

from chirpstat.functions.parse import parse_tweets
from chirpstat.functions.schema import AUTHOR_KEYS, RAW_MESSAGE_SCHEMA
from chirpstat.operators import analyses as A
from chirpstat.operators.quality import valid_tweets
from chirpstat.plans import cli
from chirpstat.sources.fixtures import event_topic, read_event_messages
from chirpstat.sources.versions import Overtaken
from chirpstat.streaming import stream as S
from chirpstat.streaming.keyed_table import KeyedTable, read_keyed

SF = "/root/testdata/sf0.001"


def _table(spark, scratch, run="one", **limits):
    checkpoint = os.path.join(scratch, f"ck-{run}")
    os.makedirs(checkpoint, exist_ok=True)
    with open(os.path.join(checkpoint, "metadata"), "w") as f:
        f.write('{"id": "%s"}' % run)
    return KeyedTable(spark, os.path.join(scratch, "table"), checkpoint, ["k", "j"], **limits)


def _batch(spark, rows):
    return spark.createDataFrame([(k, j, n) for (k, j), n in rows.items()], "k string, j int, n long")


def test_batches_merge_to_the_last_row_of_every_key(spark, scratch):
    """Null keys, keys that come back, merges of both kinds; folders that do not count are removed."""
    draw = random.Random(3)
    table, want, kinds = _table(spark, scratch, most_changes=2, most_changed=0.7), {}, set()
    for n in range(9):
        keys = [(draw.choice([None, "a", "b"]), draw.choice([None, *range(12)])) for _ in range(30 if n == 0 else 4)]
        rows = {key: 100 * n + i for i, key in enumerate(dict.fromkeys(keys))}
        table.write(_batch(spark, rows), n)
        want |= rows
        got = {(r.k, r.j): r.n for r in read_keyed(spark, table.versions.path).collect()}
        assert got == want
        notes = table.versions.last().notes
        kinds |= {f.rsplit("-", 1)[0] for f in notes["changes"]} | ({"merged"} if not notes["changes"] else set())
    assert {"merged", "changes-merged"} <= kinds
    named = {f for r in table.versions.records() for f in [r.notes["base"], *r.notes["changes"]] if f}
    assert {n for n in os.listdir(table.versions.path) if n[0] != "_"} == named


def test_output_of_a_batch_is_its_changed_rows(spark, scratch):
    table = _table(spark, scratch)
    table.write(_batch(spark, {(f"a{i}", 0): 1 for i in range(400)}), 0)
    base = table.versions.last().notes["base"]
    for n in range(1, 6):
        table.write(_batch(spark, {(f"a{i}", 0): n + 1 for i in range(10 * n, 10 * n + 7)}), n)
        notes = table.versions.last().notes
        assert notes["base"] == base  # not rewritten
        assert spark.read.parquet(table.versions.folder(notes["changes"][-1])).count() == 7
    assert notes["changed_rows"] == 35 and read_keyed(spark, table.versions.path).count() == 400


def test_batch_that_is_done_again_changes_nothing(spark, scratch):
    table = _table(spark, scratch)
    for n in (0, 1, 1):
        table.write(_batch(spark, {("a", n): n, ("b", 0): n}), n)
    assert sorted((r.k, r.j, r.n) for r in read_keyed(spark, table.versions.path).collect()) == [("a", 0, 0), ("a", 1, 1), ("b", 0, 1)]
    table.write(_batch(spark, {}), 2)  # nothing changed
    assert read_keyed(spark, table.versions.path).count() == 3


def test_a_write_that_dies_leaves_the_table(spark, scratch):
    from pyspark.sql import functions as F

    table = _table(spark, scratch)
    table.write(_batch(spark, {("a", 1): 1}), 0)
    dies = _batch(spark, {("a", 1): 5, ("b", 1): 5}).withColumn("n", F.when(F.col("k") == "b", F.raise_error(F.lit("dies"))).otherwise(F.col("n")).cast("long"))
    with pytest.raises(Exception, match="dies"):
        table.write(dies, 1)
    assert [tuple(r) for r in read_keyed(spark, table.versions.path).collect()] == [("a", 1, 1)]
    table.write(_batch(spark, {("a", 1): 5}), 1)
    assert [tuple(r) for r in read_keyed(spark, table.versions.path).collect()] == [("a", 1, 5)]


def test_new_run_begins_empty_and_the_old_one_is_shut_out(spark, scratch):
    one, two = _table(spark, scratch, "one"), _table(spark, scratch, "two")
    one.write(_batch(spark, {("a", 1): 1}), 0)
    two.claim("two")
    assert read_keyed(spark, one.versions.path) is None
    with pytest.raises(Overtaken):
        one.write(_batch(spark, {("a", 1): 2}), 1)
    two.write(_batch(spark, {("b", 1): 1}), 0)
    assert [tuple(r) for r in read_keyed(spark, one.versions.path).collect()] == [("b", 1, 1)]


def test_stream_equals_batch_over_a_restart(spark, scratch):
    raw, source = read_event_messages(spark, SF), os.path.join(scratch, "src")
    want = sorted_rows(A.top_tweeters(valid_tweets(parse_tweets(raw))))
    checkpoint = os.path.join(scratch, "ck")
    for half in (0, 1):
        raw.where(f"offset % 2 = {half}").repartition(3).write.mode("append").parquet(source)
        stream = spark.readStream.schema(RAW_MESSAGE_SCHEMA).option("maxFilesPerTrigger", 2).parquet(source)
        got = S.run_keyed(spark, S.top_tweeters_stream(stream), AUTHOR_KEYS, "t", checkpoint, state_partitions=2)
    assert sorted_rows(got) == want
    offsets = os.path.join(checkpoint, "offsets")
    with open(os.path.join(offsets, max(n for n in os.listdir(offsets) if n.isdigit()))) as f:
        assert "RocksDBStateStoreProvider" in f.read()
    assert spark.conf.get(S.STATE_STORE, None) != S.ROCKSDB  # the session keeps its own


def test_cli_writes_a_keyed_table(spark, scratch):
    args = ["stream-top-tweeters", "t", "--input-path", event_topic(spark, SF), "--checkpoint", os.path.join(scratch, "ck"),
            "--sink-base", scratch, "--keyed", "--available-now", "--state-partitions", "2"]
    assert cli.main(args, spark) == 0
    want = A.top_tweeters(valid_tweets(parse_tweets(read_event_messages(spark, SF))))
    assert sorted_rows(read_keyed(spark, os.path.join(scratch, "top_tweeters"))) == sorted_rows(want)
