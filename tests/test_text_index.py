"""The trigram index of texts."""

import os

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chirpstat.functions.parse import parse_tweets
from chirpstat.operators.quality import valid_tweets
from chirpstat.operators.select import text_search
from chirpstat.sources.fixtures import read_event_messages
from chirpstat.sources.text_index import TextIndex, folded, ranges, trigrams
from chirpstat.sources.versions import Overtaken

SF = "/root/testdata/sf0.001"


def _tweets(spark, rows):
    frame = spark.createDataFrame([(str(i), t, "en") for i, t in rows], "id string, text string, lang string")
    return frame.withColumn("created_at", F.expr("CAST(TIMESTAMP_NTZ '2024-01-01 00:00:00' AS timestamp_ntz) + make_interval(0, 0, 0, 0, 0, 0, CAST(id AS int))"))


@given(st.sets(st.integers(0, 200), min_size=1), st.integers(1, 6))
@settings(max_examples=60, deadline=None)
def test_ranges_cover_the_blocks(blocks, most):
    got = ranges(list(blocks), most)
    assert len(got) <= most and all(any(lo <= b <= hi for lo, hi in got) for b in blocks)
    assert all(lo in blocks and hi in blocks for lo, hi in got) and all(a[1] < b[0] for a, b in zip(got, got[1:]))
    assert ranges([]) == []


def test_trigrams(spark):
    rows = [("aBcAbc",), ("ab",), ("",), (None,), ("ΟΔΟΣ",), ("😀ab",)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(trigrams(folded(F.col("t")))).collect()]
    assert got == [["abc", "bca", "cab"], [], [], [], ["οδο", "δοσ"], ["😀ab"]]


def test_search_equals_a_full_scan(spark, scratch):
    raw = read_event_messages(spark, SF)
    index = TextIndex(spark, os.path.join(scratch, "t"), block_rows=16)
    with pytest.raises(ValueError):
        index.search("x")
    valid = valid_tweets(parse_tweets(raw))
    for part in range(2):
        assert index.add(parse_tweets(raw.where(f"offset % 2 = {part}"))) > 0
    assert index.add(parse_tweets(raw.limit(0))) == 0
    some = valid.orderBy("id").first().text
    for again in range(2):
        assert index.read().count() == valid.count() and len(index.runs()) == 2 - again
        for phrase in (some, some[3:9], some[:2], some.upper(), "", "no such phrase", "%"):
            for case in (False, True):
                n = 100_000 if phrase == some[3:9] else 10
                want = text_search(valid, phrase, n=n, ignore_case=case).collect()
                assert index.search(phrase, n=n, ignore_case=case).collect() == want
            assert index.search(phrase, max_blocks=1).collect() == text_search(valid, phrase).collect()
        index.compact()


def test_case_folding_keeps_matches(spark, scratch):
    index = TextIndex(spark, os.path.join(scratch, "c"), block_rows=1)
    tweets = _tweets(spark, [(1, "ΟΔΟΣΑ x"), (2, "İstanbul ve ÇAĞ"), (3, "straße"), (4, None), (5, "")])
    index.add(tweets)
    for phrase in ("ΟΔΟΣ", "οδοσ", "İst", "i̇st", "çağ", "ÇAĞ", "STRASSE", "straße", "𝒳"):
        assert index.search(phrase, ignore_case=True).collect() == text_search(tweets, phrase, ignore_case=True).collect()
        assert index.search(phrase).collect() == text_search(tweets, phrase).collect()


def _scanned(frame):
    """Rows that the scans of a collected query gave."""
    rows, todo = 0, [frame._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan parquet"):
            rows += node.metrics().apply("numOutputRows").value()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return rows


def test_row_groups_are_skipped(spark, scratch):
    index = TextIndex(spark, os.path.join(scratch, "s"), block_rows=64, row_group_bytes=16 << 10)
    rows = [(i, f"tweet {i * 7919:09x} of many about nothing" + (" with a needle" if i in (500, 15_000) else "")) for i in range(20_000)]
    index.add(_tweets(spark, rows))
    run = index.runs()[0]
    found = index.blocks(run, "a needle")
    assert 1 <= len(found) <= 2
    groups = read = 0
    folder = index._folder(run, "tweets")
    for name in os.listdir(folder):
        if name.endswith(".parquet"):
            meta = pq.ParquetFile(os.path.join(folder, name)).metadata
            at = next(k for k in range(meta.num_columns) if meta.schema.column(k).path == "_block")
            for g in range(meta.num_row_groups):
                stats = meta.row_group(g).column(at).statistics
                groups += 1
                read += any(stats.min <= hi and lo <= stats.max for lo, hi in ranges(found))
    assert groups > 20 and read <= 4
    got = index.search("a needle")
    assert [r.id for r in got.collect()] == ["15000", "500"]
    assert "PushedFilters" in got._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    whole = text_search(index.read(), "a needle")
    whole.collect()
    assert _scanned(whole) == 20_000 and 0 < _scanned(got) <= 20_000 * read // groups + 2_000


def test_a_second_writer_does_not_lose_runs(spark, scratch, monkeypatch):
    path = os.path.join(scratch, "w")
    index = TextIndex(spark, path, block_rows=4)
    index.add(_tweets(spark, [(1, "one")]))
    index.add(_tweets(spark, [(2, "two")]))
    write = index._write

    def overtaken(tweets):
        run = write(tweets)
        TextIndex(spark, path, block_rows=4).add(_tweets(spark, [(3, "three")]))
        return run

    monkeypatch.setattr(index, "_write", overtaken)
    with pytest.raises(Overtaken):
        index.compact()
    assert sorted(r.id for r in index.read().collect()) == ["1", "2", "3"]
