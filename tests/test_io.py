"""Sources and sinks: option sets, Parquet stand-ins, empty-result rule, errors."""

import json
import os

import pytest
from conftest import messages

from chirpstat.functions.parse import parse_tweets
from chirpstat.sources import io


def test_kafka_read_options():
    opts = io.kafka_read_options("h:9092", "raw-tweets-stream")
    assert opts == {"kafka.bootstrap.servers": "h:9092", "subscribe": "raw-tweets-stream", "startingOffsets": "earliest"}
    opts = io.kafka_read_options("h:9092", "t", ending_offsets="latest", extra={"minPartitions": "64"})
    assert opts["endingOffsets"] == "latest" and opts["minPartitions"] == "64"


def test_kafka_write_options():
    assert io.kafka_write_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "topic": "t"}


def test_mongo_sink_options():
    sink = io.mongo_sink("tweet_results", "mongodb://x:27017")
    opts = sink.writer_options("top_tweeters")
    assert opts == {"database": "tweet_results", "connection.uri": "mongodb://x:27017", "collection": "top_tweeters"}
    assert sink.target("top_tweeters") is None and sink.mode == "overwrite"


def test_write_result_parquet_round_trip(spark, scratch):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    sink = io.Sink(base=scratch)
    assert io.write_result(df, "res", sink)
    back = spark.read.parquet(os.path.join(scratch, "res"))
    assert sorted(map(tuple, back.collect())) == [("a", 1), ("b", 2)]


def test_empty_result_skips_and_keeps_previous(spark, scratch):
    sink = io.Sink(base=scratch)
    io.write_result(spark.createDataFrame([("a", 1)], "k string, n int"), "res", sink)
    empty = spark.createDataFrame([], "k string, n int")
    assert io.write_result(empty, "res", sink) is False
    assert spark.read.parquet(os.path.join(scratch, "res")).count() == 1
    # With on_empty="overwrite" the empty result replaces it.
    assert io.write_result(empty, "res", io.Sink(base=scratch, on_empty="overwrite"))
    assert spark.read.parquet(os.path.join(scratch, "res")).count() == 0


def test_failing_sink_raises(spark, scratch):
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    with pytest.raises(Exception):
        io.write_result(df, "res", io.Sink(fmt="no_such_format_xyz", base=scratch))


def test_kafka_source_absent_is_an_error(spark):
    # No connector on the class path here: the scan fails loudly, it does not return None.
    with pytest.raises(Exception):
        io.read_topic(spark, "localhost:1", "t").schema


def test_to_messages_passes_value_or_encodes(spark):
    raw = messages(spark, ['{"id":"1"}'])
    assert io.to_messages(raw).first().value == b'{"id":"1"}'
    typed = spark.createDataFrame([("1", None)], "id string, text string")
    assert io.to_messages(typed).first().value == b'{"id":"1"}'


def test_archive_append_and_dedupe(spark, scratch):
    msgs = [json.dumps({"id": "1", "text": "a"}), json.dumps({"id": "1", "text": "a"}), "junk", "junk", json.dumps({"id": "2"})]
    raw = messages(spark, msgs)
    target = os.path.join(scratch, "archive")
    io.archive_raw(raw, target)
    io.archive_raw(raw, target, dedupe=True)
    back = spark.read.parquet(target)
    # 5 appended as they are, then 4 (one copy of id 1; both id-less kept).
    assert back.count() == 9
    assert parse_tweets(back).filter("id = '1'").count() == 3


def test_dedupe_keeps_the_same_message_whatever_the_order(spark):
    from pyspark.sql import functions as F

    rows = [(json.dumps({"id": i, "text": t}).encode(), 0, o) for i, t, o in [("1", "b", 5), ("1", "a", 9), ("2", "x", 1), ("2", "x", 1)]]
    rows += [(b"junk", 0, 7), (b"junk", 0, 8), (None, 0, 9)]
    for order in (rows, rows[::-1]):
        with_offsets = spark.createDataFrame(order, "value binary, partition int, offset long").repartition(3)
        kept = sorted(bytes(r.value or b"") for r in io.dedupe_by_id(with_offsets).collect())
        assert kept == sorted([rows[0][0], rows[2][0], b"junk", b"junk", b""])
        bare = io.dedupe_by_id(with_offsets.select("value"))
        assert bare.columns == ["value"] and rows[1][0] in {bytes(r.value or b"") for r in bare.collect()}
    plan = io.dedupe_by_id(with_offsets)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1  # one parse, of one read
    null_keys = io.dedupe_by_id(spark.range(50).select(F.lit(b"junk").alias("value")))
    assert null_keys.count() == 50


def test_dedupe_reads_every_message_once(spark):
    from pyspark.sql import functions as F

    reads = spark.sparkContext.accumulator(0)

    @F.udf("binary")
    def counted(i):
        reads.add(1)
        return json.dumps({"id": str(i % 100)}).encode()

    raw = spark.range(1000).select(counted.asNondeterministic()("id").alias("value"))
    assert io.dedupe_by_id(raw).count() == 100
    assert reads.value == 1000


def test_documents_lose_nothing(spark):
    texts = ['{"id":"1","edit_history_tweet_ids":["1"],"lang":"tr"}', "junk", "", None, "[1]"]
    got = io.documents(messages(spark, texts)).collect()
    assert sorted((r.raw or "") for r in got) == sorted(t or "" for t in texts)
    by_raw = {r.raw: r for r in got}
    assert by_raw[texts[0]].id == "1" and by_raw[texts[0]].lang == "tr" and by_raw["junk"].id is None


def test_document_types_are_utc_instants(spark, zone):
    import datetime as dt

    frame = spark.sql("SELECT TIMESTAMP_NTZ '2018-11-04 00:30:00' AS day, 1 AS n, CAST(NULL AS TIMESTAMP_NTZ) AS none")
    got = io.document_types(frame)
    assert [t for _, t in got.dtypes] == ["timestamp", "int", "timestamp"]
    row = got.selectExpr("unix_seconds(day) AS s", "n", "none").first()
    assert row.s == dt.datetime(2018, 11, 4, 0, 30, tzinfo=dt.timezone.utc).timestamp() and row.none is None


def test_streams_are_rate_limited_unless_told():
    opts = io.stream_read_options({"subscribe": "t", "endingOffsets": "latest"})
    assert opts == {"subscribe": "t", "maxOffsetsPerTrigger": str(io.RECORDS_PER_TRIGGER)}
    assert io.stream_read_options({"maxOffsetsPerTrigger": "5"})["maxOffsetsPerTrigger"] == "5"


def test_archive_to_document_store_fails_loudly_without_connector(spark):
    raw = messages(spark, ['{"id":"1"}'])
    with pytest.raises(Exception):
        io.archive_raw(raw, "raw_tweets", fmt="mongodb", database="tweet_results")


def test_topic_scan_spreads_over_cores_unless_told(spark):
    opts = io._spread(spark, io.kafka_read_options("h:1", "t"))
    assert opts["minPartitions"] == str(spark.sparkContext.defaultParallelism)
    assert opts["maxRecordsPerPartition"] == str(io.RECORDS_PER_TASK)
    opts = io._spread(spark, io.kafka_read_options("h:1", "t", extra={"minPartitions": "7"}))
    assert opts["minPartitions"] == "7"


def test_json_lines_text_files_are_a_message_source(spark, scratch):
    msgs = [json.dumps({"id": "1", "author_id": "a", "created_at": "2024-01-01T00:00:00Z"}), "junk", json.dumps({"id": "2"})]
    path = os.path.join(scratch, "jsonl")
    spark.createDataFrame([(m,) for m in msgs], "value string").coalesce(1).write.text(path)
    text_rows = parse_tweets(io.read_messages(spark, path, fmt="text"))
    bin_rows = parse_tweets(messages(spark, msgs))
    assert sorted(map(tuple, text_rows.collect()), key=str) == sorted(map(tuple, bin_rows.collect()), key=str)
