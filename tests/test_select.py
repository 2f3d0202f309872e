"""User timeline and text search: order, limits, language and retweet rules."""

import json

from conftest import messages
from pyspark.sql import functions as F

from chirpstat.functions.parse import parse_tweets
from chirpstat.operators.quality import valid_tweets
from chirpstat.operators.select import text_search, user_timeline


def tweets(spark, rows):
    return valid_tweets(parse_tweets(messages(spark, [json.dumps(r) for r in rows])))


def t(id_, user="u", text="hello", at="2024-01-01T00:00:00Z", lang="tr"):
    return {"id": id_, "author_username": user, "text": text, "created_at": at, "lang": lang}


def test_timeline_newest_first_ties_by_id_and_limit(spark):
    rows = [t("1", at="2024-01-01T00:00:00Z"), t("2", at="2024-01-03T00:00:00Z"), t("3", at="2024-01-03T00:00:00Z"),
            t("4", at=None), t("5", user="other", at="2024-02-01T00:00:00Z")]
    got = [r.id for r in user_timeline(tweets(spark, rows), "u", n=10).collect()]
    assert got == ["3", "2", "1", "4"]
    assert [r.id for r in user_timeline(tweets(spark, rows), "u", n=2).collect()] == ["3", "2"]
    assert user_timeline(tweets(spark, rows), "nobody").count() == 0


def test_search_phrase_lang_and_retweets(spark):
    rows = [t("1", text="big data now"), t("2", text="RT @x: big data now"), t("3", text="Big Data"),
            t("4", text="big data", lang="en"), t("5", text=None)]
    df = tweets(spark, rows)
    assert [r.id for r in text_search(df, "big data", "tr").collect()] == ["1"]
    assert sorted(r.id for r in text_search(df, "big data", "tr", exclude_retweets=False).collect()) == ["1", "2"]
    assert sorted(r.id for r in text_search(df, "big data", None).collect()) == ["1", "4"]
    assert sorted(r.id for r in text_search(df, "BIG data", "tr", ignore_case=True).collect()) == ["1", "3"]


def test_selection_columns(spark):
    df = tweets(spark, [t("1")])
    assert user_timeline(df, "u").columns == ["id", "created_at", "text"]
    assert text_search(df, "hello").columns == ["id", "created_at", "text"]


def test_timeline_over_author_layout_prunes_and_matches(spark, scratch, capsys):
    import os

    from chirpstat.operators.select import write_by_author
    from chirpstat.sources.fixtures import read_event_messages

    tweets = valid_tweets(parse_tweets(read_event_messages(spark, "/root/testdata/sf0.01")))
    path = os.path.join(scratch, "by_author")
    write_by_author(tweets, path, partitions=8)
    table = spark.read.parquet(path)
    got = user_timeline(table, "user_7", n=10)
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in user_timeline(tweets, "user_7", n=10).collect()]
    capsys.readouterr()
    got.explain("formatted")
    assert "EqualTo(author_username,user_7)" in capsys.readouterr().out
    # Each file holds a narrow, disjoint range of authors.
    ranges = table.groupBy(F.input_file_name().alias("f")).agg(F.min("author_username").alias("lo"), F.max("author_username").alias("hi")).orderBy("lo").collect()
    assert len(ranges) > 1 and all(a.hi <= b.lo for a, b in zip(ranges, ranges[1:]))


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_sel = st.fixed_dictionaries(
    {
        "id": st.text("0123456789", min_size=1, max_size=3),
        "author_username": st.sampled_from(["u", "v"]),
        "text": st.one_of(st.none(), st.sampled_from(["big data", "RT @x: big data", "Big Data now", "other", "xbig datax"])),
        "created_at": st.one_of(st.none(), st.sampled_from(["2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z", "2024-01-02T05:00:00Z"])),
        "lang": st.sampled_from(["tr", "en"]),
    }
)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(_sel, min_size=0, max_size=25), st.integers(1, 6))
def test_selections_against_brute_force(spark, rows, n):
    df = tweets(spark, rows)

    def order(rs):
        with_t = sorted([r for r in rs if r["created_at"]], key=lambda r: (r["created_at"], r["id"]), reverse=True)
        return with_t + sorted([r for r in rs if not r["created_at"]], key=lambda r: r["id"], reverse=True)

    want = [r["id"] for r in order([r for r in rows if r["author_username"] == "u"])][:n]
    assert [r.id for r in user_timeline(df, "u", n=n).collect()] == want

    hits = [r for r in rows if r["text"] and "big data" in r["text"] and r["lang"] == "tr" and not r["text"].startswith("RT @")]
    assert [r.id for r in text_search(df, "big data", "tr", n=n).collect()] == [r["id"] for r in order(hits)][:n]


def test_author_layout_caps_rows_per_file(spark, scratch):
    import os

    from chirpstat.operators.select import write_by_author
    from chirpstat.sources.fixtures import read_event_messages

    tweets = valid_tweets(parse_tweets(read_event_messages(spark, "/root/testdata/sf0.001")))
    path = os.path.join(scratch, "capped")
    write_by_author(tweets, path, partitions=2, rows_per_file=100)
    table = spark.read.parquet(path)
    per_file = [r["n"] for r in table.groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(per_file) <= 100 and sum(per_file) == tweets.count()
    assert [tuple(r) for r in user_timeline(table, "user_7").collect()] == [tuple(r) for r in user_timeline(tweets, "user_7").collect()]


def test_large_n_gives_the_rows_of_small_n(spark):
    from chirpstat.operators.select import newest

    rows = spark.range(5000).selectExpr(
        "CAST(id AS STRING) AS id", "IF(id % 50 = 0, NULL, TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id % 700)) AS created_at",
        "concat('t', id) AS text",
    ).repartition(5)
    for n in (1, 699, 2500, 4999, 5000, 9000):
        want = newest(rows, n, ("id", "created_at")).collect()
        got = newest(rows, n, ("id", "created_at"), merged_rows=0).collect()
        assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) == min(n, 5000), n
    assert newest(rows, 10, ("id",), merged_rows=0).columns == ["id"]


def test_author_layout_reads_every_message_once_and_leaves_invalid_rows_out(spark, scratch):
    import os

    from pyspark.sql import functions as F

    from chirpstat.operators.select import write_by_author

    reads = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(i):
        reads.add(1)
        return str(i) if i % 4 else None

    tweets = spark.range(1000).select(
        counted.asNondeterministic()("id").alias("id"), F.concat(F.lit("u"), F.col("id") % 7).alias("author_username"),
        F.lit(None).cast("timestamp_ntz").alias("created_at"), F.lit("x").alias("text"),
    )
    path = os.path.join(scratch, "by_author")
    write_by_author(tweets, path, partitions=4)
    assert reads.value == 1000
    back = spark.read.parquet(path)
    assert back.count() == 750 and back.where("id IS NULL").count() == 0


def test_large_selection_comes_newest_first(spark):
    from chirpstat.operators.select import newest
    from chirpstat.sources.fixtures import read_event_messages

    rows = valid_tweets(parse_tweets(read_event_messages(spark, "/root/testdata/sf0.001")))
    for n in (7, 300, 5000):
        merged = [r.id for r in newest(rows, n, ["id"]).collect()]
        assert [r.id for r in newest(rows, n, ["id"], merged_rows=5).collect()] == merged
