"""Physical-plan properties that matter at scale, checked on the real plans."""

import re

import pytest

import __spark_entry__ as E
from chirpstat.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


def plan_text(df, capsys):
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


@pytest.mark.parametrize("name", ["top_tweeters", "famous_top_tweeters", "low_follower_activity", "user_timeline", "daily_trend_valid"])
def test_one_json_parse_per_message(spark, capsys, name):
    text = plan_text(E.queries()[name](spark, SF), capsys)
    # The message is parsed in exactly one place: the generator. A filter on
    # `id` must not carry a second from_json of its own.
    assert text.count("from_json(") == 1, text
    assert "inline(array(from_json(" in text


@pytest.mark.parametrize("name", ["top_tweeters", "daily_trend", "count_invalid", "text_search"])
def test_scan_reads_only_the_message_column(spark, capsys, name):
    text = plan_text(E.queries()[name](spark, SF), capsys)
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", text)
    assert schemas and all(s == "struct<value:binary>" for s in schemas), schemas


@pytest.mark.parametrize("name", ["top_tweeters_top10", "famous_top10", "low_follower_top10", "daily_trend_top10", "user_timeline", "text_search"])
def test_top_n_has_no_global_sort(spark, capsys, name):
    text = plan_text(E.queries()[name](spark, SF), capsys)
    assert "TakeOrderedAndProject" in text
    assert "rangepartitioning" not in text


@pytest.mark.parametrize("name", ["top_tweeters", "fame_distribution", "daily_trend", "low_follower_activity"])
def test_aggregates_are_partial_then_final(spark, capsys, name):
    text = plan_text(E.queries()[name](spark, SF), capsys)
    assert re.search(r"partial_(count|sum|max)", text)
    assert text.count("hashpartitioning") == 1
    assert "BroadcastExchange" not in text and "CartesianProduct" not in text


def test_parse_is_pruned_to_needed_fields(spark, capsys):
    text = plan_text(E.queries()["top_tweeters"](spark, SF), capsys)
    gen = next(line for line in text.splitlines() if "inline(array(from_json" in line)
    assert "author_username" in gen and "follower_count" not in gen and "text" not in gen.split("cast(")[0]


@pytest.mark.parametrize("name", ["job_top_tweeters", "job_famous_top_tweeters", "job_low_follower_activity", "job_fame_distribution"])
def test_job_results_are_what_the_job_has_written(spark, capsys, name):
    text = plan_text(E.queries()[name](spark, SF), capsys)
    assert "from_json(" not in text and "partitioning" not in text
    assert "/user-analysis-" in text


def test_explain_summary_tool(spark):
    from chirpstat.plans.explain import plan_text, summarize

    line = summarize(plan_text(E.queries()["top_tweeters_top10"](spark, SF)))
    assert "json_parses=1 hash_shuffles=1 range_shuffles=0 top_n=1 broadcasts=0" in line
    assert "scans=struct<value:binary>" in line


def test_every_query_reads_only_data_derived_from_the_events_table(spark, capsys):
    for name, query in QUERIES.items():
        text = plan_text(query(spark, SF), capsys)
        locations = re.findall(r"Location: \w+ \[([^\]]*)\]", text)
        assert locations, name
        for loc in locations:
            # the published events topic, or tables Spark derived from it in the shared folder
            assert "/chirpstat/" in loc, (name, loc)
