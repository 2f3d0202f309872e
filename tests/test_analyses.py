"""Analyses on hand-made tweets and a brute-force comparison on random ones."""

import collections
import json

from conftest import messages
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from chirpstat.functions.parse import parse_tweets
from chirpstat.operators import analyses as A
from chirpstat.operators.quality import count_invalid, valid_tweets, validate_tweets
from chirpstat.plans.jobs import plan_daily_trend


def tweets(spark, rows):
    return parse_tweets(messages(spark, [json.dumps(r) if isinstance(r, dict) else r for r in rows]))


def tw(id_, author="a", user="u", fc=None, day="2024-01-01", rt=None):
    d = {"id": id_, "author_id": author, "author_username": user, "follower_count": fc,
         "created_at": None if day is None else f"{day}T10:00:00Z"}
    if rt is not None:
        d["public_metrics"] = {"retweet_count": rt}
    return d


def test_is_famous_boundaries_and_null(spark):
    rows = [tw(str(i), fc=fc) for i, fc in enumerate([None, 0, 99, 100, 99999, 100000])]
    got = {r.follower_count: r.isFamous for r in A.add_is_famous(tweets(spark, rows)).collect()}
    assert got == {None: False, 0: False, 99: False, 100: False, 99999: False, 100000: True}


def test_low_follower_excludes_null_and_filters_before_grouping(spark):
    rows = [tw("1", fc=5), tw("2", fc=500), tw("3", fc=None), tw("4", author="b", user="v", fc=None)]
    got = [tuple(r) for r in A.low_follower_activity(tweets(spark, rows)).collect()]
    assert got == [("a", "u", 5, 1)]


def test_null_author_is_its_own_group(spark):
    rows = [tw("1", author=None, user=None), tw("2", author=None, user=None), tw("3")]
    got = {(r.author_id, r.author_username): r.tweet_sayisi for r in A.top_tweeters(tweets(spark, rows)).collect()}
    assert got == {(None, None): 2, ("a", "u"): 1}


def test_renamed_author_is_two_groups_and_no_dedup(spark):
    rows = [tw("1", user="old"), tw("1", user="old"), tw("2", user="new")]
    got = {r.author_username: r.tweet_sayisi for r in A.top_tweeters(tweets(spark, rows)).collect()}
    assert got == {"old": 2, "new": 1}


def test_count_id_vs_count_star(spark):
    rows = [tw("1"), tw(None), "junk"]
    df = tweets(spark, rows)
    c = count_invalid(df).first()
    assert (c.total, c.invalid) == (3, 2)
    # Top tweeters counts ids; the daily trend counts every row.
    assert A.top_tweeters(df).filter("author_id = 'a'").first().tweet_sayisi == 1
    assert sum(r.toplam_tweet_sayisi for r in A.daily_trends(df).collect()) == 3


def test_daily_trend_counts_invalid_rows_by_default(spark):
    rows = [tw("1", rt=2), tw(None, rt=3), tw("2", day="2024-01-02", rt=None)]
    raw = messages(spark, [json.dumps(r) for r in rows])
    all_rows = {r.day.day: (r.toplam_tweet_sayisi, r.toplam_retweet_sayisi) for r in plan_daily_trend(spark, raw).collect()}
    assert all_rows == {1: (2, 5), 2: (1, None)}
    valid = {r.day.day: r.toplam_tweet_sayisi for r in plan_daily_trend(spark, raw, drop_invalid=True).collect()}
    assert valid == {1: 1, 2: 1}


def test_daily_trend_null_day_last_and_bigint_sum(spark):
    big = 2_000_000_000
    rows = [tw("1", rt=big), tw("2", rt=big), tw("3", day=None, rt=1)]
    out = A.daily_trends(tweets(spark, rows)).collect()
    assert out[-1].day is None
    assert out[0].toplam_retweet_sayisi == 2 * big


def test_sorted_outputs_have_total_order(spark):
    rows = [tw("1", author="b", user="x", fc=10), tw("2", author="a", user="y", fc=10), tw("3", author="c", user="z", fc=20)]
    df = tweets(spark, rows)
    assert [r.author_id for r in A.famous_top_tweeters(df).collect()] == ["c", "a", "b"]
    assert [r.author_id for r in A.top_tweeters(df).collect()] == ["a", "b", "c"]
    assert [r.author_id for r in A.low_follower_activity(df).collect()] == ["a", "b", "c"]
    assert [r.author_id for r in A.top_n(A.famous_top_tweeters(df), 2).collect()] == ["c", "a"]


def test_validate_is_lazy_and_splits(spark):
    df = tweets(spark, [tw("1"), tw(None)])
    v = validate_tweets(df)
    assert v.valid.count() == 1
    assert v.counts.first().invalid == 1


def test_stats_forms_equal_direct_forms(spark):
    rows = [tw(str(i), author=str(i % 3), user=f"u{i % 3}", fc=[5, 150, 100000, None][i % 4]) for i in range(24)]
    valid = valid_tweets(tweets(spark, rows))
    stats = A.author_stats(valid)

    def s(df):
        return sorted(map(tuple, df.collect()), key=str)

    assert s(A.top_tweeters(valid)) == s(A.top_tweeters_from_stats(stats))
    assert s(A.famous_top_tweeters(valid)) == s(A.famous_top_tweeters_from_stats(stats))
    assert s(A.low_follower_activity(valid)) == s(A.low_follower_activity_from_stats(stats))
    assert s(A.fame_distribution(A.add_is_famous(valid))) == s(A.fame_distribution_from_stats(stats))


# --- brute force on random tweets -----------------------------------------------

tweet_st = st.fixed_dictionaries(
    {
        "id": st.one_of(st.none(), st.sampled_from(["1", "2", "3", "4", "5"])),
        "author_id": st.one_of(st.none(), st.sampled_from(["a", "b", "c"])),
        "author_username": st.sampled_from(["u", "v"]),
        "follower_count": st.one_of(st.none(), st.integers(0, 200_000)),
        "created_at": st.one_of(st.none(), st.sampled_from(["2024-01-01T01:00:00Z", "2024-01-02T23:59:59Z", "bad"])),
        "public_metrics": st.fixed_dictionaries({"retweet_count": st.one_of(st.none(), st.integers(0, 10**9))}),
    }
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(tweet_st, min_size=0, max_size=30))
def test_brute_force(spark, rows):
    df = parse_tweets(messages(spark, [json.dumps(r) for r in rows]))
    valid_rows = [r for r in rows if r["id"] is not None]
    valid = valid_tweets(df)

    # top tweeters
    exp = collections.Counter((r["author_id"], r["author_username"]) for r in valid_rows)
    got = {(r.author_id, r.author_username): r.tweet_sayisi for r in A.top_tweeters(valid).collect()}
    assert got == dict(exp)

    # famous (max ignores nulls)
    exp_max = {}
    for r in valid_rows:
        k = (r["author_id"], r["author_username"])
        fc = r["follower_count"]
        exp_max.setdefault(k, None)
        if fc is not None:
            exp_max[k] = fc if exp_max[k] is None else max(exp_max[k], fc)
    got = {(r.author_id, r.author_username): r.max_follower_count for r in A.famous_top_tweeters(valid).collect()}
    assert got == exp_max

    # low follower: filter then group
    low = [r for r in valid_rows if r["follower_count"] is not None and r["follower_count"] < 100]
    exp_low = {}
    for r in low:
        k = (r["author_id"], r["author_username"])
        m, n = exp_low.get(k, (None, 0))
        exp_low[k] = (r["follower_count"] if m is None else max(m, r["follower_count"]), n + 1)
    got = {(r.author_id, r.author_username): (r.max_follower_count, r.tweet_sayisi)
           for r in A.low_follower_activity(valid).collect()}
    assert got == exp_low

    # fame distribution
    exp_f = collections.Counter((r["follower_count"] or 0) >= 100000 for r in valid_rows)
    got = {r.isFamous: r["count"] for r in A.fame_distribution(A.add_is_famous(valid)).collect()}
    assert got == dict(exp_f)

    # daily trend over all rows
    exp_d = {}
    for r in rows:
        ca = r["created_at"]
        day = None if ca in (None, "bad") else ca[:10]
        n, s = exp_d.get(day, (0, None))
        rt = r["public_metrics"]["retweet_count"]
        exp_d[day] = (n + 1, s if rt is None else (rt if s is None else s + rt))
    got = {(None if r.day is None else r.day.strftime("%Y-%m-%d")): (r.toplam_tweet_sayisi, r.toplam_retweet_sayisi)
           for r in A.daily_trends(df).collect()}
    assert got == exp_d


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(tweet_st, min_size=0, max_size=30), st.integers(0, 150_000), st.integers(0, 150_000))
def test_one_shuffle_forms_equal_direct_forms(spark, rows, fame_point, low_point):
    valid = valid_tweets(parse_tweets(messages(spark, [json.dumps(r) for r in rows])))
    stats = A.author_stats(valid, fame_point, low_point)

    def s(df):
        return sorted(map(tuple, df.collect()), key=str)

    assert s(A.top_tweeters(valid)) == s(A.top_tweeters_from_stats(stats))
    assert s(A.famous_top_tweeters(valid)) == s(A.famous_top_tweeters_from_stats(stats))
    assert s(A.low_follower_activity(valid, low_point)) == s(A.low_follower_activity_from_stats(stats))
    assert s(A.fame_distribution(A.add_is_famous(valid, fame_point))) == s(A.fame_distribution_from_stats(stats))


def test_optional_n_equals_top_n(spark):
    rows = [tw(str(i), author=str(i % 7), user=f"u{i % 7}", fc=i * 13, day=f"2024-01-{1 + i % 9:02d}") for i in range(60)]
    df = tweets(spark, rows)

    def ids(d):
        return [tuple(r) for r in d.collect()]

    assert ids(A.top_tweeters(df, n=3)) == ids(A.top_n(A.top_tweeters(df), 3))
    assert ids(A.famous_top_tweeters(df, n=3)) == ids(A.top_n(A.famous_top_tweeters(df), 3))
    assert ids(A.low_follower_activity(df, 500, n=2)) == ids(A.top_n(A.low_follower_activity(df, 500), 2))
    assert ids(A.daily_trends(df, n=4)) == ids(A.top_n(A.daily_trends(df), 4))
    assert len(ids(A.top_tweeters(df, n=3))) == 3
