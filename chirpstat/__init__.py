"""chirpstat: tweet-message analytics as plain Spark DataFrame functions.

Raw topic messages -> typed tweets -> per-author, per-tweet and per-day
results, in batch or as Structured Streaming queries. Every function takes
the caller's DataFrame or session; none sets a master or runs hidden jobs.
"""

from chirpstat.functions.parse import parse_tweets
from chirpstat.functions.schema import TWEET_SCHEMA
from chirpstat.operators.analyses import (
    add_is_famous,
    daily_trends,
    fame_distribution,
    famous_top_tweeters,
    low_follower_activity,
    top_n,
    top_tweeters,
)
from chirpstat.operators.quality import count_invalid, valid_tweets, validate_tweets
from chirpstat.operators.select import text_search, user_timeline, write_by_author
from chirpstat.plans.jobs import plan_daily_trend, plan_user_analysis, run_daily_trend, run_user_analysis

__all__ = [
    "TWEET_SCHEMA",
    "add_is_famous",
    "count_invalid",
    "daily_trends",
    "fame_distribution",
    "famous_top_tweeters",
    "low_follower_activity",
    "parse_tweets",
    "plan_daily_trend",
    "plan_user_analysis",
    "run_daily_trend",
    "run_user_analysis",
    "text_search",
    "top_n",
    "top_tweeters",
    "user_timeline",
    "valid_tweets",
    "validate_tweets",
    "write_by_author",
]
