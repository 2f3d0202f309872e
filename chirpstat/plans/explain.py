"""Print the formatted physical plan of registered queries.

    python -m chirpstat.plans.explain /root/testdata/sf0.01 top_tweeters daily_trend
    python -m chirpstat.plans.explain /root/testdata/sf0.01 --summary

`--summary` prints one line per query with what matters at scale: how many
JSON parses, shuffles (hash / range), top-n nodes and scanned columns the
plan has. Building a plan runs no query, except for the job and stream
entries, which run their jobs to produce the table they return.
"""

from __future__ import annotations

import argparse
import contextlib
import io
import re
import sys

from pyspark.sql import DataFrame, SparkSession

from chirpstat.plans.registry import QUERIES


def plan_text(df: DataFrame) -> str:
    """The `explain("formatted")` text of a DataFrame's plan."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def summarize(text: str) -> str:
    schemas = sorted(set(re.findall(r"ReadSchema: (struct<[^\n]*>)", text)))
    return (
        f"json_parses={text.count('from_json(')} "
        f"hash_shuffles={text.count('hashpartitioning(')} "
        f"range_shuffles={text.count('rangepartitioning(')} "
        f"top_n={text.count('TakeOrderedAndProject') // 2} "
        f"broadcasts={text.count('BroadcastExchange') // 2} "
        f"scans={'; '.join(schemas)}"
    )


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="chirpstat-explain")
    p.add_argument("sf_dir")
    p.add_argument("names", nargs="*")
    p.add_argument("--summary", action="store_true")
    args = p.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    for name in args.names or list(QUERIES):
        text = plan_text(QUERIES[name](spark, args.sf_dir))
        if args.summary:
            print(f"{name:28s} {summarize(text)}")
        else:
            print(f"===== {name}\n{text}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
