"""Command-line entry for the jobs, selections and streams (for `spark-submit`).

    spark-submit --py-files chirpstat.zip chirpstat/plans/cli.py \
        user-analysis raw-tweets-stream --bootstrap-servers broker:9092 --mongo-db tweet_results
    spark-submit --py-files chirpstat.zip chirpstat/plans/cli.py \
        daily-trend raw-tweets-stream --bootstrap-servers broker:9092
    spark-submit ... cli.py stream-daily-trend raw-tweets-stream --bootstrap-servers broker:9092 \
        --checkpoint /shared/ck/daily --sink-base /shared/results --trigger-seconds 60
    spark-submit ... cli.py stream-top-tweeters raw-tweets-stream --bootstrap-servers broker:9092 \
        --checkpoint /shared/ck/top --mongo-db tweet_results     # update mode, keyed upserts
    spark-submit ... cli.py dual-path raw-tweets-stream --bootstrap-servers broker:9092 \
        --checkpoint /shared/ck/dual --archive-path /shared/archive --publish-topic tweets-copy
    spark-submit ... cli.py timeline raw-tweets-stream --bootstrap-servers broker:9092 --user someone
    spark-submit ... cli.py search raw-tweets-stream --bootstrap-servers broker:9092 \
        --phrase "big data" --lang tr
    spark-submit ... cli.py index-timelines raw-tweets-stream --bootstrap-servers broker:9092 \
        --out /shared/tweets_by_author      # then: timeline ... --table /shared/tweets_by_author
    spark-submit ... cli.py index-texts raw-tweets-stream --bootstrap-servers broker:9092 \
        --out /shared/texts [--compact]     # adds a run; then: search ... --text-index /shared/texts

`--input-path` reads landed message files instead of a broker; `--sink-base`
writes Parquet results instead of collections (for streams: a complete-mode
table; `--mongo-db` streams upsert only the changed rows). The session (master, packages,
connector settings) comes from spark-submit; nothing here sets it.
"""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import DataFrame, SparkSession

from chirpstat.functions.parse import parse_tweets
from chirpstat.functions.schema import (
    AUTHOR_KEYS,
    DAY,
    FAME_POINT,
    LOW_FOLLOWER_POINT,
    RAW_MESSAGE_SCHEMA,
    SEARCH_FIELDS,
    TIMELINE_FIELDS,
    TWEET_SCHEMA,
)
from chirpstat.operators.quality import valid_tweets
from chirpstat.operators.select import SELECT_COLUMNS, newest, text_search, user_timeline, write_by_author
from chirpstat.plans.jobs import deliver, run_daily_trend, run_daily_trend_since, run_user_analysis
from chirpstat.session import land
from chirpstat.sources.author_table import AuthorTable, read_author_table
from chirpstat.sources.io import Sink, mongo_sink, read_messages, read_topic, read_topic_stream, write_result
from chirpstat.sources.ledger import kafka_since, messages_since
from chirpstat.sources.text_index import TextIndex
from chirpstat.streaming import stream as S

LOG = logging.getLogger("chirpstat")

#: Files a stream over a folder takes in a micro-batch, so that a first batch over a long archive stays bounded.
FILES_PER_TRIGGER = 1000

#: Most rows that a preview brings to the driver.
PREVIEW_ROWS = 1000


def _preview_rows(value: str) -> int:
    rows = int(value)
    if not 0 <= rows <= PREVIEW_ROWS:
        raise argparse.ArgumentTypeError(f"a preview has 0 to {PREVIEW_ROWS} rows; write larger results with --sink-base")
    return rows


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="chirpstat")
    sub = p.add_subparsers(dest="job", required=True)
    for name in ("user-analysis", "daily-trend"):
        s = sub.add_parser(name)
        s.add_argument("topic")
        src = s.add_mutually_exclusive_group(required=True)
        src.add_argument("--bootstrap-servers")
        src.add_argument("--input-path", help="folder of landed messages (Parquet with a `value` column)")
        s.add_argument("--input-format", choices=("parquet", "text"), default="parquet",
                       help="text: JSON-lines files, one message per line")
        out = s.add_mutually_exclusive_group()
        out.add_argument("--sink-base", help="write Parquet results under this folder")
        out.add_argument("--mongo-db", help="write results as collections of this database")
        s.add_argument("--mongo-uri")
        s.add_argument("--on-empty", choices=("skip", "overwrite"), default="skip")
        s.add_argument("--layout", choices=("plain", "versions"), default="plain",
                       help="files: a plain table folder, or versions behind a pointer (for object stores)")
        s.add_argument("--preview", type=_preview_rows, default=10, help="rows of each result to show (0: none)")
        if name == "user-analysis":
            s.add_argument("--fame-point", type=int, default=FAME_POINT)
            s.add_argument("--low-point", type=int, default=LOW_FOLLOWER_POINT)
            s.add_argument("--keep-snapshot", action="store_true", help="keep the landed tweets and author table")
        else:
            s.add_argument("--drop-invalid", action="store_true")
            s.add_argument("--ledger", help="folder of the offsets read so far: read only what is new, report over all runs")
    for name in ("timeline", "search", "index-timelines", "index-texts"):
        s = sub.add_parser(name)
        s.add_argument("topic")
        src = s.add_mutually_exclusive_group(required=True)
        src.add_argument("--bootstrap-servers")
        src.add_argument("--input-path", help="folder of landed messages (Parquet with a `value` column)")
        if not name.startswith("index-"):
            src.add_argument("--table", help="tweet table written by index-timelines")
        if name == "search":
            src.add_argument("--text-index", help="trigram index written by index-texts")
        s.add_argument("--input-format", choices=("parquet", "text"), default="parquet")
        if name == "timeline":
            s.add_argument("--user", required=True)
        if name == "search":
            s.add_argument("--phrase", required=True)
            s.add_argument("--lang")
            s.add_argument("--include-retweets", action="store_true")
            s.add_argument("--ignore-case", action="store_true")
        if name == "index-timelines":
            s.add_argument("--out", required=True, help="folder for the author-ordered tweet table")
            s.add_argument("--add", action="store_true", help="add the tweets to the table as a run of their own")
        elif name == "index-texts":
            s.add_argument("--out", required=True, help="folder of the index; the tweets are added as a run of their own")
            s.add_argument("--compact", action="store_true", help="then write all runs into one")
        else:
            s.add_argument("--max-tweets", type=int, default=10)
            s.add_argument("--preview", type=_preview_rows, default=10, help="rows to show (0: none)")
            s.add_argument("--sink-base", help="also write the selection as Parquet under this folder")
            s.add_argument("--archive-path", help="append the selected tweets to this raw-message archive")
            out = s.add_mutually_exclusive_group()
            out.add_argument("--publish-topic", help="publish the selected tweets (needs --publish-servers or --bootstrap-servers)")
            out.add_argument("--publish-path", help="folder standing in for the output topic")
            s.add_argument("--publish-servers")
    for name in ("stream-daily-trend", "stream-top-tweeters", "dual-path"):
        s = sub.add_parser(name)
        s.add_argument("topic")
        src = s.add_mutually_exclusive_group(required=True)
        src.add_argument("--bootstrap-servers")
        src.add_argument("--input-path", help="folder of message files (Parquet with a `value` column)")
        s.add_argument("--input-format", choices=("parquet", "text"), default="parquet",
                       help="text: JSON-lines files, one message per line")
        s.add_argument("--files-per-trigger", type=int, default=FILES_PER_TRIGGER,
                       help="message files a micro-batch takes at most")
        s.add_argument("--checkpoint", required=True, help="shared folder for this query's checkpoint")
        when = s.add_mutually_exclusive_group()
        when.add_argument("--trigger-seconds", type=int, default=60)
        when.add_argument("--available-now", action="store_true", help="process what is there, then stop")
        if name == "dual-path":
            arch = s.add_mutually_exclusive_group(required=True)
            arch.add_argument("--archive-path", help="folder of the raw-message archive (Parquet)")
            arch.add_argument("--archive-mongo-db", help="archive raw tweets as documents in this database")
            s.add_argument("--archive-collection", default="raw_tweets")
            s.add_argument("--mongo-uri")
            out = s.add_mutually_exclusive_group(required=True)
            out.add_argument("--publish-topic")
            out.add_argument("--publish-path", help="folder standing in for the output topic")
            s.add_argument("--publish-servers", help="brokers of the output topic (default: --bootstrap-servers)")
        else:
            out = s.add_mutually_exclusive_group(required=True)
            out.add_argument("--sink-base", help="complete mode: the whole result table replaced each trigger")
            out.add_argument("--mongo-db", help="update mode: changed rows upserted by key into this database")
            s.add_argument("--keyed", action="store_true",
                           help="with --sink-base: write only the changed rows each trigger (read with read_keyed)")
            s.add_argument("--mongo-uri")
            s.add_argument("--state-partitions", type=int)
    return p


def _raw_stream(spark: SparkSession, args) -> DataFrame:
    if args.input_path:
        schema = RAW_MESSAGE_SCHEMA if args.input_format == "parquet" else "value string"
        reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", args.files_per_trigger)
        return reader.format(args.input_format).load(args.input_path)
    return read_topic_stream(spark, args.bootstrap_servers, args.topic)


def _run_stream(spark: SparkSession, args) -> int:
    trigger = {"availableNow": True} if args.available_now else {"processingTime": f"{args.trigger_seconds} seconds"}
    raw = _raw_stream(spark, args)
    if args.job == "dual-path":
        servers = args.publish_servers or args.bootstrap_servers
        if args.publish_topic and not servers:
            raise SystemExit("--publish-topic needs --publish-servers or --bootstrap-servers")
        if args.archive_mongo_db:
            archive, fmt = args.archive_collection, "mongodb"
            opts = {"database": args.archive_mongo_db}
            if args.mongo_uri:
                opts["connection.uri"] = args.mongo_uri
        else:
            archive, fmt, opts = args.archive_path, "parquet", None
        queries = S.start_dual_path(
            raw, archive, args.checkpoint, bootstrap_servers=servers,
            topic=args.publish_topic, publish_path=args.publish_path,
            archive_fmt=fmt, archive_options=opts, **trigger,
        )
    else:
        if args.job == "stream-daily-trend":
            result, name, keys = S.daily_trend_stream(raw), "daily_trend", [DAY]
        else:
            result, name, keys = S.top_tweeters_stream(raw), "top_tweeters", list(AUTHOR_KEYS)
        if args.mongo_db:
            opts = {"database": args.mongo_db}
            if args.mongo_uri:
                opts["connection.uri"] = args.mongo_uri
            upsert = S.mongo_upsert(name, keys, **opts)
            queries = (S.start_update(spark, result, upsert, args.checkpoint, args.state_partitions, **trigger),)
        elif args.keyed:
            target = f"{args.sink_base.rstrip('/')}/{name}"
            queries = (S.start_keyed(spark, result, keys, target, args.checkpoint, args.state_partitions, **trigger),)
        else:
            target = f"{args.sink_base.rstrip('/')}/{name}"
            queries = (S.start_complete(spark, result, target, args.checkpoint, args.state_partitions, **trigger),)
    if args.available_now:
        for q in queries:
            q.awaitTermination()
    else:
        # Runs until a query stops or fails; then the others are stopped too.
        try:
            spark.streams.awaitAnyTermination()
        finally:
            for q in queries:
                if q.isActive:
                    q.stop()
    failed = [q.exception() for q in queries if q.exception() is not None]
    if failed:
        raise failed[0]
    return 0


def _run_select(spark: SparkSession, args) -> int:
    if args.job == "index-timelines":
        tweets = parse_tweets(_raw(spark, args))
        if args.add:
            AuthorTable(spark, args.out).add(tweets)
        else:
            write_by_author(tweets, args.out)
        return 0
    if args.job == "index-texts":
        index = TextIndex(spark, args.out)
        index.add(parse_tweets(_raw(spark, args)))
        if args.compact:
            index.compact()
        return 0
    servers = args.publish_servers or args.bootstrap_servers
    if args.publish_topic and not servers:
        raise SystemExit("--publish-topic needs --publish-servers or --bootstrap-servers")
    delivers = bool(args.archive_path or args.publish_topic or args.publish_path)
    fields = TIMELINE_FIELDS if args.job == "timeline" else SEARCH_FIELDS
    columns = tuple(TWEET_SCHEMA.fieldNames()) if delivers else SELECT_COLUMNS
    if args.job == "search" and args.text_index:
        tweets = TextIndex(spark, args.text_index).candidates(args.phrase)
        if tweets is None:
            raise SystemExit(f"{args.text_index} has no tweets yet")
    elif args.table:
        tweets = read_author_table(spark, args.table)
    else:
        tweets = valid_tweets(parse_tweets(_raw(spark, args), fields=None if delivers else fields))
    if args.job == "timeline":
        result = user_timeline(tweets, args.user, args.max_tweets, columns)
    else:
        result = text_search(
            tweets, args.phrase, args.lang, not args.include_retweets, args.max_tweets, columns, ignore_case=args.ignore_case
        )
    # The selection runs once: what is shown and written comes from where it was landed.
    if delivers:
        messages = deliver(
            spark, result, args.archive_path, publish_path=args.publish_path, bootstrap_servers=servers, topic=args.publish_topic
        )
        result = parse_tweets(messages)
    else:
        result = land(result, spark, args.job)
    if args.sink_base:
        write_result(result, args.job, Sink(base=args.sink_base, on_empty="overwrite"))
    if args.preview:
        newest(result, args.preview, SELECT_COLUMNS).show(args.preview, truncate=False)
    return 0


def _raw(spark: SparkSession, args) -> DataFrame:
    if args.input_path:
        return read_messages(spark, args.input_path, fmt=args.input_format)
    return read_topic(spark, args.bootstrap_servers, args.topic)


def _sink(args) -> Sink | None:
    if args.mongo_db:
        s = mongo_sink(args.mongo_db, args.mongo_uri)
        return Sink(fmt=s.fmt, options=s.options, on_empty=args.on_empty)
    if args.sink_base:
        return Sink(base=args.sink_base, on_empty=args.on_empty, layout=args.layout)
    return None


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    spark = spark or SparkSession.builder.appName(f"chirpstat-{args.job}").getOrCreate()
    if args.job in ("stream-daily-trend", "stream-top-tweeters", "dual-path"):
        return _run_stream(spark, args)
    if args.job in ("timeline", "search", "index-timelines", "index-texts"):
        return _run_select(spark, args)
    sink = _sink(args)
    raw = None if args.job == "daily-trend" and args.ledger else _raw(spark, args)

    if args.job == "user-analysis":
        run_user_analysis(
            spark, raw, sink, args.fame_point, args.low_point, args.keep_snapshot, args.preview
        )
        return 0

    if args.ledger:
        if args.input_path:
            topic = messages_since(lambda: _raw(spark, args))
        else:
            topic = kafka_since(spark, args.bootstrap_servers, args.topic)
        result = run_daily_trend_since(spark, topic, args.ledger, sink, drop_invalid=args.drop_invalid)
        if args.preview:
            result.show(args.preview, truncate=False)
        return 0

    run_daily_trend(spark, raw, sink, drop_invalid=args.drop_invalid, preview=args.preview)
    return 0


if __name__ == "__main__":
    sys.exit(main())
