"""Sources and sinks: topic scans, result tables, topic publishing, raw archive.

The broker and document-store connectors are ordinary Spark data sources
(`format("kafka")`, `format("mongodb")`), so a reader or writer here is just
the option set plus Spark's own distributed reader/writer. Any other format
(Parquet, ORC, Delta ...) works through the same calls; tests use Parquet.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from chirpstat.functions.parse import encode_json, message_text, parse_json, prune_schema
from chirpstat.functions.schema import TWEET_SCHEMA
from chirpstat.session import land_counted, move_path, observed_write, path_exists, remove_path, scratch_path
from chirpstat.sources.versions import Versions

LOG = logging.getLogger(__name__)


# --- Sources -------------------------------------------------------------------


def kafka_read_options(
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    ending_offsets: str | None = None,
    extra: dict[str, str] | None = None,
    partitions: list[int] | None = None,
) -> dict[str, str]:
    """Options of a bounded topic scan from `starting_offsets` to the end (of some `partitions` only)."""
    which = {"subscribe": topic} if partitions is None else {"assign": json.dumps({topic: partitions})}
    opts = {"kafka.bootstrap.servers": bootstrap_servers, **which, "startingOffsets": starting_offsets}
    if ending_offsets is not None:
        opts["endingOffsets"] = ending_offsets
    opts.update(extra or {})
    return opts


# Records per input task of a topic scan: about 300 MB of tweet JSON, so a
# task's work stays bounded however large the topic or one of its partitions.
RECORDS_PER_TASK = 1_000_000


def _spread(spark: SparkSession, opts: dict[str, str]) -> dict[str, str]:
    """Bounded, parallel topic scans. The Kafka source splits partition offset
    ranges into at least one task per core (`minPartitions`) and into tasks of
    at most `RECORDS_PER_TASK` messages (`maxRecordsPerPartition`), so a topic
    with few or very skewed partitions still spreads the JSON parse over the
    whole cluster. Options given by the caller win."""
    opts.setdefault("minPartitions", str(spark.sparkContext.defaultParallelism))
    opts.setdefault("maxRecordsPerPartition", str(RECORDS_PER_TASK))
    return opts


# Messages a micro-batch takes from a topic: a first batch over a long topic, or
# one that is done again after a failure, stays bounded.
RECORDS_PER_TRIGGER = 50_000_000


def read_topic(spark: SparkSession, bootstrap_servers: str, topic: str, **kwargs) -> DataFrame:
    """Batch read of a topic, from `starting_offsets` to the offsets current at planning."""
    opts = _spread(spark, kafka_read_options(bootstrap_servers, topic, **kwargs))
    return spark.read.format("kafka").options(**opts).load()


def stream_read_options(opts: dict[str, str]) -> dict[str, str]:
    """Batch read options -> those of a stream: no end, a limit on each micro-batch."""
    limited = {"maxOffsetsPerTrigger": str(RECORDS_PER_TRIGGER), **opts}
    limited.pop("endingOffsets", None)
    return limited


def read_topic_stream(spark: SparkSession, bootstrap_servers: str, topic: str, **kwargs) -> DataFrame:
    """Streaming read of a topic; `endingOffsets` does not apply to streams.

    A micro-batch takes at most `RECORDS_PER_TRIGGER` messages
    (`maxOffsetsPerTrigger`, also under availableNow); the caller's own limit wins.
    """
    opts = stream_read_options(_spread(spark, kafka_read_options(bootstrap_servers, topic, **kwargs)))
    return spark.readStream.format("kafka").options(**opts).load()


def read_messages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Messages landed as files: Parquet with a `value` column (a topic
    stand-in), or fmt="text" for JSON-lines files (one message per line)."""
    return spark.read.format(fmt).load(path)


# --- Result sinks --------------------------------------------------------------


@dataclass(frozen=True)
class Sink:
    """Where named results go.

    fmt="parquet" (or any path-based format) writes `<base>/<name>`;
    fmt="mongodb" writes collection `<name>` of the configured database.

    A result in files is replaced only when the new one is whole. With
    layout="plain", `<base>/<name>` is an ordinary table folder: the new result
    is written beside it and swapped in by two renames. With layout="versions",
    `<base>/<name>` holds version folders behind a pointer (sources/versions.py):
    no rename, readers keep the version they have begun, and it is the one for
    object stores; `read_result` reads it.
    """

    fmt: str = "parquet"
    base: str | None = None
    options: dict[str, str] = field(default_factory=dict)
    mode: str = "overwrite"
    on_empty: str = "skip"  # "skip" keeps the previous result; "overwrite" writes it empty
    layout: str = "plain"  # or "versions"
    keep: int = 2  # versions kept under layout="versions"

    def writer_options(self, name: str) -> dict[str, str]:
        opts = dict(self.options)
        if self.fmt == "mongodb":
            opts.setdefault("collection", name)
        return opts

    def target(self, name: str) -> str | None:
        if self.fmt == "mongodb" or self.base is None:
            return None
        return f"{self.base.rstrip('/')}/{name}"


def mongo_sink(database: str, connection_uri: str | None = None, **options: str) -> Sink:
    opts = {"database": database, **options}
    if connection_uri:
        opts["connection.uri"] = connection_uri
    return Sink(fmt="mongodb", options=opts)


def document_types(df: DataFrame) -> DataFrame:
    """Wall-clock (NTZ) columns as instants in UTC, which a document store can hold.

    The text form names the zone, so the session's zone does not matter.
    """
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, TimestampNTZType):
            c = F.concat(c.cast("string"), F.lit("+00:00")).cast("timestamp").alias(f.name)
        cols.append(c)
    return df.select(*cols)


def write_result(df: DataFrame, name: str, sink: Sink) -> bool:
    """Write one named result. Returns False when it was skipped as empty.

    The plan runs once: rows are counted while they are written (`observe`), and
    an empty result is dropped instead of published (`on_empty="skip"`). Where
    the rows must go straight into the target (a document store, mode="append"),
    a result that may be skipped is landed in the shared folder first. Write
    errors are raised, never swallowed, and leave the previous result in place.
    """
    target = sink.target(name)
    skips = sink.on_empty == "skip"
    options = sink.writer_options(name)
    if target is None or sink.mode != "overwrite":
        path = scratch_path(df.sparkSession, "result") if skips else None
        try:
            if skips:
                df, found = land_counted(df, df.sparkSession, "result", path)
                if not found["rows"]:
                    return _skipped(name)
            rows = document_types(df) if sink.fmt == "mongodb" else df
            rows.write.format(sink.fmt).mode(sink.mode).options(**options).save(target)
            return True
        finally:
            if path is not None:
                remove_path(df.sparkSession, path)

    def write(to: str) -> int:
        return observed_write(df, lambda rows: rows.write.format(sink.fmt).options(**options).save(to))["rows"]

    publish_ = _publish_version if sink.layout == "versions" else _publish_plain
    return publish_(df.sparkSession, target, write, skips, sink) or _skipped(name)


def _skipped(name: str) -> bool:
    LOG.warning("no rows for %r; previous result left in place", name)
    return False


def _publish_version(spark: SparkSession, target: str, write: Callable[[str], int], skips: bool, sink: Sink) -> bool:
    """Write a new version, then point at it."""
    versions = Versions(spark, target, sink.fmt)
    version = versions.new_version()
    try:
        rows = write(versions.folder(version))
    except Exception:
        remove_path(spark, versions.folder(version))
        raise
    if skips and not rows:
        remove_path(spark, versions.folder(version))
        return False
    versions.point_at(version, rows=rows)
    versions.prune(sink.keep)
    return True


# Beside a plain result `<name>`: the new one while it is written, the whole new
# one, and the old one while they change places.
_WRITING, _WHOLE, _OLD = "_writing", "_whole", "_old"


def _beside(target: str, state: str) -> str:
    base, slash, name = target.rpartition("/")
    return f"{base}{slash}{state}-{name}"


def finish_swap(spark: SparkSession, target: str) -> None:
    """Finish a swap of a plain result that died between its renames.

    A whole new result is put in the place of the old one; without one, an old
    result that was already moved away goes back.
    """
    whole, old = _beside(target, _WHOLE), _beside(target, _OLD)
    if path_exists(spark, whole):
        if path_exists(spark, target):
            remove_path(spark, old)
            move_path(spark, target, old)
        move_path(spark, whole, target)
    elif path_exists(spark, old) and not path_exists(spark, target):
        move_path(spark, old, target)
    remove_path(spark, old)


def _publish_plain(spark: SparkSession, target: str, write: Callable[[str], int], skips: bool, _sink: Sink) -> bool:
    """Write beside the target, then swap. Up to the renames the old result is untouched."""
    finish_swap(spark, target)
    writing, whole = _beside(target, _WRITING), _beside(target, _WHOLE)
    remove_path(spark, writing)
    try:
        rows = write(writing)
        if skips and not rows:
            return False
        move_path(spark, writing, whole)
    finally:
        remove_path(spark, writing)
    finish_swap(spark, target)
    return True


def read_result(spark: SparkSession, name: str, sink: Sink) -> DataFrame | None:
    """The last whole result written to a sink in files (None: none yet), in either layout."""
    target = sink.target(name)
    if target is None:
        raise ValueError("only results in files are read back here; use the store's own reader")
    if sink.layout == "versions":
        return Versions(spark, target, sink.fmt).read()
    # a swap that is going on, or died, is left to the writers: the content is still in one of these
    for path in (target, _beside(target, _WHOLE), _beside(target, _OLD)):
        if path_exists(spark, path):
            return spark.read.format(sink.fmt).load(path)
    return None


# --- Topic publishing and raw archive ------------------------------------------


def to_messages(df: DataFrame) -> DataFrame:
    """Anything -> topic messages: a `value` column passes through unchanged,
    typed rows are encoded as one JSON object per row."""
    if "value" in df.columns:
        return df.select(F.col("value").cast("binary").alias("value"))
    return encode_json(df)


def kafka_write_options(bootstrap_servers: str, topic: str, extra: dict[str, str] | None = None) -> dict[str, str]:
    return {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic, **(extra or {})}


def publish(
    df: DataFrame, bootstrap_servers: str | None = None, topic: str | None = None, path: str | None = None, **extra: str
) -> None:
    """Batch-publish every row as one message (no key), in parallel per partition;
    with `path` a file table stands in for the topic."""
    messages = to_messages(df)
    if path is not None:
        messages.write.mode("append").parquet(path)
        return
    messages.write.format("kafka").options(**kafka_write_options(bootstrap_servers, topic, extra)).save()


def dedupe_by_id(raw: DataFrame, schema=TWEET_SCHEMA, id_as: str | None = None) -> DataFrame:
    """Keep one message per parsed id; messages without an id are all kept.
    With `id_as`, the parsed id is added as a column of that name.

    One read of the input and one aggregate with a map-side partial step, so an
    id repeated a million times collapses inside each task before the shuffle.
    The survivor does not depend on the input's order: it is the message at the
    lowest partition and offset where the input has these, else the smallest
    one by its bytes. A message without an id gets a key of its own, so that
    such messages form no group. The id comes out of a generator (as in
    `parse_tweets`), so nothing that uses it is pushed below the parse.
    """
    id_only = prune_schema(schema, ["id"])
    order = [c for c in ("partition", "offset") if c in raw.columns] or ["value"]
    whole = F.struct(*[F.col(f"`{c}`") for c in raw.columns])
    keyed = raw.select(
        F.struct(*order).alias("_order"), whole.alias("_row"), F.inline(F.array(parse_json("value", id_only))).alias("_id")
    )
    keyed = keyed.withColumn("_own", F.when(F.col("_id").isNull(), F.monotonically_increasing_id()))
    first = F.min(F.struct("_order", F.struct("_row.value").alias("_value"), "_row")).alias("_first")
    kept = keyed.groupBy("_id", "_own").agg(first)
    return kept.select("_first._row.*", *([F.col("_id").alias(id_as)] if id_as else []))


def documents(rows: DataFrame) -> DataFrame:
    """One document per message: its whole text in `raw`, and the tweet's fields.

    Nothing is lost: fields outside the schema and messages that are no JSON
    are in `raw`; `created_at` stays the sent text.
    """
    parsed = rows.select(message_text("value").alias("raw"), parse_json("value", TWEET_SCHEMA).alias("d"))
    return parsed.select("raw", "d.*")


def archive_raw(
    raw: DataFrame, target: str | None, fmt: str = "parquet", dedupe: bool = False, **options: str
) -> None:
    """Append every raw message to an archive.

    File formats keep the message bytes (`value`) exactly as received. A
    document store (fmt="mongodb", `target` = collection) gets one document
    per message (`documents`), with the whole message text in it.
    """
    rows = dedupe_by_id(raw) if dedupe else raw
    if fmt == "mongodb":
        opts = {"collection": target, **options} if target else dict(options)
        documents(rows).write.format(fmt).mode("append").options(**opts).save()
        return
    rows.select("value").write.format(fmt).mode("append").options(**options).save(target)
