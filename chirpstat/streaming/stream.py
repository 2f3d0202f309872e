"""Structured Streaming forms: live daily totals and author counts, and the
dual path that archives raw messages and republishes them.

The analyses are the batch functions applied to a streaming DataFrame; Spark
keeps their aggregation state (one row per day or per author) in the state
store under the query's checkpoint, so a restarted query resumes instead of
re-counting. There is no watermark: tweet times spread over years, and the
state is bounded by the number of days/authors, not by the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from chirpstat.functions.parse import parse_tweets
from chirpstat.operators import analyses as A
from chirpstat.operators.quality import valid_tweets
from chirpstat.session import list_names, path_exists, scratch_path, session_conf
from chirpstat.functions.schema import AUTHOR_FIELDS, DAILY_FIELDS
from chirpstat.sources.archive_index import append_new
from chirpstat.sources.io import archive_raw, document_types, kafka_write_options, to_messages
from chirpstat.sources.versions import Overtaken, Record, Versions
from chirpstat.streaming.held import Held
from chirpstat.streaming.keyed_table import KeyedTable, read_keyed


def daily_trend_stream(raw_stream: DataFrame) -> DataFrame:
    """Streaming daily totals (complete mode), unordered: see `run_complete`."""
    return A.daily_trends(parse_tweets(raw_stream, fields=DAILY_FIELDS), sort=False)


def top_tweeters_stream(raw_stream: DataFrame) -> DataFrame:
    """Streaming tweets per author over the valid rows (complete mode), unordered."""
    return A.top_tweeters(valid_tweets(parse_tweets(raw_stream, fields=AUTHOR_FIELDS)), sort=False)


def start_complete(
    spark: SparkSession,
    result_stream: DataFrame,
    target: str,
    checkpoint: str,
    state_partitions: int | None = None,
    fmt: str = "parquet",
    **trigger,
) -> StreamingQuery:
    """Start a complete-mode aggregate whose every micro-batch replaces the result in `target`.

    Each batch's full result is a version of its own in `target`, and the
    target's manifest (sources/versions.py) names, per change, the run (the
    query's id, which stays with its checkpoint), the checkpoint, the batch and
    the version. `read_complete` follows the last record, so a reader always
    finds a whole result, also after a crash in the middle of a write; the last
    two versions are kept. A retried batch writes a version again. No row is
    carried through the driver.

    A run claims its target when it starts. A new checkpoint on a target that
    another run has used begins with no result: the old run's rows are not
    returned any more, and if that run is still at work, its next batch fails
    (`Overtaken`) instead of replacing the new one's. A run restarted on its
    checkpoint gets its own last result back.

    `trigger` is passed to `DataStreamWriter.trigger` (e.g.
    processingTime="1 minute", or availableNow=True).

    `state_partitions` sets how many state-store partitions a new query gets.
    A stateful stream takes that number from `spark.sql.shuffle.partitions`
    when it first starts and keeps it in its checkpoint for good (AQE does not
    resize state), so it is set only while the query starts; a restarted
    query keeps its original count. State of one row per author belongs in
    the RocksDB state store.
    """

    result = _Target(spark, target, checkpoint, fmt)
    writer = (
        result_stream.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(result.write)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    if state_partitions:
        with session_conf(spark, "spark.sql.shuffle.partitions", str(state_partitions)):
            query = writer.start()
    else:
        query = writer.start()
    result.claim(query.id)
    return query


class _Target(Held):
    """A table of which every batch is a whole version."""

    def _left(self, run: str) -> tuple[str | None, dict]:
        own = [r for r in self.versions.records() if r.notes.get("run") == run and r.version is not None]
        if own and path_exists(self.spark, self.versions.folder(own[-1].version)):
            return own[-1].version, {"batch": own[-1].notes.get("batch")}
        if not own:  # a target of before there were records: its batches carry their ids only
            done = [n for n in list_names(self.spark, f"{self.checkpoint}/commits") if n.isdigit()]
            old = [i for i in _batches(self.spark, self.versions.path) if str(i) in done and self.versions.last() is None]
            if old:
                return f"batch-{old[-1]}", {"batch": old[-1]}
        return None, {"batch": None}

    def write(self, batch: DataFrame, batch_id: int) -> None:
        run = self._begin_batch()
        version = self.versions.new_version(f"batch-{batch_id}")
        batch.write.format(self.fmt).save(self.versions.folder(version))
        self._point_at(version, self._own(run, version), run, {"batch": batch_id})
        self.versions.prune(keep=2, abandoned_after=0)  # one run at a time writes here


def _batches(spark: SparkSession, target: str) -> list[int]:
    """Ids of the whole batches in `target`, ascending: those of its last run, by the manifest;
    in a target without one, of the folders that are complete."""
    records = Versions(spark, target).records()
    if records:
        own = [r for r in records if r.notes.get("run") == records[-1].notes.get("run") and r.version is not None]
        return sorted({r.notes["batch"] for r in own})
    ids = sorted(int(n[6:]) for n in list_names(spark, target) if n.startswith("batch-") and n[6:].isdigit())
    return [i for i in ids if path_exists(spark, f"{target.rstrip('/')}/batch-{i}/_SUCCESS")]


def read_complete(spark: SparkSession, target: str, fmt: str = "parquet") -> DataFrame | None:
    """The last whole result that the run which holds `target` has left there (None: none yet)."""
    versions = Versions(spark, target, fmt)
    last = versions.last()
    if last is not None:
        return versions.read(last)
    ids = _batches(spark, target)
    return versions.read(Record(0, f"batch-{ids[-1]}")) if ids else None


def run_complete(
    spark: SparkSession,
    result_stream: DataFrame,
    name: str,
    checkpoint: str | None = None,
    target: str | None = None,
    order: list | None = None,
    state_partitions: int | None = None,
) -> DataFrame:
    """Run a complete-mode aggregate over everything available now, then stop.

    Returns the result table (Parquet in the shared folder) as a batch
    DataFrame, sorted by `order` when given; see `start_complete`. The default
    target lies beside the checkpoint, so that a query restarted from its
    checkpoint finds its result again even if nothing new has come. If the
    checkpoint has committed a batch and the result is gone, this is an error.

    The stream itself is not sorted: a global sort inside a micro-batch
    samples the stateful plan for its range bounds and roughly doubles the
    batch time, while a table sink keeps no order anyway. The order is
    applied to the (small, per-day or per-author) table when it is read.
    """
    checkpoint = checkpoint or scratch_path(spark, f"{name}-checkpoint")
    target = target or f"{checkpoint.rstrip('/')}-result"
    query = start_complete(spark, result_stream, target, checkpoint, state_partitions, availableNow=True)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    result = read_complete(spark, target)
    if result is None:
        if list_names(spark, f"{checkpoint.rstrip('/')}/commits"):
            raise RuntimeError(f"checkpoint {checkpoint} has finished batches, but their result is not in {target}")
        # No batch ran (empty source): an empty result of the right shape.
        result = spark.createDataFrame([], result_stream.schema)
    return result.orderBy(*order) if order else result


# --- Update mode: only changed keys leave each trigger ------------------------------

BatchWriter = Callable[[DataFrame, int], None]

# --- Fixed value: the state store for state that does not fit an executor's heap ---
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


def start_keyed(
    spark: SparkSession, result_stream: DataFrame, keys: Sequence[str], target: str, checkpoint: str,
    state_partitions: int | None = None, **trigger,
) -> StreamingQuery:
    """Start an update-mode aggregate into a file table with one row a key (streaming/keyed_table.py).

    Each trigger writes the rows whose totals changed, and no others; the table
    is merged from them when it is read (`read_keyed`) and now and then in
    itself. So output grows with the changed keys, where `start_complete`
    rewrites every key. State with a row per author does not belong on the heap:
    a new query gets the RocksDB state store, and keeps it with its checkpoint.
    Runs claim the table as they do in `start_complete`.
    """
    table = KeyedTable(spark, target, checkpoint, keys)
    with session_conf(spark, STATE_STORE, ROCKSDB):
        query = start_update(spark, result_stream, table.write, checkpoint, state_partitions, **trigger)
    table.claim(query.id)
    return query


def run_keyed(
    spark: SparkSession, result_stream: DataFrame, keys: Sequence[str], name: str,
    checkpoint: str | None = None, target: str | None = None, state_partitions: int | None = None,
) -> DataFrame:
    """Run `start_keyed` over everything available now, then stop; returns the table, merged."""
    checkpoint = checkpoint or scratch_path(spark, f"{name}-checkpoint")
    target = target or f"{checkpoint.rstrip('/')}-table"
    query = start_keyed(spark, result_stream, keys, target, checkpoint, state_partitions, availableNow=True)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    table = read_keyed(spark, target)
    return spark.createDataFrame([], result_stream.schema) if table is None else table


def start_update(
    spark: SparkSession,
    result_stream: DataFrame,
    write_changes: BatchWriter,
    checkpoint: str,
    state_partitions: int | None = None,
    **trigger,
) -> StreamingQuery:
    """Start an update-mode aggregate: each micro-batch passes only the keys
    whose totals changed to `write_changes(batch_df, batch_id)`.

    Output per trigger grows with the new messages, not with the number of
    authors or days, so this is the form for a keyed store that upserts
    (`mongo_upsert`). The aggregate must be unsorted (update mode allows no
    sort). `state_partitions` as in `start_complete`.
    """
    writer = (
        result_stream.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write_changes)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    if state_partitions:
        with session_conf(spark, "spark.sql.shuffle.partitions", str(state_partitions)):
            return writer.start()
    return writer.start()


def mongo_upsert_options(collection: str, key_fields: Sequence[str], **options: str) -> dict[str, str]:
    """Connector options that replace each row's document by its key fields."""
    return {
        "collection": collection,
        "operationType": "replace",
        "idFieldList": ",".join(key_fields),
        "upsertDocument": "true",
        **options,
    }


def mongo_upsert(collection: str, key_fields: Sequence[str], **options: str) -> BatchWriter:
    """Batch writer replacing each changed row's document by its key fields.
    A retried batch replaces the same documents again."""
    opts = mongo_upsert_options(collection, key_fields, **options)

    def write(batch: DataFrame, _batch_id: int) -> None:
        document_types(batch).write.format("mongodb").mode("append").options(**opts).save()

    return write


# --- Dual path: archive + republish ------------------------------------------------


def start_archive(
    raw_stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", archive_options: dict | None = None,
    new_ids_only: bool = False, **trigger,
) -> StreamingQuery:
    """Append every raw message to the archive.

    File formats use the file sink (exactly once via its commit log). A
    document store (fmt="mongodb", `path` = collection, connection settings in
    `archive_options`) gets one document per message through `archive_raw`
    per micro-batch; a retried batch appends again, as duplicate inserts are
    tolerated on the archive.

    With `new_ids_only`, a message whose id the archive holds already is left
    out, also one of an earlier batch or run (`archive_index.append_new`; file
    formats). A batch that is done again then adds nothing but messages without
    an id.
    """
    if new_ids_only:
        if fmt == "mongodb":
            raise ValueError("new_ids_only needs an archive in files")
        opts = dict(archive_options or {})

        def write_new(batch: DataFrame, _batch_id: int) -> None:
            append_new(batch, path, fmt=fmt, **opts)

        writer = raw_stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write_new)
    elif fmt == "mongodb":
        opts = dict(archive_options or {})

        def write_batch(batch: DataFrame, _batch_id: int) -> None:
            archive_raw(batch, path, fmt="mongodb", **opts)

        writer = raw_stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write_batch)
    else:
        writer = (
            raw_stream.select("value").writeStream.format(fmt).outputMode("append")
            .option("checkpointLocation", checkpoint).option("path", path)
        )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def start_publish(
    raw_stream: DataFrame, checkpoint: str, bootstrap_servers: str | None = None, topic: str | None = None,
    path: str | None = None, **trigger,
) -> StreamingQuery:
    """Republish every message to a topic; with `path` a file table stands in for it."""
    messages = to_messages(raw_stream)
    if path is not None:
        writer = messages.writeStream.format("parquet").option("path", path)
    else:
        writer = messages.writeStream.format("kafka").options(**kafka_write_options(bootstrap_servers, topic))
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def start_dual_path(
    raw_stream: DataFrame, archive_path: str, checkpoint_root: str,
    bootstrap_servers: str | None = None, topic: str | None = None, publish_path: str | None = None,
    archive_fmt: str = "parquet", archive_options: dict | None = None,
    **trigger,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Two independent queries over one source definition, one checkpoint each.

    Each sink is exactly-once on its own; as with two separate writers there is
    no transaction across them, so after a failure one may be ahead of the other
    until both have caught up.
    """
    archive = start_archive(
        raw_stream, archive_path, f"{checkpoint_root}/archive", archive_fmt, archive_options, **trigger
    )
    publish = start_publish(
        raw_stream, f"{checkpoint_root}/publish", bootstrap_servers, topic, publish_path, **trigger
    )
    return archive, publish
