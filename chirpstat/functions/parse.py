"""Raw message bytes -> typed tweet rows (column expressions and one transform).

All work is built-in Catalyst expressions, so it stays inside whole-stage
codegen and runs wherever the scan runs; no Python touches a row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from chirpstat.functions.schema import (
    CREATED_AT_FORMAT,
    CREATED_AT_REGEX,
    TWEET_SCHEMA,
)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def message_text(value: str | Column = "value") -> Column:
    """Message bytes as UTF-8 text."""
    return _col(value).cast("string")


def parse_json(value: str | Column = "value", schema: StructType = TWEET_SCHEMA) -> Column:
    """Permissive JSON parse against a declared schema.

    Text that is not a JSON object gives a struct of nulls (a null message
    gives a null struct); a field of the wrong type gives a null field and
    keeps the others. Errors never stop the job.
    """
    return F.from_json(message_text(value), schema)


def created_at_timestamp(created_at: str | Column = "created_at") -> Column:
    """`yyyy-MM-ddTHH:mm:ssZ` text -> TIMESTAMP_NTZ holding the same wall clock.

    Anything else (fractions, offsets, blanks, impossible dates) gives null
    instead of an error, and the result does not depend on the session zone.
    """
    c = _col(created_at)
    return F.when(
        c.rlike(CREATED_AT_REGEX), F.substring(c, 1, 19).try_cast("timestamp_ntz")
    )


def day_of(ts: str | Column = "created_at") -> Column:
    """Midnight of the timestamp's day, kept as a TIMESTAMP_NTZ (null stays null)."""
    return _col(ts).cast("date").cast("timestamp_ntz")


def prune_schema(schema: StructType, fields: Sequence[str]) -> StructType:
    """The schema restricted to `fields`, in schema order.

    A dotted name (`public_metrics.retweet_count`) keeps only that member of
    a struct field; a bare name keeps the whole field.
    """
    top: dict[str, set[str] | None] = {}
    for name in fields:
        head, _, rest = name.partition(".")
        if rest:
            if top.get(head, set()) is not None:
                top.setdefault(head, set()).add(rest)
        else:
            top[head] = None
    unknown = set(top) - set(schema.fieldNames())
    if unknown:
        raise ValueError(f"fields not in schema: {sorted(unknown)}")
    kept = []
    for f in schema.fields:
        if f.name not in top:
            continue
        members = top[f.name]
        if members is not None and isinstance(f.dataType, StructType):
            f = StructField(f.name, prune_schema(f.dataType, sorted(members)), f.nullable)
        kept.append(f)
    return StructType(kept)


def parse_tweets(
    raw_df: DataFrame,
    schema: StructType = TWEET_SCHEMA,
    value_col: str = "value",
    fields: Sequence[str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Raw messages -> one typed row per message, `created_at` as a timestamp.
    Columns of the messages named in `keep` (partition, offset, ...) come first.

    A message that cannot be parsed still yields a row (all columns null), so
    the row count always equals the message count.

    `fields` limits the parse to the columns a result needs. The parser then
    builds values only for those fields; since every field is parsed on its
    own (a bad field nulls only itself), the kept columns are unchanged.

    The parsed struct is expanded with `inline(array(...))`, a generator,
    rather than `select("data.*")`. Catalyst pushes a filter on a projected
    field (`id IS NOT NULL`) below a projection by copying the from_json into
    it, which parses every message twice; it does not push a filter on
    generated columns below the generator, so each message is parsed once.
    A null struct expands to one all-null row, so no message is lost.
    """
    if fields is not None:
        schema = prune_schema(schema, fields)
    parsed = raw_df.select(*keep, F.inline(F.array(parse_json(value_col, schema))))
    if "created_at" in schema.fieldNames():
        parsed = parsed.withColumn("created_at", created_at_timestamp("created_at"))
    return parsed


def flatten_metrics(df: DataFrame, struct_col: str = "public_metrics") -> DataFrame:
    """Replace the metrics struct by one top-level column per metric, in place."""
    if struct_col not in df.columns:
        return df
    members = df.schema[struct_col].dataType.fieldNames()  # all metrics, or a pruned subset
    cols = []
    for name in df.columns:
        if name == struct_col:
            cols.extend(F.col(f"{struct_col}.{m}").alias(m) for m in members)
        else:
            cols.append(F.col(name))
    return df.select(*cols)


def encode_json(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Typed rows -> one JSON message per row in a binary `value` column.

    Null fields are left out of the object, as a JSON encoder of the record
    would; parsing the message again gives the same row back.
    """
    body = F.to_json(
        F.struct(*[F.col(c) for c in df.columns]),
        {"timestampNTZFormat": CREATED_AT_FORMAT, "timestampFormat": CREATED_AT_FORMAT},
    )
    return df.select(body.cast("binary").alias(value_col))
