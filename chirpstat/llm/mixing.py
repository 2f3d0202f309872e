"""Operator 7: mixing sources to target weights by temperature.

The token shares p of the sources are raised to an exponent a in [0, 1] and
normalised: a = 1 keeps the shares, a = 0 makes all sources equal. The exponent
is bisected so that the weights have a target entropy, or so that no source is
repeated more often than a limit. The weights are realised under a token
budget: a source whose part of the budget is e times its tokens gives
floor(e) whole passes and, for the rest, a part of one more pass, cut block by
block: its documents are dealt by hash into blocks of bounded size, each block
is permuted by hash, and the running token count in the block decides which
documents come once more. A source of any size is thus split over many blocks,
and no task holds more than one.

With no budget given it is the smallest one with which every document comes at
least once. Tokens are runs of characters other than ASCII white space.
Defined results: documents without tokens (null or empty texts) come like the
others, by their place in the permutation; a null source is a
source of its own; rows with equal ids are dealt with one by one; an empty
table gives an empty result. Only doc_id, text and source are read; other
columns are carried by `mix_documents`, which repeats the rows themselves.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chirpstat.llm.common import land, table

BLOCK_TOKENS = 2_000_000


@dataclass(frozen=True)
class Target:
    """What the exponent is bisected for: an entropy (nats), or the most passes of any source."""

    entropy: float | None = None
    max_passes: float | None = 2.0
    budget_tokens: int | None = None
    seed: int = 17


def token_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space (null: none)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def tempered(tokens: dict, exponent: float) -> dict:
    """Normalised weights of the sources' token shares raised to `exponent`."""
    total = sum(tokens.values())
    raw = {s: (n / total) ** exponent if n else 0.0 for s, n in tokens.items()}
    norm = sum(raw.values())
    return {s: v / norm for s, v in raw.items()}


def entropy(weights: dict) -> float:
    return -sum(w * math.log(w) for w in weights.values() if w > 0)


def passes(tokens: dict, weights: dict, budget: int | None) -> dict:
    """How often each source comes under the budget; by default every source at least once."""
    live = {s: n for s, n in tokens.items() if n}
    if budget is None:
        budget = max(n / weights[s] for s, n in live.items())
    times = {s: weights[s] * budget / n if n else 1.0 for s, n in tokens.items()}
    # rounding must not turn a whole pass into a part of one
    return {s: float(round(x)) if abs(x - round(x)) < 1e-9 else x for s, x in times.items()}


def solve_exponent(tokens: dict, target: Target, rounds: int = 60) -> float:
    """The exponent nearest to 0 that keeps to the limit, or that reaches the entropy, by bisection."""

    def short(a: float) -> bool:
        """Whether the exponent has to grow towards 1."""
        weights = tempered(tokens, a)
        if target.entropy is not None:
            return entropy(weights) > target.entropy
        return max(passes(tokens, weights, target.budget_tokens).values()) > target.max_passes

    if not short(0.0):
        return 0.0
    low, high = 0.0, 1.0
    if target.entropy is not None:  # a target below that of the shares takes an exponent above 1
        while short(high) and high < 64:
            high *= 2
    for _ in range(rounds):
        middle = (low + high) / 2
        low, high = (middle, high) if short(middle) else (low, middle)
    return high


def _row_hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))


def narrow_rows(docs: DataFrame, seed: int) -> DataFrame:
    """doc_id, source, n_tokens and row_hash of every row, landed so that texts are counted once."""
    return land(docs.select("doc_id", "source", token_count(F.col("text")).alias("n_tokens"), _row_hash(seed).alias("row_hash")), "mixing")


def cuts(rows: DataFrame, target: Target = Target(), block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """What every (source, block) gives: weight, passes, blocks of the source, and the last row_hash of its part pass.

    `rows` has source, n_tokens and row_hash. One row per block of `block_tokens`.
    """
    tokens = {r["source"]: int(r["n"]) for r in rows.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    live = any(tokens.values())
    weights = tempered(tokens, solve_exponent(tokens, target)) if live else dict.fromkeys(tokens, 0.0)
    times = passes(tokens, weights, target.budget_tokens) if live else dict.fromkeys(tokens, 1.0)
    kind = dict(rows.dtypes)["source"]
    sources = rows.sparkSession.createDataFrame(
        [(s, weights[s], times[s], max(1, math.ceil(n / block_tokens))) for s, n in tokens.items()],
        f"source {kind}, weight double, passes double, blocks int",
    )
    joined = _with_block(rows, sources)
    part = F.col("passes") - F.floor("passes")
    in_block = Window.partitionBy("source", "block")
    ordered = in_block.orderBy("row_hash").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = F.sum("n_tokens").over(ordered) - F.col("n_tokens") / 2
    taken = (part > 1e-9) & (middle <= part * F.sum("n_tokens").over(in_block))
    joined = joined.withColumn("taken", F.when(taken, F.col("row_hash")))
    return joined.groupBy("source", "block").agg(
        F.first("weight").alias("weight"), F.first("passes").alias("passes"), F.first("blocks").alias("blocks"), F.max("taken").alias("cut")
    )


def _with_block(rows: DataFrame, sources: DataFrame) -> DataFrame:
    # a row per source: Spark's own size check decides how this side is sent
    joined = rows.alias("r").join(sources.alias("s"), F.expr("r.source <=> s.source")).select("r.*", "s.weight", "s.passes", "s.blocks")
    return joined.withColumn("block", F.pmod(F.hash("row_hash"), F.col("blocks")))


def _copies(rows: DataFrame, landed_cuts: DataFrame) -> DataFrame:
    """rows (source, row_hash, ...) with weight, passes, block and copies."""
    sources = landed_cuts.groupBy("source").agg(*[F.first(c).alias(c) for c in ("weight", "passes", "blocks")])
    own = landed_cuts.select("source", "block", "cut")
    joined = _with_block(rows, sources).alias("r").join(own.alias("c"), F.expr("r.source <=> c.source AND r.block = c.block"), "left")
    extra = F.coalesce(F.col("r.row_hash") <= F.col("c.cut"), F.lit(False))
    return joined.select("r.*", (F.floor("r.passes").cast("int") + extra.cast("int")).alias("copies")).drop("blocks")


def plan(docs: DataFrame, target: Target = Target(), block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Per document: doc_id, source, n_tokens, row_hash (its place in the block), weight, passes, block, copies."""
    rows = narrow_rows(docs, target.seed)
    return _copies(rows, land(cuts(rows, target, block_tokens), "mixing-cuts"))


def mix_documents(docs: DataFrame, target: Target = Target(), block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The rows of `docs` (all columns), each as often as the plan says."""
    landed = land(cuts(narrow_rows(docs, target.seed), target, block_tokens), "mixing-cuts")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("source"), _row_hash(target.seed).alias("row_hash")
    )
    planned = _copies(rows, landed).where("copies > 0")
    return planned.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of every document under the default target (no source passed more than twice, none dropped)."""
    return plan(table(spark, sf_dir, "documents")).select(
        "doc_id", "source", "n_tokens", F.round("weight", 9).alias("weight"), F.round("passes", 9).alias("passes"), "block", "copies"
    )
