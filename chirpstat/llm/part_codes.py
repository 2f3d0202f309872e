"""Operator 12: vector code compression with a lexicographic trie over distinct parts.

A vector's whole-number components are cut into equal consecutive parts, and each
part is coded by the nearest entry of its position's codebook. To find the
nearest entries, a task sorts the distinct parts of a position as words of
numbers; they are the leaves of a trie whose inner nodes are common prefixes. The
trie is walked depth first. A node holds, for every entry of the codebook, the
squared distance over the dimensions of its prefix; its children add one
dimension each, so a prefix shared by many parts is paid for once. At the leaves
the least sum is the part's error, its first place the code, and the leaf adds
its numbers, weighted by how many parts are equal, to that entry's sums.

The walk takes children in blocks of `block` nodes, one numpy step a block, and
goes into a block before its next sibling, so a task holds at most one block of
distance vectors a level, whatever the number of parts. A trie covers the vectors
of `trie_rows` rows at a time; no part is shuffled. Per round Spark adds up, for
every entry, the counts and sums of the tasks. Only the codebooks (positions x
entries x dimensions of a part) come to the driver and go to the tasks.

Defined results: rows whose vector is null or holds null or non-finite components
are left out, and so are vectors of another length than `dims`, which cannot be
cut for the same codebooks; a component of 2^26 or more as a whole number is an
error. Repeated rows are vectors of their own. Null ids are kept and come last
among the first entries; equal ids go by their components. Fewer vectors than
entries give fewer entries, no vectors no rows. Null labels are one label. Only
vec_id, label and the vector are read, so other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chirpstat.llm.centroids import digest
from chirpstat.llm.common import land, table
from chirpstat.llm.vectors import lists, matrix, whole_vectors


@dataclass(frozen=True)
class Codes:
    """How vectors are cut and coded. `trie_rows` and `block` bound a task's memory."""

    dims: int = 64
    scale: int = 256
    parts: int = 16
    entries: int = 64
    rounds: int = 2
    trie_rows: int = 40_000
    block: int = 4_096

    @property
    def width(self) -> int:
        return self.dims // self.parts


class Trie:
    """The distinct rows of a matrix in lexicographic order, by common prefixes.

    `leaf` is the distinct row of every given row, `weight` how many given rows
    equal a distinct one. Level j holds the distinct prefixes of j + 1 numbers:
    their last number and where their children start in level j + 1.
    """

    def __init__(self, rows: np.ndarray):
        n, self.depth = rows.shape
        order = np.lexsort(rows.T[::-1])
        ordered = rows[order]
        # the first number in which a row differs from the one before it
        changed = np.ones((n, self.depth), dtype=bool)
        if n:
            changed[1:] = ordered[1:] != ordered[:-1]
        opens = np.logical_or.accumulate(changed, axis=1)  # a new prefix of j + 1 numbers starts here
        self.numbers = [ordered[opens[:, j], j] for j in range(self.depth)]
        self.first_child = []
        for j in range(self.depth - 1):
            place = np.cumsum(opens[:, j + 1]) - 1
            self.first_child.append(np.append(place[opens[:, j]], len(self.numbers[j + 1])))
        leaf = np.cumsum(opens[:, -1]) - 1
        self.leaf = np.empty(n, dtype=np.int64)
        self.leaf[order] = leaf
        self.leaves = ordered[opens[:, -1]]
        self.weight = np.bincount(leaf, minlength=len(self.leaves))

    def nearest(self, book: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
        """For every leaf the first nearest entry of the codebook, and its squared distance."""
        code = np.empty(len(self.leaves), dtype=np.int64)
        error = np.empty(len(self.leaves), dtype=np.int64)
        # nodes lo..hi of a level, with the level above's distance vectors and each node's place in them
        todo = []

        def push(level: int, lo: int, hi: int, above: np.ndarray, parent: np.ndarray) -> None:
            for start in reversed(range(lo, hi, block)):  # the leftmost block is taken first
                end = min(start + block, hi)
                todo.append((level, start, end, above, parent[start - lo : end - lo]))

        roots = len(self.numbers[0])
        push(0, 0, roots, np.zeros((1, len(book)), dtype=np.int64), np.zeros(roots, dtype=np.int64))
        while todo:
            level, lo, hi, above, parent = todo.pop()
            gap = self.numbers[level][lo:hi, None] - book[None, :, level]
            gap *= gap
            gap += above[parent]
            if level == self.depth - 1:
                code[lo:hi] = gap.argmin(axis=1)
                error[lo:hi] = gap[np.arange(hi - lo), code[lo:hi]]
                continue
            starts = self.first_child[level][lo : hi + 1]
            push(level + 1, int(starts[0]), int(starts[-1]), gap, np.repeat(np.arange(hi - lo), np.diff(starts)))
        return code, error

    def sums(self, code: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
        """Per entry, how many rows have it and the sums of their numbers."""
        counts, totals = np.zeros(entries, dtype=np.int64), np.zeros((entries, self.depth), dtype=np.int64)
        np.add.at(counts, code, self.weight)
        np.add.at(totals, code, self.leaves * self.weight[:, None])
        return counts, totals


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The batches joined to tables of about `rows` rows (at least one batch each)."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def first_books(vectors: DataFrame, spec: Codes) -> np.ndarray:
    """The codebooks (part, entry, place) of the vectors with the smallest ids, ascending."""
    rows = vectors.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(spec.entries).collect()
    cut = np.array([r.v for r in rows], dtype=np.int64).reshape(len(rows), spec.parts, spec.width)
    return cut.transpose(1, 0, 2).copy()


def _round(vectors: DataFrame, books: np.ndarray, spec: Codes) -> np.ndarray:
    """The codebooks after every used entry is replaced by the floor of its parts' mean."""
    entries = books.shape[1]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((spec.parts, entries), dtype=np.int64)
        totals = np.zeros((spec.parts, entries, spec.width), dtype=np.int64)
        for rows in _gathered(batches, spec.trie_rows):
            x = matrix(rows.column(0), spec.dims).reshape(-1, spec.parts, spec.width)
            for p in range(spec.parts):
                trie = Trie(x[:, p])
                code, _ = trie.nearest(books[p], spec.block)
                n, total = trie.sums(code, entries)
                counts[p] += n
                totals[p] += total
        arrays = [pa.array(np.arange(spec.parts * entries)), pa.array(counts.reshape(-1)), lists(totals.reshape(-1, spec.width))]
        yield pa.RecordBatch.from_arrays(arrays, ["e", "n", "totals"])

    parts = vectors.select("v").mapInArrow(walk, "e long, n long, totals array<long>").where("n > 0")
    parts = parts.select("e", "n", F.posexplode("totals").alias("i", "total"))
    sums = parts.groupBy("e", "i").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(20,0)")).alias("total"))
    flat = books.copy().reshape(-1, spec.width)
    for r in sums.collect():  # at most as many rows as the codebooks have numbers
        flat[r.e, r.i] = int(r.total) // r.n
    return flat.reshape(books.shape)


def fit(vectors: DataFrame, spec: Codes) -> np.ndarray:
    """The final codebooks (part, entry, place) of the whole-number vectors."""
    books = first_books(vectors, spec)
    for _ in range(spec.rounds if books.shape[1] else 0):
        after = _round(vectors, books, spec)
        if (after == books).all():  # the rounds left would repeat this one
            break
        books = after
    return books


def encode(vectors: DataFrame, books: np.ndarray, spec: Codes) -> DataFrame:
    """vec_id, label, code (two hex digits a part) and error of every vector."""
    types = {f.name: f.dataType.simpleString() for f in vectors.schema.fields}
    schema = f"vec_id {types['vec_id']}, label {types['label']}, code string, error long"

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _gathered(batches, spec.trie_rows):
            x = matrix(rows.column(2), spec.dims).reshape(-1, spec.parts, spec.width)
            codes = np.empty((len(x), spec.parts), dtype=np.uint8)
            errors = np.zeros(len(x), dtype=np.int64)
            for p in range(spec.parts):
                trie = Trie(x[:, p])
                code, error = trie.nearest(books[p], spec.block)
                codes[:, p] = code[trie.leaf]
                errors += error[trie.leaf]
            shown = pa.array([c.tobytes().hex() for c in codes], pa.string())
            done = pa.table([rows.column(0), rows.column(1), shown, pa.array(errors)], names=["vec_id", "label", "code", "error"])
            yield from done.combine_chunks().to_batches()

    return vectors.select("vec_id", "label", "v").mapInArrow(walk, schema)


def compress(rows: DataFrame, spec: Codes = Codes(), vector: str = "embedding") -> DataFrame:
    """Code the usable vectors of `rows` (vec_id, label and the vector column).

    One row per vector: vec_id, code, error (squared distance to what the code
    stands for), label_error (summed over equal labels) and codebooks_sha256.
    """
    if spec.dims % spec.parts or spec.entries > 256:
        raise ValueError("dims must be a multiple of parts, and an entry's number must fit two hex digits")
    vectors = land(whole_vectors(rows, vector, spec.dims, spec.scale, ("vec_id", "label")), "whole-vectors")
    books = fit(vectors, spec)
    if not books.shape[1]:
        books = np.zeros((spec.parts, 1, spec.width), dtype=np.int64)
    coded = land(encode(vectors, books, spec), "coded")
    # Landed, so that Spark broadcasts the sums only if their files are small. Otherwise a
    # label of a third of all rows is dealt over its copies of the sum by `_salt`.
    per_label = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(20,0)")).cast("long").alias("label_error"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    sums = land(per_label, "label-errors").select("label", "label_error", salts.alias("_salt"))
    left = coded.withColumn("_salt", F.pmod(F.xxhash64("code", "vec_id"), F.lit(SALTS)).cast("int"))
    on = F.col("a.label").eqNullSafe(F.col("b.label")) & (F.col("a._salt") == F.col("b._salt"))
    joined = left.alias("a").join(sums.alias("b"), on)
    return joined.select("a.vec_id", "a.code", "a.error", "b.label_error", F.lit(digest(books.reshape(-1))).alias("codebooks_sha256"))


#: Copies of a label's sum where the sums are joined by a shuffle.
SALTS = 16


def op12_part_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole embeddings table, coded."""
    return compress(table(spark, sf_dir, "embeddings"))


def _oracle() -> str:
    """The same codes in SQL: every round compares every part with every entry."""
    spec = Codes()
    rounds = []
    for r in range(spec.rounds + 1):
        rounds.append(
            f"d{r} AS MATERIALIZED (SELECT x.id, x.p, s.e, sum((x.x - s.x) * (x.x - s.x)) AS error FROM numbers x JOIN s{r} s ON x.p = s.p AND x.i = s.i GROUP BY ALL), "
            f"a{r} AS MATERIALIZED (SELECT id, p, arg_min(e, (error, e)) AS e, min(error) AS error FROM d{r} GROUP BY ALL)"
        )
        if r < spec.rounds:
            rounds.append(
                f"s{r + 1} AS MATERIALIZED (SELECT s.p, s.e, s.i, coalesce(m.x, s.x) AS x FROM s{r} s LEFT JOIN "
                f"(SELECT a.p, a.e, x.i, CAST(floor(sum(x.x) / count(*)) AS BIGINT) AS x FROM a{r} a JOIN numbers x ON a.id = x.id AND a.p = x.p GROUP BY ALL) m "
                f"ON s.p = m.p AND s.e = m.e AND s.i = m.i)"
            )
    last = spec.rounds
    return f"""
WITH vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS id, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor({spec.scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {spec.dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
numbers AS MATERIALIZED (
  SELECT id, n // {spec.width} AS p, n % {spec.width} AS i, x
  FROM (SELECT id, unnest(range({spec.dims})) AS n, unnest(v) AS x FROM vectors)),
firsts AS (
  SELECT id, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS e FROM vectors QUALIFY e < {spec.entries}),
s0 AS MATERIALIZED (SELECT x.p, f.e, x.i, x.x FROM firsts f JOIN numbers x ON f.id = x.id),
{', '.join(rounds)},
books AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256 FROM s{last}),
coded AS (
  SELECT id, string_agg(printf('%02x', CAST(e AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(error) AS BIGINT) AS error
  FROM a{last} GROUP BY 1)
SELECT v.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY v.label) AS BIGINT) AS label_error, b.codebooks_sha256
FROM coded c JOIN vectors v ON c.id = v.id, books b"""


OP12_SQL = _oracle()
