"""Operator 13: embedding near-duplicates by randomised-rotation binary codes.

Vectors of one label whose cosine reaches a threshold are linked.

1. *Copies.* Equal vectors of one label are one node with a count, so that a
   group of copies is never expanded into pairs. Equality is that of a 128-bit hash.
2. *Codes.* A node's unit vector goes through seeded random rotations; the signs
   are its code, and the inner product of code and vector its correction factor.
   Codes and factors are stored.
3. *Candidates.* Two vectors at an angle t differ in a sign with probability t / pi,
   so every node is put into buckets by several independent draws of signs, as many
   as keep the stated recall for a pair exactly at the threshold (closer pairs have
   more). The number of signs follows from the largest label, so that buckets stay
   small however many vectors there are. In a bucket, codes closer than the upper
   confidence bound of a pair at the threshold are candidates. Codes within `fold`
   bits of a leader are folded into it, leaders are compared with a limit wider by
   twice that, which loses no pair, and only a spanning forest leaves the task.
   A bucket of over `bucket_rows` rows is dealt into blocks, and blocks are paired.
4. *Exact comparison.* The candidates' connected groups are cut into blocks of
   about `block` nodes, each packed into one row. For each pair of blocks the stored
   codes and factors give unbiased estimates of all inner products; a pair whose
   upper confidence bound lies below the threshold is done with, the others are
   computed again from the vectors in double precision. Only counts of links and a
   spanning forest of them leave the task.
5. *Components* of the links by alternating stars over landed tables.

Defined results: a vector that is null, all zero or holds null or non-finite
components, and a row whose label is null, link with nothing: no links, its own id
as component, kept. Vectors of different lengths do not link. Repeated rows are
vectors of their own, linked as copies. component_id is the smallest non-null id;
a row with a null id is not kept (kept is vec_id = component_id, never null), its
component_id is null where no id is reachable. An empty table gives no rows. Only
vec_id, label and the vector are read, so other columns may have any names.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chirpstat.llm.common import components, land, mix64, small_batches, table, whole_groups
from chirpstat.llm.vectors import usable


#: packed blocks in an Arrow batch
PACKED_ROWS = 32


@dataclass(frozen=True)
class Near:
    """What is near, and what bounds tasks.

    `recall` is that of the buckets for a pair at the threshold, `sigmas` the width
    of the confidence bounds in standard deviations.
    """

    threshold: float = 0.93
    recall: float = 0.999
    sigmas: float = 5.0
    code_bits: int = 256
    bucket: int = 512
    bucket_rows: int = 20_000
    block: int = 2_048
    seed: int = 13

    @property
    def differ(self) -> float:
        """Probability that a sign differs between two vectors at the threshold."""
        return math.acos(self.threshold) / math.pi

    def limit(self, bits: int) -> int:
        """Upper confidence bound of the differing signs of a pair at the threshold."""
        return math.ceil(bits * self.differ + self.sigmas * math.sqrt(bits * self.differ * (1 - self.differ)))

    def fold(self, bits: int) -> int:
        return bits // 21

    def signs(self, largest: int) -> int:
        """Signs of a bucket's name, for a label of so many nodes."""
        return min(48, max(4, math.ceil(math.log2(max(1, largest / self.bucket)))))

    def tables(self, signs: int) -> int:
        return math.ceil(math.log(1 - self.recall) / math.log(1 - (1 - self.differ) ** signs))


@functools.lru_cache(maxsize=16)
def rotations(dims: int, count: int, seed: int) -> np.ndarray:
    """`count` random rotations of `dims` dimensions, below one another."""
    draw = np.random.default_rng([seed, dims])
    made = []
    for _ in range(count):
        q, r = np.linalg.qr(draw.standard_normal((dims, dims)))
        made.append((q * np.sign(np.diag(r))).T)
    return np.concatenate(made)


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; no row is zero."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _rounds(dims: int, bits: int) -> int:
    return math.ceil(bits / dims)


def encode(unit: np.ndarray, spec: Near) -> tuple[np.ndarray, np.ndarray]:
    """Codes (packed bits) and correction factors of unit vectors."""
    turned = unit @ rotations(unit.shape[1], _rounds(unit.shape[1], spec.code_bits), spec.seed).T
    width = turned.shape[1]
    # the rotations together keep lengths once divided by the root of their number
    factor = np.abs(turned).sum(axis=1) / math.sqrt(width) / math.sqrt(width / unit.shape[1])
    return np.packbits(turned >= 0, axis=1), factor


def bucket_names(unit: np.ndarray, signs: int, tables: int, spec: Near) -> np.ndarray:
    """For every unit vector and table the drawn signs as one number."""
    dims = unit.shape[1]
    width = signs * tables
    count = max(_rounds(dims, width), _rounds(dims, spec.code_bits))
    turned = unit @ rotations(dims, count, spec.seed).T >= 0
    drawn = np.random.default_rng([spec.seed, dims, 1]).permutation(turned.shape[1])[:width]
    bits = turned[:, drawn].reshape(len(unit), tables, signs)
    return bits @ (np.int64(1) << np.arange(signs, dtype=np.int64))


# --- What a task does with a bucket or with two blocks ------------------------------


def forest(linked: np.ndarray) -> np.ndarray:
    """The component of every node of a symmetric link matrix: its smallest node."""
    label = np.arange(len(linked))
    todo = linked.any(axis=1)
    while todo.any():
        first = int(np.argmax(todo))
        reached = np.zeros(len(linked), dtype=bool)
        reached[first] = True
        front = reached.copy()
        while front.any():
            front = linked[front].any(axis=0) & ~reached
            reached |= front
        label[reached] = first
        todo &= ~reached
    return label


def _differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of every row of a with every row of b (rows of 64-bit words)."""
    out = np.zeros((len(a), len(b)), dtype=np.uint16)
    for w in range(a.shape[1]):
        out += np.bitwise_count(a[:, w, None] ^ b[None, :, w])
    return out


def _words(codes: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"".join(codes), dtype=np.uint8).reshape(len(codes), -1)
    pad = -raw.shape[1] % 8
    return np.ascontiguousarray(np.pad(raw, ((0, 0), (0, pad)))).view(np.uint64)


class Leaders:
    """The leaders of one bucket, met block by block, and their components."""

    def __init__(self, limit: int, fold: int, tile: int = 1024):
        self.limit, self.fold, self.tile = limit, fold, tile
        self.codes: list[np.ndarray] = []
        self.nodes: list[np.ndarray] = []
        self.part = np.zeros(0, dtype=np.int64)  # component of every leader: a leader's number

    def add(self, codes: np.ndarray, nodes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Candidate links (two arrays of nodes) that connect what the block adds."""
        wide = self.limit + 2 * self.fold
        nearest = np.full(len(nodes), np.iinfo(np.int64).max)
        leader = np.zeros(len(nodes), dtype=np.int64)
        met: list[tuple[np.ndarray, np.ndarray]] = []
        at = 0
        for own, own_nodes in zip(self.codes, self.nodes, strict=True):
            d = _differing(codes, own)
            least = d.min(axis=1)
            closer = least < nearest
            nearest[closer], leader[closer] = least[closer], own_nodes[d.argmin(axis=1)[closer]]
            i, j = np.nonzero(d <= wide)
            pairs = np.unique(np.column_stack([i, self.part[at + j]]), axis=0)
            met.append((pairs[:, 0], pairs[:, 1]))
            at += len(own)
        folded = nearest <= self.fold
        if folded.any():
            yield nodes[folded], leader[folded]
        rest = np.nonzero(~folded)[0]
        if not len(rest):
            return
        mine = _differing(codes[rest], codes[rest]) <= wide
        np.fill_diagonal(mine, False)
        label = forest(mine)
        other = label != np.arange(len(rest))
        if other.any():
            yield nodes[rest[other]], nodes[rest[label[other]]]
        base = len(self.part)
        part = np.concatenate([self.part, base + label])
        if met:
            place = np.full(len(nodes), -1)
            place[rest] = np.arange(len(rest))
            i, j = np.concatenate([m[0] for m in met]), np.concatenate([m[1] for m in met])
            own = place[i] >= 0
            pairs = np.unique(np.column_stack([base + label[place[i[own]]], j[own]]), axis=0)
            if len(pairs):
                all_nodes = np.concatenate([*self.nodes, nodes[rest]])
                yield all_nodes[pairs[:, 0]], all_nodes[pairs[:, 1]]
                part = _merged(part, pairs)
        self.part = part
        for lo in range(0, len(rest), self.tile):
            self.codes.append(codes[rest[lo : lo + self.tile]])
            self.nodes.append(nodes[rest[lo : lo + self.tile]])


def _merged(part: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Components after those of each pair are joined."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs.tolist():
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    names, place = np.unique(part, return_inverse=True)
    return np.array([find(x) for x in names.tolist()])[place]


def bucket_links(codes: np.ndarray, nodes: np.ndarray, limit: int, fold: int, step: int = 1024) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect all candidate pairs of a bucket."""
    leaders = Leaders(limit, fold)
    for lo in range(0, len(nodes), step):
        yield from leaders.add(codes[lo : lo + step], nodes[lo : lo + step])


@dataclass
class Block:
    """Nodes of one block: their copies, label hashes, codes, factors and vectors."""

    node: np.ndarray
    copies: np.ndarray
    label: np.ndarray
    code: np.ndarray
    factor: np.ndarray
    unit: np.ndarray


def linked(a: Block, b: Block, spec: Near, tile: int = 512) -> tuple[np.ndarray, int]:
    """Which nodes of a and b are linked, and how many pairs were computed exactly."""
    dims = a.unit.shape[1]
    count = _rounds(dims, spec.code_bits)
    width = dims * count
    turned = (b.unit @ rotations(dims, count, spec.seed).T) / math.sqrt(count)
    out, exact = np.zeros((len(a.node), len(b.node)), dtype=bool), 0
    for lo in range(0, len(a.node), tile):
        hi = lo + tile
        signs = np.unpackbits(a.code[lo:hi], axis=1, count=width) * 2.0 - 1.0
        factor = a.factor[lo:hi, None]
        estimate = signs @ turned.T / math.sqrt(width) / factor
        spread = np.sqrt(np.maximum(0.0, 1 - factor**2)) / factor / math.sqrt(max(1, width - 1))
        open_ = estimate + spec.sigmas * spread >= spec.threshold
        rows, columns = np.nonzero(open_.any(axis=1))[0], np.nonzero(open_.any(axis=0))[0]
        if len(rows):
            exact += int(open_.sum())
            near = a.unit[lo:hi][rows] @ b.unit[columns].T >= spec.threshold
            out[np.ix_(lo + rows, columns)] = near & open_[np.ix_(rows, columns)]
    out &= (a.label[:, None, :] == b.label[None, :, :]).all(axis=2)
    return out, exact


# --- The Spark jobs -----------------------------------------------------------------


def _rows(rows: DataFrame, vector: str) -> DataFrame:
    """Landed: row (a number of its own), vec_id, v, and for rows that can link g1, g2 (label) and h1, h2 (label and vector)."""
    v = F.col(vector)
    if rows.schema[vector].dataType.simpleString() not in ("array<float>", "array<double>"):
        v = v.cast("array<double>")
    able = F.col("label").isNotNull() & F.coalesce(usable(v) & F.exists(v, lambda x: x != 0), F.lit(False))
    base = rows.select("vec_id", "label", v.alias("v"), able.alias("able"))
    hashes = []
    for name, of in (("g", ("label", F.size("v"))), ("h", ("label", "v"))):
        hashes.append(F.when(F.col("able"), F.xxhash64(*of)).alias(f"{name}1"))
        hashes.append(F.when(F.col("able"), F.xxhash64(F.lit(7), *of)).alias(f"{name}2"))
    return land(base.select("vec_id", "v", *hashes, F.monotonically_increasing_id().alias("row")), "vectors")


def _codes(nodes: DataFrame, signs: int, tables: int, spec: Near) -> DataFrame:
    """Landed: node, code, factor, and the node's bucket keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(3)
            sizes = np.diff(np.asarray(vectors.offsets)) if len(batch) else np.zeros(0, dtype=int)
            for dims in np.unique(sizes):
                pick = np.nonzero(sizes == dims)[0]
                own = batch.take(pa.array(pick))
                unit = units(np.asarray(own.column(3).flatten()).reshape(len(pick), dims).astype(np.float64))
                code, factor = encode(unit, spec)
                names = bucket_names(unit, signs, tables, spec).astype(np.uint64)
                label = mix64(np.asarray(own.column(1)).astype(np.uint64)) ^ np.asarray(own.column(2)).astype(np.uint64)
                keys = mix64(mix64(label[:, None] + np.arange(tables, dtype=np.uint64)) + names).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(factor), pa.array(list(keys), pa.list_(pa.int64()))],
                    ["node", "code", "factor", "keys"],
                )

    made = nodes.select("node", "g1", "g2", "v").mapInArrow(run, "node long, code binary, factor double, keys array<long>")
    return land(made, "codes")


def candidates(codes: DataFrame, spec: Near) -> DataFrame:
    """Links (a, b) that connect every pair of nodes which share a bucket and have close codes."""
    rows = codes.select(F.explode("keys").alias("key"), "node", "code")
    large = rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > spec.bucket_rows)
    blocks = F.ceil(F.col("n") / spec.bucket_rows).cast("int")
    # landed, so that Spark broadcasts the large buckets' names only if their files are small
    large = land(large.select("key", blocks.alias("blocks")), "large-buckets")
    dealt = rows.join(large, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("node", "key"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = dealt.withColumn("own", own).select("*", other.alias("other"))
    name = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(batches, "bucket"):
            bucket, node, code = (frame[c].to_numpy() for c in ("bucket", "node", "code"))
            starts = np.append(np.nonzero(np.append(True, bucket[1:] != bucket[:-1]))[0], len(bucket))
            found = []
            for lo, hi in zip(starts[:-1], starts[1:], strict=True):
                if hi - lo > 1:
                    words = code[lo:hi].tolist()
                    bits = len(words[0]) * 8
                    found.extend(bucket_links(_words(words), node[lo:hi], spec.limit(bits), spec.fold(bits)))
            if found:
                yield pd.DataFrame({"a": np.concatenate([f[0] for f in found]), "b": np.concatenate([f[1] for f in found])})

    dealt = dealt.select(name.alias("bucket"), "node", "code").repartition("bucket").sortWithinPartitions("bucket", "node")
    return dealt.mapInPandas(run, "a long, b long")


def _block(rows: pa.StructArray) -> Block:
    column = {f.name: rows.field(i) for i, f in enumerate(rows.type)}
    n = len(rows)
    vectors = column["v"]
    flat = np.asarray(vectors.flatten()).reshape(n, -1).astype(np.float64)
    label = np.column_stack([np.asarray(column["g1"]), np.asarray(column["g2"])])
    code = np.frombuffer(b"".join(column["code"].to_pylist()), dtype=np.uint8).reshape(n, -1)
    return Block(np.asarray(column["node"]), np.asarray(column["copies"]), label, code, np.asarray(column["factor"]), units(flat))


def compare(members: DataFrame, spec: Near) -> DataFrame:
    """Landed: (a, null, links) with the links of nodes, (a, b, null) with links that connect all that are linked.

    `members` has grp, node, copies, g1, g2, code, factor and v.
    """
    sizes = land(members.groupBy("grp").agg(F.ceil(F.count("*") / spec.block).cast("int").alias("blocks")), "group-sizes")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    parts = members.join(sizes, "grp").withColumn("own", own)
    row = F.struct("node", "copies", "g1", "g2", "code", "factor", "v")
    packed = parts.groupBy("grp", "own", "blocks").agg(F.collect_list(row).alias("block"))
    pairs = packed.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    keys = [F.col("grp"), F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q")]
    pairs = pairs.select(*keys, "block").repartition("grp", "p", "q").sortWithinPartitions("grp", "p", "q")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the first block of a pair whose second one comes next
        for batch in batches:
            ends, out = np.asarray(batch.column(3).offsets), []
            values = batch.column(3).values
            for i, (p, q) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                block = _block(values.slice(ends[i], ends[i + 1] - ends[i]))
                if p == q:
                    out.append(_found(block, None, spec))
                elif held is None:
                    held = block
                else:
                    out.append(_found(held, block, spec))
                    held = None
            if out:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([o[c] for o in out]) for c in range(3)], ["a", "b", "links"])

    with small_batches(members.sparkSession, PACKED_ROWS):
        return land(pairs.mapInArrow(run, "a long, b long, links long"), "links")


def _found(a: Block, b: Block | None, spec: Near) -> tuple[pa.Array, pa.Array, pa.Array]:
    if b is None:
        near, _ = linked(a, a, spec)
        near |= near.T  # the estimates of the two directions differ
        np.fill_diagonal(near, False)
        node, copies, square = a.node, near @ a.copies, near
    else:
        near, _ = linked(a, b, spec)
        node, copies = np.concatenate([a.node, b.node]), np.concatenate([near @ b.copies, a.copies @ near])
        square = np.zeros((len(node), len(node)), dtype=bool)
        square[: len(a.node), len(a.node) :] = near
        square |= square.T
    label = forest(square)
    some, tied = np.nonzero(copies)[0], np.nonzero(label != np.arange(len(label)))[0]
    no_nodes, no_links = pa.nulls(len(some), pa.int64()), pa.nulls(len(tied), pa.int64())
    return (
        pa.concat_arrays([pa.array(node[some]), pa.array(node[tied])]),
        pa.concat_arrays([no_nodes, pa.array(node[label[tied]])]),
        pa.concat_arrays([pa.array(copies[some].astype(np.int64)), no_links]),
    )


def _with_roots(stars: DataFrame) -> DataFrame:
    """`components` leaves out the smallest nodes themselves; here they are rows too."""
    roots = stars.select(F.col("label").alias("node"), "label").distinct()
    return stars.unionByName(roots)


def near_vectors(rows: DataFrame, spec: Near = Near(), vector: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of `rows` (vec_id, label and the vector column)."""
    base = _rows(rows, vector)
    able = base.where("h1 IS NOT NULL")
    classes = able.groupBy("h1", "h2").agg(F.min("row").alias("node"), F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    copied = land(classes.where("copies > 1"), "copies")  # small where copies are few, then broadcast
    known = base.join(copied, ["h1", "h2"], "left").select(
        "row", "vec_id", "g1", "g2", "v", F.coalesce("node", "row").alias("node"),
        F.coalesce("copies", F.lit(1)).alias("copies"), F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("id")).alias("id"),
    )
    nodes = known.where("g1 IS NOT NULL AND row = node")
    largest = able.groupBy("g1").count().agg(F.max("count")).first()[0]
    result = known.select("vec_id", "node", "copies", "id")
    if largest is None:  # no vector can link
        return _result(result.withColumn("links", F.lit(0).cast("long")).withColumn("least", F.col("id")))
    signs = spec.signs(largest)
    codes = _codes(nodes, signs, spec.tables(signs), spec)
    groups = land(_with_roots(components(candidates(codes, spec), "candidate-links")), "groups").withColumnRenamed("label", "grp")
    members = groups.join(nodes.select("node", "copies", "g1", "g2", "v"), "node").join(codes.select("node", "code", "factor"), "node")
    found = compare(members, spec)
    counts = found.where("b IS NULL").groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "node")
    tied = _with_roots(components(found.where("b IS NOT NULL").select("a", "b"), "link-stars"))
    named = land(tied.join(nodes.select("node", "id"), "node"), "linked-nodes")
    least = land(named.groupBy("label").agg(F.min("id").alias("least")), "component-ids")
    linked_nodes = land(named.join(least, "label").join(counts, "node").select("node", "links", "least"), "linked")
    return _result(result.join(linked_nodes, "node", "left"))


def _result(rows: DataFrame) -> DataFrame:
    component = F.coalesce("least", "id")
    links = F.coalesce("links", F.lit(0)) + F.col("copies") - 1
    return rows.select(
        "vec_id", links.cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def op13_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate links of the whole embeddings table."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


OP13_SQL = """
WITH RECURSIVE vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, label, CAST(embedding AS DOUBLE[]) AS v,
         len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS able
  FROM embeddings),
links AS MATERIALIZED (
  SELECT a.n AS a, b.n AS b FROM vectors a JOIN vectors b ON a.label = b.label AND a.n <> b.n AND len(a.v) = len(b.v)
  WHERE a.able AND b.able
    AND CASE WHEN a.able AND b.able THEN list_cosine_similarity(a.v, b.v) END >= 0.93),
reached(a, b) AS (SELECT n, n FROM vectors UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
least AS (SELECT r.a, min(v.vec_id) AS component_id FROM reached r JOIN vectors v ON r.b = v.n GROUP BY 1),
counted AS (SELECT a, count(*) AS n_links FROM links GROUP BY 1)
SELECT v.vec_id, CAST(coalesce(c.n_links, 0) AS BIGINT) AS n_links, l.component_id, coalesce(v.vec_id = l.component_id, false) AS kept
FROM vectors v JOIN least l ON v.n = l.a LEFT JOIN counted c ON v.n = c.a"""
