"""Operator 11: centroid clustering by equal-average equal-variance search.

Every vector is given to its nearest centroid. The centroids are sorted by the
mean of their components; the search starts at the vector's own mean and goes
outward on both sides, nearest mean first. With d components, of mean m and
deviation V (the length of the vector after its mean is taken off), the squared
distance of two vectors is at least

    d * (difference of the means)^2 + (difference of the deviations)^2

so the scan ends where the first term alone exceeds the best distance found,
and a centroid is passed over, unseen, where the sum does. What is left is
compared in whole numbers, exactly; the bounds are floating-point and get a
slack far above their rounding, and reject only what is strictly farther, so
ties still go to the smaller number.

A round is one pass over the landed whole-number vectors: each task searches its
batches and returns per centroid a count and the sums of its components (at most
centroids x (components + 1) numbers), which Spark adds up as decimals. Only the
centroids, k x components numbers, come to the driver and go to the tasks.
A round that moves no centroid ends the rounds, since the others would repeat it.

Defined results: rows whose vector is null, has another length, or holds null or
non-finite components are left out; a component of 2^26 or more as a whole number
is an error (its distances would not fit a long). Repeated rows are vectors of
their own. Null ids are kept; they come last among the starting centroids, and
equal ids go by their components. Fewer vectors than centroids give fewer
centroids, no vectors no rows. Only vec_id and the vector are read, so other
columns may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chirpstat.llm.common import land, table
from chirpstat.llm.vectors import lists, matrix, whole_vectors


@dataclass(frozen=True)
class Clustering:
    """What is clustered into what. `seed` names the draw of the first centroids."""

    dims: int = 64
    scale: int = 1024
    centroids: int = 8
    rounds: int = 10
    seed: int = 3


class MeanOrder:
    """Centroids sorted by mean, for the outward search."""

    def __init__(self, centroids: np.ndarray):
        self.dims = centroids.shape[1]
        sums = centroids.sum(axis=1)
        self.number = np.argsort(sums, kind="stable")
        self.rows = centroids[self.number]
        self.sums = sums[self.number]
        self.deviation = np.linalg.norm(self.rows - self.sums[:, None] / self.dims, axis=1)
        self.longest = float((self.rows.astype(float) ** 2).sum(axis=1).max())

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of each row's nearest centroid, and how many distances were worked out."""
        n, k, seen = len(x), len(self.rows), 0
        sums = x.sum(axis=1)
        deviation = np.linalg.norm(x - sums[:, None] / self.dims, axis=1)
        slack = 1e-9 * ((x.astype(float) ** 2).sum(axis=1) + self.longest) + 1e-6
        best = np.full(n, np.iinfo(np.int64).max)
        found = np.full(n, k, dtype=np.int64)
        above = np.searchsorted(self.sums, sums)  # the next centroid upward, k where there is none
        below = above - 1  # the next one downward, -1 where there is none
        live = np.arange(n)
        while len(live):
            up, down, s = above[live], below[live], sums[live]
            gap_up = np.where(up < k, self.sums[np.minimum(up, k - 1)] - s, np.inf)
            gap_down = np.where(down >= 0, s - self.sums[np.maximum(down, 0)], np.inf)
            upward = gap_up <= gap_down
            bound = np.minimum(gap_up, gap_down) ** 2 / self.dims - slack[live]
            go = bound <= best[live]  # an infinite gap, no centroid left, ends the scan too
            live, upward, bound = live[go], upward[go], bound[go]
            at = np.where(upward, above[live], below[live])
            above[live] += upward
            below[live] -= ~upward
            near = bound + (deviation[live] - self.deviation[at]) ** 2 <= best[live]
            rows, at = live[near], at[near]
            gap = x[rows] - self.rows[at]
            distance = np.einsum("ij,ij->i", gap, gap)
            seen += len(rows)
            number = self.number[at]
            better = (distance < best[rows]) | ((distance == best[rows]) & (number < found[rows]))
            rows = rows[better]
            best[rows], found[rows] = distance[better], number[better]
        return found, best, seen


def first_centroids(vectors: DataFrame, spec: Clustering) -> np.ndarray:
    """The vectors whose ids have the smallest hashes, in the order of the hashes."""
    order = F.sha2(F.concat(F.lit(f"{spec.seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(order.alias("h"), "v").orderBy(F.col("h").asc_nulls_last(), "v").limit(spec.centroids).collect()
    return np.array([r.v for r in rows], dtype=np.int64).reshape(len(rows), spec.dims)


def _sums(vectors: DataFrame, centroids: np.ndarray) -> dict[tuple[int, int], tuple[int, int]]:
    """(centroid, component) -> (vectors, sum) of the vectors nearest to the centroid."""
    k, dims = centroids.shape

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = MeanOrder(centroids)
        counts, totals = np.zeros(k, dtype=np.int64), np.zeros((k, dims), dtype=np.int64)
        for batch in batches:
            x = matrix(batch.column(0), dims)
            found, _, _ = order.nearest(x)
            counts += np.bincount(found, minlength=k)
            for c in np.unique(found):
                totals[c] += x[found == c].sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k)), pa.array(counts), lists(totals)], ["c", "n", "totals"])

    parts = vectors.select("v").mapInArrow(search, "c long, n long, totals array<long>").where("n > 0")
    parts = parts.select("c", "n", F.posexplode("totals").alias("i", "total"))
    sums = parts.groupBy("c", "i").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(20,0)")).alias("total"))
    return {(r.c, r.i): (r.n, int(r.total)) for r in sums.collect()}


def fit(vectors: DataFrame, spec: Clustering) -> np.ndarray:
    """The final centroids of the whole-number vectors (columns vec_id, v)."""
    centroids = first_centroids(vectors, spec)
    for _ in range(spec.rounds if len(centroids) else 0):
        moved = centroids.copy()
        for (c, i), (n, total) in _sums(vectors, centroids).items():
            moved[c, i] = total // n
        if (moved == centroids).all():
            break
        centroids = moved
    return centroids


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster and distance of every vector."""
    schema = f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, cluster int, distance long"

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = MeanOrder(centroids)
        for batch in batches:
            found, distance, _ = order.nearest(matrix(batch.column(1), centroids.shape[1]))
            arrays = [batch.column(0), pa.array(found.astype(np.int32)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "cluster", "distance"])

    return vectors.select("vec_id", "v").mapInArrow(search, schema)


def digest(numbers) -> str:
    """sha256 of whole numbers in decimal, joined by commas."""
    return hashlib.sha256(",".join(str(int(x)) for x in numbers).encode()).hexdigest()


def cluster_vectors(rows: DataFrame, spec: Clustering = Clustering(), vector: str = "embedding") -> DataFrame:
    """Cluster the usable vectors of `rows` (vec_id and the vector column).

    One row per vector: vec_id, cluster, distance (squared, to its centroid),
    cluster_inertia, inertia (distances summed over the cluster and over all)
    and centroid_sha256.
    """
    vectors = land(whole_vectors(rows, vector, spec.dims, spec.scale, ("vec_id",)), "whole-vectors")
    centroids = fit(vectors, spec)
    assigned = land(assign(vectors, centroids), "clustered") if len(centroids) else assign(vectors, np.zeros((1, spec.dims), np.int64))
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("total"))
    totals = {r["cluster"]: int(r["total"]) for r in sums.collect()}
    # one entry per centroid: at most as many as the caller asked for
    shown = [F.struct(F.lit(totals.get(c, 0)).cast("long").alias("inertia"), F.lit(digest(v)).alias("sha")) for c, v in enumerate(centroids)]
    known = F.array(*shown) if shown else F.array(F.struct(F.lit(0).cast("long").alias("inertia"), F.lit("").alias("sha")))
    own = F.get(known, F.col("cluster"))
    return assigned.select(
        "vec_id", "cluster", "distance", own["inertia"].alias("cluster_inertia"),
        F.lit(sum(totals.values())).cast("long").alias("inertia"), own["sha"].alias("centroid_sha256"),
    )


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole embeddings table in 8 clusters."""
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def _oracle() -> str:
    """The same clusters in SQL: every round compares every vector with every centroid."""
    spec = Clustering()
    rounds = []
    for r in range(spec.rounds + 1):
        rounds.append(
            f"d{r} AS MATERIALIZED (SELECT p.id, s.c, sum((p.x - s.x) * (p.x - s.x)) AS distance FROM parts p JOIN s{r} s ON p.i = s.i GROUP BY 1, 2), "
            f"a{r} AS MATERIALIZED (SELECT id, min(c) AS c, any_value(distance) AS distance FROM "
            f"(SELECT *, min(distance) OVER (PARTITION BY id) AS least FROM d{r}) WHERE distance = least GROUP BY 1)"
        )
        if r < spec.rounds:
            rounds.append(
                f"s{r + 1} AS MATERIALIZED (SELECT s.c, s.i, coalesce(m.x, s.x) AS x FROM s{r} s LEFT JOIN "
                f"(SELECT a.c, p.i, CAST(floor(sum(p.x) / count(*)) AS BIGINT) AS x FROM a{r} a JOIN parts p ON a.id = p.id GROUP BY 1, 2) m ON s.c = m.c AND s.i = m.i)"
            )
    last = spec.rounds
    return f"""
WITH vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS id, vec_id,
         list_transform(embedding, lambda x: CAST(floor({spec.scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {spec.dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT id, unnest(range({spec.dims})) AS i, unnest(v) AS x FROM vectors),
firsts AS (
  SELECT id, row_number() OVER (ORDER BY sha256('{spec.seed}:' || vec_id) NULLS LAST, v) - 1 AS c FROM vectors
  QUALIFY c < {spec.centroids}),
s0 AS MATERIALIZED (SELECT f.c, p.i, p.x FROM firsts f JOIN parts p ON f.id = p.id),
{', '.join(rounds)},
named AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM s{last} GROUP BY 1)
SELECT v.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.distance AS BIGINT) AS distance,
       CAST(sum(a.distance) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.distance) OVER () AS BIGINT) AS inertia, n.centroid_sha256
FROM a{last} a JOIN vectors v ON a.id = v.id JOIN named n ON a.c = n.c"""


OP11_SQL = _oracle()
