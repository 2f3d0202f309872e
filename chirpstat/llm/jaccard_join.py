"""Operator 9: Jaccard join on word 5-grams by chosen paths.

Every text is the set of its runs of five words (a text of one to four words:
the one run of all its words). Texts with equal sets are copies; one of each,
the representative, goes on. A representative has SKETCH minimum hashes, which
agree at a place with the probability of the sets' Jaccard similarity.

Chosen paths: every run starts with all representatives and splits them by the
element (minimum hash) at a place of its own; buckets that are still large are
split again, each at several places sampled from its path, and so on. Small
buckets, and those left at the greatest depth, are searched by brute force on
sketches; for that a bucket is cut into blocks, each packed into one row, and every
pair of blocks is compared. Near copies agree at most places, so splitting does not
part them, it only copies them; buckets are split where they are too large for that. A pair above the
threshold agrees at a place with at least that probability, and one that
disagrees at one of a bucket's places has the others: `Join.splits` takes as
many runs, and places a bucket, as keep the target recall for pairs that stay in
large buckets down to the greatest depth.

Pairs whose sketches may reach the threshold join their texts into one
candidate group. The sets of each group are then fetched once and compared
exactly, in pairs of blocks of bounded size; every pair of a group is judged,
also those that no run has brought together. Links are counted, never listed:
a text's links are its copies and the copies of every representative at or
above the threshold.

Defined results: a null or empty text, or one without a word, is a class of its
own with no links; rows with equal id and text are copies of each other; where
ids are null or not unique, documents are numbered, but a class with an id still
bears its smallest one in the query's result (`named`), and other classes negative
numbers; an empty table gives an empty result. Words are runs of characters other than
ASCII white space.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chirpstat.llm.common import Lookup, components, land, mix64, numbered, small_batches, table, whole_groups

WORDS = 5
SKETCH = 64
#: places at which a bucket is split again, at most
WIDEST = 4
#: packed blocks in an Arrow batch
PACKED_ROWS = 256
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_BASE = np.array([0x9E3779B97F4A7C15], np.uint64)


@dataclass(frozen=True)
class Join:
    threshold: float = 0.8
    recall: float = 0.9999
    #: buckets up to this size are searched by brute force in one piece, and up to so many times that in pairs of packed blocks
    bucket_rows: int = 400
    brute_blocks: int = 25
    depth: int = 5
    #: bounds of a block of sets that is compared with another
    block_rows: int = 400
    block_elements: int = 400_000

    @property
    def runs(self) -> int:
        """Runs until a pair at the threshold meets with the target recall, at a first split alone."""
        return max(1, math.ceil(math.log(1 - self.recall) / math.log(1 - self.threshold)))

    def missed(self, runs: int, widths: list[int]) -> float:
        """Probability that a pair at the threshold is lost, if it stays in large buckets that are split at widths[d] places each.

        Later splits share the places that are no run's own: of these, a binomial number agrees.
        """
        t, places, out = self.threshold, SKETCH - runs, 0.0
        for k in range(places + 1):
            lost = 0.0
            for width in reversed(widths):
                lost = (1 - k / places * (1 - lost)) ** width
            out += math.comb(places, k) * t**k * (1 - t) ** (places - k) * (1 - t + t * lost) ** runs
        return out

    @property
    def splits(self) -> tuple[int, list[int]]:
        """Runs, and places at which a large bucket is split at each later depth, that keep the recall at full depth."""
        for runs in range(self.runs, SKETCH // 2 + 1):
            widths = [2] * (self.depth - 1)
            for at in [d for d in range(len(widths)) for _ in range(WIDEST - 2)]:
                if self.missed(runs, widths) <= 1 - self.recall:
                    break
                widths[at] += 1
            if self.missed(runs, widths) <= 1 - self.recall:
                return runs, widths
        raise ValueError(f"{SKETCH} minimum hashes are too few for recall {self.recall} at threshold {self.threshold}")

    @property
    def sketch_agreement(self) -> int:
        """Agreeing places from which a pair may reach the threshold: five deviations below its mean."""
        t = self.threshold
        return max(1, math.floor(SKETCH * t - 5 * math.sqrt(SKETCH * t * (1 - t)) + 0.5))


def word_hashes() -> Lookup:
    """word -> 64-bit hash, remembered; every task has one of its own, which is freed with it."""
    import xxhash

    return Lookup(lambda w: xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")))


def shingles(text: str | None, memo: Lookup) -> np.ndarray:
    """Sorted hashes of the text's runs of WORDS words. `memo`: from word_hashes."""
    words = _WORD.findall(text or "")
    if not words:
        return np.zeros(0, np.uint64)
    a = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    n = max(1, len(a) - WORDS + 1)
    h = a[:n].copy()
    for k in range(1, min(WORDS, len(a))):
        h = h * _BASE + a[k : k + n]
    return np.unique(mix64(h + np.uint64(min(WORDS, len(a)))))


@functools.lru_cache(maxsize=1)
def _multipliers() -> np.ndarray:
    return mix64(np.arange(1, SKETCH + 1, dtype=np.uint64) * _BASE) | np.uint64(1)


def sketch(elements: np.ndarray) -> np.ndarray:
    """Minimum hashes (32 bits) of a set."""
    low = np.full(SKETCH, 0xFFFFFFFF, np.uint64)
    for lo in range(0, len(elements), 4096):
        low = np.minimum(low, ((elements[lo : lo + 4096, None] * _multipliers()) >> np.uint64(32)).min(0))
    return low.astype(np.uint32)


def _sketches(runs: int):
    """(doc_id, doc, text, t) -> the ids, t, n, two set fingerprints, the hashes at the runs' places and the short sketch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = word_hashes()
        for batch in batches:
            out = []
            for doc, text in zip(batch["doc"].tolist(), batch["text"], strict=True):
                s = shingles(text, memo)
                low = sketch(s)
                prints = (int(s.sum(dtype=np.uint64).view(np.int64)), int(mix64(s).sum(dtype=np.uint64).view(np.int64)))
                out.append((doc, len(s), *prints, low[:runs].view(np.int32).tolist(), (low & np.uint32(0xFFFF)).astype("<u2").tobytes()))
            frame = pd.DataFrame(out, columns=["doc", "n", "f1", "f2", "places", "sketch"])
            frame["doc_id"] = batch["doc_id"].astype("Int64").array
            frame["t"] = batch["t"].to_numpy()
            yield frame

    return run


def _agree(rows: np.ndarray, others: np.ndarray, least: int) -> np.ndarray:
    """Which rows of two matrices of short sketches agree at `least` places or more."""
    same = np.zeros((len(rows), len(others)), np.uint8)
    for k in range(SKETCH):
        same += rows[:, k, None] == others[None, :, k]
    return same >= least


def _labels(links: np.ndarray) -> np.ndarray:
    """Smallest member index of each connected component of a symmetric matrix."""
    label = np.arange(len(links))
    while True:
        near = np.where(links, label[None, :], len(links)).min(1)
        new = np.minimum(label, near)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _bucket_edges(least: int):
    """Rows sorted by bucket (and side) -> stars (a, b) over rows whose sketches agree."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_groups(batches, "bucket"):
            bucket, rep = rows["bucket"].to_numpy(), rows["rep"].to_numpy()
            marks = np.frombuffer(b"".join(rows["sketch"]), "<u2").reshape(-1, SKETCH)
            starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            found = []
            for lo, hi in zip(starts, [*starts[1:], len(rows)], strict=True):
                if hi - lo > 1:
                    order = lo + np.argsort(rep[lo:hi], kind="stable")
                    label = _labels(_agree(marks[order], marks[order], least))
                    at = np.flatnonzero(label != np.arange(len(label)))
                    found.append(np.column_stack([rep[order[at]], rep[order[label[at]]]]))
            if found:
                yield pd.DataFrame(np.concatenate(found), columns=["a", "b"])

    return run


def candidate_edges(reps: DataFrame, join: Join) -> DataFrame:
    """Stars over representatives (rep, places, sketch) whose sketches agree, by chosen paths."""
    runs, widths = join.splits
    columns = ("path", "rep", "sketch")

    def split(nodes: DataFrame, width: int, depth: int) -> DataFrame:
        """Children at `width` places, sampled from a node's path among those that are no run's own."""
        others = F.lit(SKETCH - runs)
        sampled = F.pmod(F.xxhash64("path", F.lit(depth)), others).cast("int")
        child = nodes.withColumn("sampled", sampled).withColumn("k", F.explode(F.array(*[F.lit(k) for k in range(width)])))
        child = child.withColumn("place", F.lit(runs) + (F.col("sampled") + F.col("k")) % others)
        return child.withColumn("path", F.xxhash64("path", "place", F.expr("substring(sketch, 2 * place + 1, 2)"))).select(*columns)

    roots = reps.select(F.explode(F.array(*[F.lit(r) for r in range(runs)])).alias("place"), "rep", "places", "sketch")
    nodes, leaves = roots.withColumn("path", F.xxhash64("place", F.element_at("places", F.col("place") + 1))).select(*columns), []
    for depth in range(1, join.depth + 1):
        sizes = nodes.groupBy("path").agg(F.count("*").alias("size")).where("size > 1")
        sized = nodes.join(sizes, "path")
        leaves.append(_edges_of(sized.where(F.col("size") <= join.bucket_rows).select(F.col("path").alias("bucket"), "rep", "sketch"), join))
        large = land(sized.where(F.col("size") > join.bucket_rows).select(*columns, "size"), "paths")
        if large.isEmpty():
            break
        last = depth == join.depth
        limit = join.bucket_rows * join.brute_blocks
        with small_batches(large.sparkSession, PACKED_ROWS):
            leaves.append(land(_packed_edges(large if last else large.where(F.col("size") <= limit), join), "packed-paths"))
        larger = large.where(F.col("size") > limit)
        if last or larger.isEmpty():
            break
        nodes = split(larger, widths[depth - 1], depth)
    return functools.reduce(DataFrame.unionByName, leaves)


def _edges_of(leaf: DataFrame, join: Join) -> DataFrame:
    """Stars of the buckets of a leaf, each in one task."""
    dealt = leaf.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInPandas(_bucket_edges(join.sketch_agreement), "a long, b long")


def _packed_edges(sized: DataFrame, join: Join) -> DataFrame:
    """Stars of buckets of any size: blocks of about `bucket_rows` rows, each packed into one row, and every pair of them.

    What is copied for the pairs are packed blocks, so a bucket of m rows makes
    (m / bucket_rows)^2 rows here, not m times its number of blocks.
    """
    blocks = F.ceil(F.col("size") / join.bucket_rows).cast("int")
    own = F.pmod(F.xxhash64("rep", "path"), F.col("blocks")).cast("int")
    packed = sized.withColumn("blocks", blocks).withColumn("own", own).groupBy("path", "own", "blocks")
    packed = packed.agg(F.collect_list(F.struct("rep", "sketch")).alias("block"))
    pairs = packed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = pairs.select("path", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "block")
    dealt = pairs.repartition("path", "p", "q").sortWithinPartitions("path", "p", "q")
    return dealt.mapInArrow(_block_edges(join.sketch_agreement), "a long, b long")


def _unpacked(block: pa.StructArray) -> tuple[np.ndarray, np.ndarray]:
    """The representatives of a packed block and their short sketches, by representative."""
    rep = np.asarray(block.field("rep"))
    marks = np.frombuffer(b"".join(block.field("sketch").to_pylist()), "<u2").reshape(-1, SKETCH)
    order = np.argsort(rep, kind="stable")
    return rep[order], marks[order]


def _block_edges(least: int):
    """Rows sorted by pair of blocks (one row for a block with itself, else two) -> stars (a, b) over rows whose sketches agree."""

    def stars(a: tuple, b: tuple | None) -> np.ndarray:
        if b is None:
            rep, links = a[0], _agree(a[1], a[1], least)
        else:
            rep, across = np.concatenate([a[0], b[0]]), _agree(a[1], b[1], least)
            links = np.zeros((len(rep), len(rep)), bool)
            links[: len(a[0]), len(a[0]) :] = across
            links |= links.T
        label = _labels(links)
        at = np.flatnonzero(label != np.arange(len(label)))
        return np.column_stack([rep[at], rep[label[at]]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # a block whose partner is missing is empty, or comes next
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True))
            ends, values, found = np.asarray(batch.column(3).offsets), batch.column(3).values, []
            for i, key in enumerate(keys):
                block = _unpacked(values.slice(ends[i], ends[i + 1] - ends[i]))
                if key[1] == key[2]:
                    found.append(stars(block, None))
                elif held is not None and held[0] == key:
                    found.append(stars(held[1], block))
                    held = None
                else:
                    held = (key, block)
            if found:
                a, b = np.concatenate(found).T
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return run


def _member_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    memo = word_hashes()
    for batch in batches:
        sets = [shingles(t, memo).tobytes() for t in batch["text"]]
        yield pd.DataFrame({"rep": batch["rep"], "grp": batch["grp"], "copies": batch["copies"], "elements": sets})


def exact_links(sets: list[np.ndarray], threshold: float, split: int | None = None) -> np.ndarray:
    """Symmetric matrix of the pairs with Jaccard similarity >= threshold; with `split` only pairs across it."""
    m = len(sets)
    lens = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(m), lens)
    flat = np.concatenate(sets) if m else np.zeros(0, np.uint64)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate([[True], flat[1:] != flat[:-1]]) if len(flat) else np.zeros(0, bool)
    column = np.cumsum(new) - 1
    shared = np.bincount(column) > 1 if len(flat) else np.zeros(0, bool)
    number = np.cumsum(shared) - 1
    take = shared[column]
    column, owner = number[column[take]], owner[take]
    common = np.zeros((m, m), np.float32)
    width = 4096
    for lo in range(0, int(number[-1]) + 1 if len(number) else 0, width):
        a, b = np.searchsorted(column, [lo, lo + width])
        part = np.zeros((m, width), np.float32)
        part[owner[a:b], column[a:b] - lo] = 1
        live = np.flatnonzero(part.any(1))
        sub = part[live]
        common[np.ix_(live, live)] += sub @ sub.T
    links = common.astype(np.float64) * (1 + threshold) >= threshold * (lens[:, None] + lens[None, :]) - 1e-9
    links &= (lens[:, None] > 0) & (lens[None, :] > 0)
    np.fill_diagonal(links, False)
    if split is not None:
        links[:split, :split] = False
        links[split:, split:] = False
    return links


def _exact(threshold: float):
    """Rows sorted by task (a pair of blocks of one group) -> rep, linked copies, smallest linked neighbour star."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_groups(batches, "task", least=500):
            task = rows["task"].to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], task[1:] != task[:-1]]))
            out = []
            for lo, hi in zip(starts, [*starts[1:], len(rows)], strict=True):
                part = rows.iloc[lo:hi].drop_duplicates("rep").sort_values(["own", "rep"])
                if len(part) < 2:
                    continue
                own, rep = part["own"].to_numpy(), part["rep"].to_numpy()
                across = int(np.searchsorted(own, own[-1])) if own[0] != own[-1] else None
                if across is None and part["alone"].iloc[0] != 1:
                    continue  # two blocks were asked for, and one of them is empty
                links = exact_links([np.frombuffer(e, np.uint64) for e in part["elements"]], threshold, across)
                linked = links @ part["copies"].to_numpy(np.int64)
                at = np.flatnonzero(links.any(1))
                order = np.argsort(rep, kind="stable")
                label = _labels(links[np.ix_(order, order)])
                star = np.empty_like(rep)
                star[order] = rep[order[label]]
                out.append(pd.DataFrame({"rep": rep[at], "linked": linked[at], "star": star[at]}))
            if out:
                yield pd.concat(out)

    return run


def classes(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """doc_id, t (hash of the text), doc, class_id (the smallest doc of the class), rep and n_links of every row of `docs`."""
    rows = numbered(docs)
    schema = "doc_id long, t long, doc long, n int, f1 long, f2 long, places array<int>, sketch binary"
    sketches = land(rows.select("doc_id", "doc", "text", F.xxhash64("text").alias("t")).mapInPandas(_sketches(join.splits[0]), schema), "sketches")
    full = sketches.where("n > 0")
    reps = full.groupBy("n", "f1", "f2").agg(F.count("*").alias("copies"), F.min("doc").alias("rep"))
    reps = land(reps, "copies")
    chosen = full.join(reps.select("rep"), full["doc"] == reps["rep"]).dropDuplicates(["rep"]).select("rep", "places", "sketch")
    chosen = land(chosen, "representatives")
    groups = components(candidate_edges(chosen, join), "paths-found")
    groups = groups.unionByName(groups.select(F.col("label").alias("node"), "label").distinct()).select(F.col("node").alias("rep"), F.col("label").alias("grp"))

    # The sets of each candidate group, cut into blocks; one task for every pair of blocks.
    members = land(reps.join(groups, "rep").select("rep", "grp", "copies", "n"), "groups")
    sizes = members.groupBy("grp").agg(F.count("*").alias("m"), F.sum("n").alias("elements"))
    blocks = F.greatest(F.ceil(F.col("m") / join.block_rows), F.ceil(F.col("elements") / join.block_elements)).cast("int")
    sizes = sizes.select("grp", F.when(F.col("m") == 2, 1).otherwise(blocks).alias("blocks"))
    # the members grow with the corpus: always a sort-merge join, never a broadcast
    texts = rows.select(F.col("doc").alias("rep"), "text").join(members.select("rep", "grp", "copies").hint("merge"), "rep")
    sets = texts.mapInPandas(_member_sets, "rep long, grp long, copies long, elements binary").join(sizes, "grp")
    sets = sets.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    sets = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sets = sets.withColumn("task", F.xxhash64("grp", F.least("own", "other"), F.greatest("own", "other")))
    sets = sets.select("task", "own", "rep", "copies", "elements", (F.col("own") == F.col("other")).cast("int").alias("alone"))
    judged = sets.repartition("task").sortWithinPartitions("task").mapInPandas(_exact(join.threshold), "rep long, linked long, star long")
    judged = land(judged, "links")

    label = components(judged.select(F.col("rep").alias("a"), F.col("star").alias("b")), "classes")
    linked = judged.groupBy("rep").agg(F.sum("linked").alias("linked"))
    result = reps.join(linked, "rep", "left").join(label.withColumnRenamed("node", "rep"), "rep", "left")
    result = result.select(
        "n", "f1", "f2", "rep", F.coalesce("label", "rep").alias("class_id"), (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")
    )
    found = sketches.select("doc_id", "t", "doc", "n", "f1", "f2").join(result, ["n", "f1", "f2"], "left")
    return found.select("doc_id", "t", "doc", F.coalesce("class_id", "doc").alias("class_id"), F.coalesce("rep", "doc").alias("rep"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def one_of_each(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """The rows of `docs` (all columns) that come first in their class, one row for each class."""
    found = land(classes(docs, join).where(F.col("doc") == F.col("class_id")).select("doc_id", "t", "doc"), "first-of-class")
    first = found.dropDuplicates(["doc"])
    same = F.expr("d.doc_id <=> f.doc_id AND xxhash64(d.text) = f.t")
    kept = docs.alias("d").join(first.alias("f").hint("merge"), same, "left_semi")
    if found.count() > first.count():  # rows with equal id and text: one of them
        kept = kept.dropDuplicates(["doc_id", "text"])
    return kept


def named(found: DataFrame) -> DataFrame:
    """The result of `classes` with the smallest doc_id of each class as its class_id.

    Where no id is null or repeated, it is that already. Classes of null ids alone get
    negative numbers, below the smallest id. Classes that share their smallest id (its
    rows have different texts) are told apart: all but the first get such numbers too.
    """
    found = land(found, "classes")
    if found.where("doc_id IS NULL OR doc <> doc_id").isEmpty():
        return found
    firsts = land(found.groupBy("class_id").agg(F.min("doc_id").alias("id")), "class-names")
    owners = firsts.where("id IS NOT NULL").groupBy("id").agg(F.min("class_id").alias("class_id"))
    below = F.lit(min(0, firsts.agg(F.min("id")).first()[0] or 0) - 1)
    others = firsts.join(owners, "class_id", "left_anti").select("class_id", (below - F.col("class_id")).alias("name"))
    names = owners.select("class_id", F.col("id").alias("name")).unionByName(others)
    columns = [F.col("name").alias("class_id") if c == "class_id" else F.col(c) for c in found.columns]
    return found.join(names, "class_id").select(*columns)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document."""
    return named(classes(table(spark, sf_dir, "documents"))).select("doc_id", "class_id", "n_links")
