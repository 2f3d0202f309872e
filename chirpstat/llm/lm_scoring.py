"""Operator 5: masked pseudo-likelihood by a bidirectional window network.

A small network, trained in numpy, predicts every word of a text from SIDE
words on either side: one embedding table per place, their sum through tanh,
and a softmax over classes in two levels (group, then member). The sum of the
log-probabilities of all words, each given both sides, scores the document.

Words (lower case, runs of characters other than white space) are counted
over the whole corpus. The VOCABULARY most frequent ones are classes of their
own, the others share BUCKETS classes by hash. The probability of a class is
split among its words by count (one count more stands for all unseen words):
the counts of all words are a table that grows with the corpus. Its most
frequent words, at most COMMON by a histogram of the counts, are sent to the
tasks as a sorted hash array; the other words of a text, few by the law that
frequencies fall with the rank, are joined to the table. Training passes once over all
documents, split by hash of the id into `rounds` parts: in a round every task
starts from the network of the round before, trains on its documents, and
returns its parameters; these are averaged by number of words, chunk by chunk,
in a stream (no task holds more than a few parameter sets). The network keeps
its size, however large the corpus is.

Defined results: a null text or one without a word has no words, log_prob 0 and
a null mean; beyond a text's ends stands a padding word; rows of one id are
scored one by one; in a corpus without words every log_prob is 0; only doc_id
and text are read. Scores may differ in the last digits between runs, as the
order in which parameters are summed is not fixed.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chirpstat.llm.common import land, table

GROUPS = MEMBERS = 32
CLASSES = GROUPS * MEMBERS
BUCKETS = 256
VOCABULARY = CLASSES - BUCKETS
PAD = CLASSES
SIDE = 2
HIDDEN = 24
CHUNKS = 16
#: Most words whose counts are sent to every task (16 bytes each).
COMMON = 1 << 18
#: Texts whose words are looked up at once.
SLICE = 2000
#: Logits up to this size are exponentiated as they are.
SAFE = 60.0


@dataclass(frozen=True)
class Training:
    rounds: int = 2
    batch: int = 8192
    rate: float = 0.12
    seed: int = 11


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def _bucket(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % BUCKETS


class Network:
    """Parameters in one flat vector: embeddings, bias, group and member softmax (their last rows are biases)."""

    SHAPES = (
        ("embed", (2 * SIDE, CLASSES + 1, HIDDEN)), ("bias", (HIDDEN,)),
        ("group", (HIDDEN + 1, GROUPS)), ("member", (GROUPS, HIDDEN + 1, MEMBERS)),
    )
    SIZE = sum(int(np.prod(shape)) for _, shape in SHAPES)

    def __init__(self, flat: np.ndarray):
        self.flat = flat
        at = 0
        for name, shape in self.SHAPES:
            n = int(np.prod(shape))
            setattr(self, name, flat[at : at + n].reshape(shape))
            at += n

    @classmethod
    def start(cls, counts: np.ndarray, seed: int) -> Network:
        """Small random weights; output biases at the corpus frequencies of the classes."""
        net = cls(np.random.default_rng(seed).normal(0, 0.05, cls.SIZE).astype(np.float32))
        smooth = (counts + 0.5).reshape(GROUPS, MEMBERS)
        net.group[-1] = np.log(smooth.sum(1) / smooth.sum())
        net.member[:, -1] = np.log(smooth / smooth.sum(1, keepdims=True))
        net.bias[:] = 0
        return net

    def hidden(self, context: np.ndarray) -> np.ndarray:
        """Hidden units of each context, and a last column of ones for the biases."""
        total = self.embed[0].take(context[:, 0], axis=0)
        for k in range(1, 2 * SIDE):
            total += self.embed[k].take(context[:, k], axis=0)
        total += self.bias
        out = np.ones((len(context), HIDDEN + 1), total.dtype)
        np.tanh(total, out=out[:, :HIDDEN])
        return out

    def _safe(self) -> tuple[bool, list[bool]]:
        """Whether no logit of the groups, and of the members of each group, can pass SAFE (no hidden unit passes 1)."""
        return bool(np.abs(self.group).sum(0).max() < SAFE), (np.abs(self.member).sum(1).max(1) < SAFE).tolist()

    def log_prob(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Log-probability of each target word given its context."""
        order, bounds = _by_group(target)
        safe, safe_members = self._safe()
        h = self.hidden(context[order])
        group, member = np.divmod(target[order], MEMBERS)
        rows = np.arange(len(h))
        logits = h @ self.group
        own = logits[rows, group]
        own -= _log_sums(logits, safe)
        for g, lo, hi in bounds:
            logits = h[lo:hi] @ self.member[g]
            own[lo:hi] += logits[rows[: hi - lo], member[lo:hi]]
            own[lo:hi] -= _log_sums(logits, safe_members[g])
        out = np.empty_like(own)
        out[order] = own
        return out

    def gradients(self, context: np.ndarray, target: np.ndarray) -> tuple[Network, list[np.ndarray]]:
        """Gradients of the mean negative log-probability, and for each place the words whose embedding has one."""
        n = len(target)
        order, bounds = _by_group(target)
        safe, safe_members = self._safe()
        context = context[order]
        group, member = np.divmod(target[order], MEMBERS)
        rows = np.arange(n)
        out = Network(np.zeros(self.SIZE, self.flat.dtype))
        h = self.hidden(context)
        wrong = _softmax(h @ self.group, safe)
        wrong[rows, group] -= 1
        back = wrong @ self.group.T
        out.group[:] = h.T @ wrong
        for g, lo, hi in bounds:
            wrong = _softmax(h[lo:hi] @ self.member[g], safe_members[g])
            wrong[rows[: hi - lo], member[lo:hi]] -= 1
            back[lo:hi] += wrong @ self.member[g].T
            out.member[g] = h[lo:hi].T @ wrong
        h *= h
        back = back[:, :HIDDEN] * (1 - h[:, :HIDDEN])
        out.bias[:] = back.sum(0)
        met = []
        for k in range(2 * SIDE):
            order = np.argsort(context[:, k], kind="stable")
            words = context[order, k]
            starts = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
            met.append(words[starts])
            out.embed[k, met[k]] = np.add.reduceat(back.take(order, axis=0), starts, axis=0)
        out.flat /= n
        return out, met

    def train(self, context: np.ndarray, target: np.ndarray, squares: Network, rate: float) -> None:
        """One step of gradient descent with per-parameter rates (`squares` sums squared gradients)."""
        gradients, met = self.gradients(context, target)

        def step(name: str, at=...) -> None:
            gradient, s, p = (getattr(x, name)[at] for x in (gradients, squares, self))
            s = s + gradient * gradient
            getattr(squares, name)[at] = s
            getattr(self, name)[at] = p - rate * gradient / (np.sqrt(s) + 1e-3)

        for name in ("bias", "group", "member"):
            step(name)
        for k, words in enumerate(met):
            step("embed", (k, words))


def _by_group(target: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order of the targets by group, and (group, begin, end) of the groups met."""
    order = np.argsort(target, kind="stable")
    ends = np.searchsorted(target[order], np.arange(GROUPS + 1) * MEMBERS).tolist()
    return order, [(g, lo, hi) for g, (lo, hi) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if hi > lo]


def _exp(logits: np.ndarray, safe: bool) -> tuple[np.ndarray, np.ndarray | float]:
    """Exponentiates in place, less each row's maximum unless that is safe; the rows' sums, and what was taken off."""
    off = 0.0
    if not safe:
        most = logits.max(1, keepdims=True)
        logits -= most
        off = most[:, 0]
    np.exp(logits, out=logits)
    return logits @ np.ones(logits.shape[1], logits.dtype), off


def _softmax(logits: np.ndarray, safe: bool) -> np.ndarray:
    sums, _ = _exp(logits, safe)
    logits *= (1 / sums)[:, None]
    return logits


def _log_sums(logits: np.ndarray, safe: bool) -> np.ndarray:
    """Logarithm of each row's sum of exponentials; overwrites the logits."""
    sums, off = _exp(logits, safe)
    return np.log(sums) + off


def _distinct(texts) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Words of some texts: place of every word among the distinct ones, these, and the texts' numbers of words."""
    words = [words_of(t) for t in texts]
    lens = np.fromiter(map(len, words), np.int64, len(words))
    coded = pa.array(chain.from_iterable(words), pa.string(), size=int(lens.sum())).dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist(), lens


def _classes(distinct: list[str], vocabulary: dict[str, int]) -> np.ndarray:
    found = (vocabulary[w] if w in vocabulary else VOCABULARY + _bucket(w) for w in distinct)
    return np.fromiter(found, np.int16, len(distinct))


def windows(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts (2 * SIDE words), targets and lengths of all words of some texts of classes (16 bits: they sort fast)."""
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    target = np.concatenate([np.zeros(0, np.int16), *texts], dtype=np.int16, casting="same_kind")
    at = np.arange(len(target)) + np.repeat(np.arange(1, len(lens) + 1) * SIDE, lens)
    flat = np.full(len(target) + (len(lens) + 1) * SIDE, PAD, np.int16)
    flat[at] = target
    return np.column_stack([flat[at + s] for s in (*range(-SIDE, 0), *range(1, SIDE + 1))]), target, lens


def _slices(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    for lo in range(0, len(batch), SLICE):
        yield batch.iloc[lo : lo + SLICE]


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts: Counter = Counter()
        for text in batch["text"]:
            counts.update(words_of(text))
        yield pd.DataFrame({"word": list(counts), "n": list(counts.values())}).astype({"word": object, "n": "int64"})


def _bucket_of(word: str):
    return F.crc32(F.encode(word, "UTF-8")) % BUCKETS


def count_words(docs: DataFrame) -> DataFrame:
    """word, n (its count in the corpus) and bucket of every word."""
    counted = docs.select(F.col("text").cast("string").alias("text")).mapInPandas(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return land(counted.withColumn("bucket", _bucket_of("word")), "word-counts")


def count_classes(docs: DataFrame, counted: DataFrame | None = None) -> tuple[dict[str, int], np.ndarray]:
    """The vocabulary (word -> class) and the corpus count of every class. `counted`: from count_words."""
    counted = count_words(docs) if counted is None else counted
    top = [(r["word"], r["n"], r["bucket"]) for r in counted.orderBy(F.desc("n"), "word").limit(VOCABULARY).collect()]
    buckets = {r["bucket"]: r["n"] for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}
    counts = np.zeros(CLASSES)
    for bucket, n in buckets.items():
        counts[VOCABULARY + bucket] = n
    for k, (_, n, bucket) in enumerate(top):
        counts[k] = n
        counts[VOCABULARY + bucket] -= n
    return {w: k for k, (w, _, _) in enumerate(top)}, counts


def _bin(n):
    """Sixteen bins for every doubling of a count."""
    return F.floor(16 * F.log2(n)).cast("int")


@dataclass(frozen=True)
class Shares:
    """What the words outside the vocabulary are of their classes: the common ones here, counts of the others in `rest`."""

    hashes: np.ndarray  # sorted
    counts: np.ndarray
    totals: np.ndarray  # count of every bucket
    rest: DataFrame

    @classmethod
    def of(cls, counted: DataFrame, vocabulary: dict[str, int], common: int = COMMON) -> Shares:
        """At most `common` words are sent: those of the highest bins of counts that together hold no more."""
        others = counted.where(~F.col("word").isin(list(vocabulary)))
        totals = np.zeros(BUCKETS)
        for r in others.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
            totals[r["bucket"]] = r["n"]
        least, held = 1 << 20, 0
        for r in others.groupBy(_bin("n").alias("bin")).agg(F.count("*").alias("words")).orderBy(F.desc("bin")).collect():
            held += r["words"]
            if held > common:
                break
            least = r["bin"]
        often = others.where(_bin("n") >= least).select(F.xxhash64("word").alias("hash"), "n").toArrow()
        hashes, counts = (often.column(c).to_numpy().astype(np.int64) for c in ("hash", "n"))
        order = np.argsort(hashes)
        # a word counted once has the share of an unseen one, so it needs no row
        return cls(hashes[order], counts[order], totals, others.where((_bin("n") < least) & (F.col("n") > 1)).select("word", "n"))


def _logs(distinct: list[str], classes: np.ndarray, hashes: np.ndarray, counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Logarithm of each distinct word's share of its class, null where the word is not among the common ones."""
    out = np.zeros(len(distinct))
    own = np.flatnonzero(classes >= VOCABULARY)
    keys = (xxhash.xxh64_intdigest(distinct[i].encode(), 42) for i in own.tolist())  # as Spark's xxhash64
    keys = np.fromiter(keys, np.uint64, len(own)).view(np.int64)
    at = np.minimum(np.searchsorted(hashes, keys), max(len(hashes) - 1, 0))
    n = np.full(len(own), np.nan)
    if len(hashes):
        n = np.where(hashes[at] == keys, counts[at], n)
    out[own] = np.log(n / (totals[classes[own] - VOCABULARY] + 1))
    return out


CODED = "doc_id long, n_words long, share double, rest array<string>, body binary"


def encode(docs: DataFrame, vocabulary: dict[str, int], shares: Shares | None = None) -> DataFrame:
    """Every document's classes (body, 16 bits a word), landed once for training and scoring.

    share: what its words outside the vocabulary add to its log-probability, but
    for those in `rest`; without `shares` words have all of their class.
    """
    arrays = None if shares is None else (shares.hashes, shares.counts, shares.totals)
    sent = docs.sparkSession.sparkContext.broadcast((vocabulary, arrays))  # at most COMMON words

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, arrays = sent.value
        for batch in batches:
            for part in _slices(batch):
                coded, distinct, lens = _distinct(part["text"])
                classes = _classes(distinct, known)
                ends = np.cumsum(lens)
                starts = ends - lens
                share, rest = np.zeros(len(part)), [()] * len(part)
                if arrays is not None:
                    logs = _logs(distinct, classes, *arrays)[coded]
                    left = np.flatnonzero(np.isnan(logs))
                    sums = np.concatenate([[0.0], np.cumsum(np.nan_to_num(logs, copy=False))])
                    share = sums[ends] - sums[starts]
                    cuts = np.searchsorted(left, np.concatenate([[0], ends])).tolist()
                    words = [distinct[i] for i in coded[left].tolist()]
                    rest = [words[lo:hi] for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]
                target = classes[coded]
                body = [target[lo:hi].tobytes() for lo, hi in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pd.DataFrame({"doc_id": part["doc_id"].astype("Int64").array, "n_words": lens, "share": share, "rest": rest, "body": body})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return land(rows.mapInPandas(run, CODED).withColumn("row", F.monotonically_increasing_id()), "word-classes")


def _trainer(sent, training: Training, round_: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        net, squares = Network(sent.value.copy()), Network(np.zeros(Network.SIZE, np.float32))
        seen = 0
        for batch in batches:
            for lo in range(0, len(batch), 500):
                context, target, _ = windows([np.frombuffer(b, np.int16) for b in batch["body"].iloc[lo : lo + 500]])
                steps = -(-len(target) // training.batch)
                for at in range(steps):  # every step takes words from all of these texts
                    net.train(context[at::steps], target[at::steps], squares, training.rate / (1 + round_))
                seen += len(target)
        if seen:
            parts = np.array_split(net.flat, CHUNKS)
            yield pd.DataFrame({"chunk": range(CHUNKS), "weight": float(seen), "body": [p.tobytes() for p in parts]})

    return run


def _average(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(chunk, weight, body) rows in a stream -> one weighted mean for each chunk."""
    sums: dict[int, np.ndarray] = {}
    weights: dict[int, float] = {}
    for batch in batches:
        for chunk, weight, body in zip(batch["chunk"].tolist(), batch["weight"].tolist(), batch["body"], strict=True):
            part = np.frombuffer(body, np.float32) * weight
            sums[chunk] = sums[chunk] + part if chunk in sums else part.astype(np.float64)
            weights[chunk] = weights.get(chunk, 0.0) + weight
    if sums:
        yield pd.DataFrame({"chunk": list(sums), "body": [(sums[c] / weights[c]).astype(np.float32).tobytes() for c in sums]})


def train(coded: DataFrame, counts: np.ndarray, training: Training = Training()) -> np.ndarray:
    """Parameters of a network trained on all encoded documents; `counts`: of the classes."""
    flat = Network.start(counts, training.seed).flat
    part = F.pmod(F.xxhash64("doc_id", "body"), F.lit(training.rounds))
    for round_ in range(training.rounds):
        sent = coded.sparkSession.sparkContext.broadcast(flat)  # of fixed size
        trained = coded.where(part == round_).select("body").mapInPandas(_trainer(sent, training, round_), "chunk int, weight double, body binary")
        means = trained.repartition(CHUNKS, "chunk").mapInPandas(_average, "chunk int, body binary").collect()
        if means:
            flat = np.concatenate([np.frombuffer(r["body"], np.float32) for r in sorted(means, key=lambda r: r["chunk"])])
    return flat


def score(coded: DataFrame, flat: np.ndarray, shares: Shares | None = None) -> DataFrame:
    """doc_id, n_words, log_prob and mean_log_prob of encoded documents; `shares`: those they were encoded with."""
    sent = coded.sparkSession.sparkContext.broadcast(flat)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        net = Network(sent.value)
        for batch in batches:
            for lo in range(0, len(batch), 500):
                part = batch.iloc[lo : lo + 500]
                context, target, lens = windows([np.frombuffer(b, np.int16) for b in part["body"]])
                probs = [net.log_prob(context[a : a + 16_384], target[a : a + 16_384]) for a in range(0, len(target), 16_384)]
                sums = np.concatenate([[0.0], np.cumsum(np.concatenate([np.zeros(0), *probs]))])
                ends = np.cumsum(lens)
                yield pd.DataFrame({"row": part["row"], "doc_id": part["doc_id"].astype("Int64").array, "n_words": lens, "log_prob": sums[ends] - sums[ends - lens] + part["share"].to_numpy()})

    scored = coded.select("row", "doc_id", "n_words", "share", "body").mapInPandas(run, "row long, doc_id long, n_words long, log_prob double")
    if shares is not None:
        own = coded.select("row", F.explode("rest").alias("word")).join(shares.rest, "word", "left")
        total = F.element_at(F.lit(shares.totals.tolist()), (_bucket_of("word") + 1).cast("int"))
        sums = own.groupBy("row").agg(F.sum(F.log(F.coalesce("n", F.lit(1)) / (total + 1))).alias("rest"))
        scored = scored.join(sums, "row", "left").withColumn("log_prob", F.col("log_prob") + F.coalesce("rest", F.lit(0.0)))
    return scored.select("doc_id", "n_words", "log_prob", F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words")).alias("mean_log_prob"))


def learn(docs: DataFrame, training: Training = Training(), counted: DataFrame | None = None) -> tuple[dict[str, int], np.ndarray]:
    """Vocabulary and parameters of a network trained on all of `docs` (doc_id, text). `counted`: from count_words."""
    vocabulary, counts = count_classes(docs, counted)
    return vocabulary, train(encode(docs, vocabulary), counts, training)


def score_documents(docs: DataFrame, vocabulary: dict[str, int], flat: np.ndarray, counted: DataFrame | None = None, common: int = COMMON) -> DataFrame:
    """doc_id, n_words, log_prob (of all words, each given both sides) and mean_log_prob.

    With `counted` (from count_words, of the documents learned from) words
    outside the vocabulary have their share of their class's probability;
    without, they have all of it.
    """
    shares = None if counted is None else Shares.of(counted, vocabulary, common)
    return score(encode(docs, vocabulary, shares), flat, shares)


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-log-likelihood of every document under a network trained on the whole table."""
    docs = table(spark, sf_dir, "documents")
    counted = count_words(docs)
    vocabulary, counts = count_classes(docs, counted)
    shares = Shares.of(counted, vocabulary)
    coded = encode(docs, vocabulary, shares)
    return score(coded, train(coded, counts), shares)
