"""Operator 3: benchmark decontamination by embedded edit distance.

Documents and benchmark items are sequences of words (lower-case runs of
letters and digits). A passage leaks an item of n words if it can be edited
into it with at most `share` * n insertions, deletions and replacements of
words. Candidates are found among the windows of n words:

* CGK embedding: a random walk reads a sequence word by word and, at each step,
  stays or moves on by a random bit of (step, word). Two sequences at a small
  edit distance give walks that soon read the same words at the same steps, so
  edit distance becomes Hamming distance.
* Bit-sampling LSH: a key is made of the words read at a few sampled steps;
  windows and items with an equal key are candidates. Walks and keys are added
  until edited copies of the items themselves are found with the target recall.
* Candidates are verified exactly: the smallest edit distance of the item to
  any stretch of the text around the window.

A window within reach of an item has at most `share` * n words that no item of
n words holds, and misses at most as many of the item's rarer words. Windows
that fail this for all items of their length need no walk; that loses nothing.
Item lengths at which the walks miss edited copies, and lengths of over
`keyed_words` words, are searched without keys: every window left is verified
against every item of its length.

The benchmark is the stated query set: it is sent to the tasks in blocks of at
most `BLOCK_ITEMS` items, each of which meets every document. Defined results:
null and empty texts have no windows; items of under `MIN_WORDS` words (or
null) are not searched; a passage over the end of a text counts its missing
words as edits; equal items, and rows of one id, are reported each; a passage
is reported once at its best place, separate passages of one item apart.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chirpstat.llm.common import Lookup, mix64, table

MIN_WORDS = 5
BLOCK_ITEMS = 20_000
#: Words of consecutive documents that a task searches at once.
PIECE_WORDS = 1_000_000
_WORD = re.compile(r"[^\W_]+")
_STEP = np.array([0x9E3779B97F4A7C15], np.uint64)


@dataclass(frozen=True)
class Search:
    share: float = 0.15
    recall: float = 0.99
    #: words in a key, and keys drawn from each walk
    key_words: int = 3
    keys_per_walk: int = 6
    max_walks: int = 24
    trials: int = 400
    #: items of more words get no walks, whose cost grows with the square of their length
    keyed_words: int = 400


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def edits_allowed(n: int, share: float) -> int:
    return int(share * n + 1e-9)


def coins(words: int, steps: int, seed: int) -> np.ndarray:
    """Random bits for every word (the last row: for -1) and step, 64 steps to a number."""
    blocks = -(-steps // 64)
    cell = np.arange((words + 1) * blocks, dtype=np.uint64) + np.uint64(seed + 1) * np.uint64(1 << 40)
    return mix64(cell * _STEP).reshape(words + 1, blocks)


def walk(text: np.ndarray, starts: np.ndarray, n: int, steps: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Words read at the given (ascending) steps by the CGK walks over windows text[start : start + n]; -1 past the end."""
    at, ends = starts.copy(), starts + n
    out = np.full((len(starts), len(steps)), -1, np.int64)
    wanted = {int(s): k for k, s in enumerate(steps)}
    lo = int(starts.min()) if len(starts) else 0  # only the stretch that is read
    past = int(starts.max()) + n - lo if len(starts) else 0
    text = np.append(text[lo : lo + past], -1)
    at, ends = at - lo, ends - lo
    for step in range(int(steps[-1]) + 1):
        word = text[at]
        if step in wanted:
            out[:, wanted[step]] = word
        at += (bits[word, step // 64] >> np.uint64(step % 64) & np.uint64(1)).astype(np.int64)
        at[at >= ends] = past
        np.minimum(at, past, out=at)
    return out


class Index:
    """Keys of one block of items, by item length."""

    def __init__(self, items: list[tuple[int, list[str]]], search: Search):
        self.search = search
        items = [(i, w) for i, w in items if len(w) >= MIN_WORDS]
        self.vocabulary = {w: k for k, w in enumerate(sorted({w for _, own in items for w in own}))}
        self.items = [(i, np.array([self.vocabulary[w] for w in own], np.int64)) for i, own in items]
        self.lengths = sorted({len(w) for _, w in self.items})
        #: lengths searched without keys
        self.exact = {n for n in self.lengths if n > search.keyed_words}
        self.keyed = [n for n in self.lengths if n <= search.keyed_words]
        self.by_length = {n: [k for k, (_, w) in enumerate(self.items) if len(w) == n] for n in self.lengths}
        self.keys: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {n: [] for n in self.lengths}
        self.plans: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {n: [] for n in self.lengths}
        self.flags = {n: self._flags(n) for n in self.lengths}
        self.coins: list[np.ndarray] = []
        self.walks, self.measured_recall = 0, 1.0
        trials = self._trials() if self.keyed else []
        missed = trials
        while self.keyed and self.walks < search.max_walks and (self.walks == 0 or self.measured_recall < search.recall):
            self._add_walk()
            missed = self._missed(missed)
            self.measured_recall = 1 - len(missed) / len(trials)
        if self.measured_recall < search.recall:
            self.exact |= {len(self.items[item][1]) for item, _ in missed}

    def _flags(self, n: int) -> tuple[np.ndarray, np.ndarray, int]:
        """For items of n words: which words they hold, which of these few items hold, and how many of the latter a window needs.

        The last entry stands for words that no item holds (-1).
        """
        counts = np.zeros(len(self.vocabulary) + 1, np.int64)
        for _, w in self.items:
            counts[np.unique(w)] += 1
        held = np.zeros(len(counts), np.uint8)
        for k in self.by_length[n]:
            held[self.items[k][1]] = 1
        rare = held * (counts <= max(3, len(self.items) // 50)).astype(np.uint8)
        least = min(int(rare[self.items[k][1]].sum()) for k in self.by_length[n]) - edits_allowed(n, self.search.share)
        return held, rare, least

    def _coins(self, seed: int) -> np.ndarray:
        while len(self.coins) <= seed:
            self.coins.append(coins(len(self.vocabulary), 2 * self.keyed[-1], len(self.coins)))
        return self.coins[seed]

    def _add_walk(self) -> None:
        s = self.search
        for n in self.keyed:
            own = self.by_length[n]
            draw = np.random.default_rng([n, self.walks])
            picks = np.stack([np.sort(draw.choice(2 * n, min(s.key_words, 2 * n), replace=False)) for _ in range(s.keys_per_walk)])
            steps = np.unique(picks)
            columns = np.searchsorted(steps, picks)
            self.plans[n].append((steps, columns))
            text = np.concatenate([self.items[k][1] for k in own])
            keys = _keys(walk(text, np.arange(len(own)) * n, n, steps, self._coins(self.walks)), columns)
            for k in range(s.keys_per_walk):
                order = np.argsort(keys[:, k], kind="stable")
                self.keys[n].append((keys[order, k], np.array(own)[order]))
        self.walks += 1

    def _trials(self) -> list[tuple[int, np.ndarray]]:
        """Items and edited copies of them, with as many edits as are allowed."""
        draw = np.random.default_rng(7)
        own = [k for k, (_, w) in enumerate(self.items) if len(w) <= self.search.keyed_words]
        out = []
        for _ in range(self.search.trials):
            item = own[int(draw.integers(len(own)))]
            pattern = self.items[item][1]
            most = edits_allowed(len(pattern), self.search.share)
            out.append((item, np.concatenate([np.full(most, -1), edited(pattern, most, draw), np.full(most, -1)])))
        return out

    def _missed(self, trials: list[tuple[int, np.ndarray]]) -> list[tuple[int, np.ndarray]]:
        """The trials of which no window has a key of the item in the last walk."""
        by_length: dict[int, list[tuple[int, np.ndarray]]] = {}
        for item, text in trials:
            by_length.setdefault(len(self.items[item][1]), []).append((item, text))
        out = []
        for n, own in by_length.items():
            counts = np.array([max(0, len(text) - n + 1) for _, text in own])
            begins = np.cumsum([0] + [len(text) for _, text in own])[:-1]
            trial = np.repeat(np.arange(len(own)), counts)
            starts = begins[trial] + np.arange(len(trial)) - np.repeat(np.cumsum(counts) - counts, counts)
            steps, columns = self.plans[n][-1]
            keys = _keys(walk(np.concatenate([text for _, text in own]), starts, n, steps, self._coins(self.walks - 1)), columns)
            met = np.zeros(len(own), bool)
            for k in range(keys.shape[1]):
                have, which = self.keys[n][len(self.keys[n]) - keys.shape[1] + k]
                for t, (item, _) in enumerate(own):
                    met[t] = met[t] or np.isin(keys[trial == t, k], have[which == item]).any()
            out += [x for x, m in zip(own, met, strict=True) if not m]
        return out

    def candidates(self, text: np.ndarray) -> dict[int, set[int]]:
        """item number -> starts of windows with an equal key."""
        found: dict[int, set[int]] = {}
        for n in self.lengths:
            if len(text) < n:
                continue
            held, rare, least = self.flags[n]
            at = _stretches(np.flatnonzero(rare[text]), least, n, len(text))
            if not len(at):
                continue
            # the stretches end to end; windows begin at all but the last n - 1 words of each
            lens = at[:, 1] - at[:, 0]
            ends = np.cumsum(lens)
            place = np.arange(ends[-1]) + np.repeat(at[:, 0] - (ends - lens), lens)
            near = text[place]
            known = np.cumsum(np.concatenate([[0], held[near]]), dtype=np.int64)
            fit = known[n:] - known[:-n] >= n - edits_allowed(n, self.search.share)
            for end in ends[:-1].tolist():
                fit[max(0, end - n + 1) : end] = False
            starts = np.flatnonzero(fit)
            for lo in range(0, len(starts), 50_000):
                self._look_up(near, starts[lo : lo + 50_000], place, n, found)
        return found

    def _look_up(self, text: np.ndarray, starts: np.ndarray, place: np.ndarray, n: int, found: dict[int, set[int]]) -> None:
        if n in self.exact:
            for item in self.by_length[n]:
                found.setdefault(item, set()).update(place[starts].tolist())
            return
        for seed, (steps, columns) in enumerate(self.plans[n]):
            keys = _keys(walk(text, starts, n, steps, self._coins(seed)), columns)
            for k in range(keys.shape[1]):
                have, which = self.keys[n][seed * self.search.keys_per_walk + k]
                lo, hi = np.searchsorted(have, keys[:, k]), np.searchsorted(have, keys[:, k], "right")
                for w in np.flatnonzero(hi > lo):
                    for item in which[lo[w] : hi[w]].tolist():
                        found.setdefault(item, set()).add(int(place[starts[w]]))

    def find(self, texts: list[np.ndarray]) -> list[tuple[int, int, int, int, int]]:
        """(text number, item number, begin, words, edits) of every leaked passage.

        Texts are vocabulary numbers, -1 for other words. They are searched end
        to end, with gaps of more words than a window may have that no item holds.
        """
        if not self.lengths:
            return []
        gap = np.full(edits_allowed(self.lengths[-1], self.search.share) + 1, -1, np.int64)
        text = np.concatenate([gap, *[x for t in texts for x in (t, gap)]])
        lens = np.fromiter(map(len, texts), np.int64, len(texts))
        begins = len(gap) + np.concatenate([[0], np.cumsum(lens + len(gap))[:-1]])
        out = []
        for item, starts in sorted(self.candidates(text).items()):
            pattern = self.items[item][1]
            n, most = len(pattern), edits_allowed(len(pattern), self.search.share)
            near = np.array(sorted(starts))
            for some in np.split(near, np.flatnonzero(np.diff(near) > n // 2) + 1):
                own = int(np.searchsorted(begins, some[0] + n // 2, "right")) - 1
                if own >= 0:
                    lo, hi = max(int(begins[own]), int(some[0]) - most), min(int(begins[own] + lens[own]), int(some[-1]) + n + most)
                    for begin, end, edits in matches(pattern, text[lo:hi], most):
                        out.append((own, item, lo + begin - int(begins[own]), end - begin, edits))
        return out


def _stretches(at: np.ndarray, least: int, n: int, words: int) -> np.ndarray:
    """(begin, end) of the stretches of a text that windows of n words with at least `least` of the places `at` cover."""
    if least <= 0:
        return np.array([[0, words]])
    first, last = at[: max(0, len(at) - least + 1)], at[least - 1 :]
    close = last - first < n
    begin, end = np.maximum(last[close] - n + 1, 0), np.minimum(first[close] + n, words)
    if not len(begin):
        return np.zeros((0, 2), np.int64)
    new = np.flatnonzero(begin[1:] > end[:-1])  # both ascend
    out = np.stack([begin[np.append(0, new + 1)], end[np.append(new, len(end) - 1)]], axis=1)
    return out[out[:, 1] - out[:, 0] >= n]


def _keys(read: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """One hash for each row and each sample of read words."""
    out = np.zeros((len(read), len(columns)), np.uint64)
    for k, picks in enumerate(columns):
        for c in picks:
            out[:, k] = mix64(out[:, k] * _STEP + (read[:, c] + 2).astype(np.uint64))
    return out


def edited(pattern: np.ndarray, edits: int, draw: np.random.Generator) -> np.ndarray:
    """A copy of a word sequence with random edits."""
    copy = pattern.tolist()
    for _ in range(edits):
        at, kind = int(draw.integers(len(copy))), int(draw.integers(3))
        if kind == 0:
            copy[at] = -1
        elif kind == 1:
            copy.insert(at, -1)
        elif len(copy) > 1:
            del copy[at]
    return np.array(copy, np.int64)


def best_match(pattern: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(begin, end, edits) of the stretch of text at the smallest edit distance to pattern (the first, then shortest)."""
    m = len(text)
    index = np.arange(m + 1)
    cost, begin = np.zeros(m + 1, np.int64), index.copy()
    scale = m + 2  # cost and begin in one number: among equal costs the latest begin, so the shortest stretch
    state = cost * scale + (m - begin)
    for k, word in enumerate(pattern):
        up = state + scale
        through = np.concatenate([[(k + 1) * scale + m], state[:-1] + np.where(text == word, 0, scale)])
        state = np.minimum(up, through)
        state = np.minimum.accumulate(state - index * scale) + index * scale
    end = int((state // scale).argmin())
    return int(m - state[end] % scale), end, int(state[end] // scale)


def matches(pattern: np.ndarray, text: np.ndarray, most: int) -> list[tuple[int, int, int]]:
    """Separate stretches of text within `most` edits of pattern, the best first and then beside it."""
    out, todo = [], [(0, len(text))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo < max(1, len(pattern) - most):
            continue
        begin, end, edits = best_match(pattern, text[lo:hi])
        if edits <= most:
            out.append((lo + begin, lo + end, edits))
            todo += [(lo, lo + begin), (lo + end, hi)]
    return out


FOUND = "array<struct<item_id: long, begin: int, n_words: int, edits: int>>"


def leaks(spark: SparkSession, benchmark: DataFrame, search: Search = Search(), block_items: int = BLOCK_ITEMS) -> list[Callable[[Column], Column]]:
    """Column functions, one for each block of items: text -> the passages that leak an item of the block."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull())
    blocks = max(1, -(-items.count() // block_items))
    slot = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    out = []
    for block in range(blocks):
        own = sorted((r["item_id"] is None, r["item_id"] or 0, r["text"]) for r in items.where(slot == block).collect())
        index = Index([(None if null else i, words_of(t)) for null, i, t in own], search)
        out.append(_searcher(spark.sparkContext.broadcast(index)))
    return out


def _searcher(sent) -> Callable[[Column], Column]:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index: Index = sent.value
        numbers = Lookup(lambda w: index.vocabulary.get(w, -1))
        for batch in batches:
            found: list[list[dict]] = [[] for _ in range(len(batch))]
            texts: list[np.ndarray] = []
            first = held = 0
            for at, text in enumerate(batch):
                words = words_of(text)
                texts.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
                held += len(words)
                if held >= PIECE_WORDS or at == len(batch) - 1:
                    for t, k, begin, n, edits in index.find(texts):
                        found[first + t].append({"item_id": index.items[k][0], "begin": begin, "n_words": n, "edits": edits})
                    texts, first, held = [], at + 1, 0
            yield pd.Series(found, dtype=object)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, FOUND).asNondeterministic()


def find_leaks(docs: DataFrame, benchmark: DataFrame, search: Search = Search(), block_items: int = BLOCK_ITEMS) -> DataFrame:
    """doc_id, item_id, begin (word), n_words and edits of every passage of `docs` that leaks an item."""
    found = None
    for leaked in leaks(docs.sparkSession, benchmark, search, block_items):
        part = docs.select("doc_id", leaked(F.col("text")).alias("found")).select("doc_id", F.inline("found"))
        found = part if found is None else found.unionByName(part)
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame, search: Search = Search(), block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The rows of `docs` (all columns) that leak no item."""
    for leaked in leaks(docs.sparkSession, benchmark, search, block_items):
        docs = docs.where(F.size(leaked(F.col("text"))) == 0)
    return docs


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of the documents that leaks a benchmark item."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
