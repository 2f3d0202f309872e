"""Operator 2: language identification by character language models.

For each language an interpolated Kneser-Ney model of order 5 is learned over
the letters of words (lower case, each word on its own with blanks around it).
The models of all languages lie side by side in sorted hash arrays, one pair
per order: the hashes of the n-grams with their discounted shares, and the
hashes of the contexts with their back-off weights. A text gets the language of
lowest cross-entropy per character; a logistic curve over the margin to the
second best, fitted on rows that the models have not seen, gives its score.
A text is rejected if its score is low or its cross-entropy far above what the
calibration rows of that language show.

N-grams are counted by Spark over a bounded sample of the learning rows
(`rows_per_language`, drawn by a hash of the id; whole texts). Defined results:
a null text or one without a letter is `und` with score 0; ties go to the
language that sorts first; letters beyond `MAX_WORD` in a word start a new
word; an empty table gives an empty result; only doc_id, text and lang are
read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chirpstat.llm.common import MEMO_ENTRIES, id_remainder, mix64, table, utf8_rows
from chirpstat.llm.quality_zstd import fit_logistic

ORDER = 5
MAX_WORD = 40
UNKNOWN = "und"
ROWS_PER_LANGUAGE = 1200
_LETTERS = re.compile(r"[^\W\d_]+")
_BLANK = 32
_BASE = np.uint64(0x9E3779B97F4A7C15)


def letter_words(text: str | None) -> list[str]:
    """Lower-case runs of letters, cut to MAX_WORD letters."""
    words = _LETTERS.findall((text or "").lower())
    if any(len(w) > MAX_WORD for w in words):
        words = [w[i : i + MAX_WORD] for w in words for i in range(0, len(w), MAX_WORD)]
    return words


def gram_hashes(words: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """For n = 0..ORDER the hashes of the n characters up to each position; word index of each position.

    Positions are the letters of a word and the blank after it. hashes[n] covers
    the last n characters; the context of an n-gram is hashed the same way, one
    position earlier, so contexts are returned too (hashes[ORDER + 1 + n]).
    """
    codes, lens = utf8_rows(words, MAX_WORD)
    width = MAX_WORD + 1 + ORDER
    padded = np.full((len(words), width), _BLANK, np.uint64)
    padded[:, ORDER : ORDER + MAX_WORD] = codes
    ends = np.arange(MAX_WORD + 1)[None, :] == lens[:, None]
    padded[:, ORDER:][ends] = _BLANK
    live = np.arange(MAX_WORD + 1)[None, :] <= lens[:, None]
    out = []
    for shift in (0, 1):  # n-grams, then contexts
        value = np.zeros((len(words), MAX_WORD + 1), np.uint64)
        power = np.ones(1, np.uint64)  # an array: it may wrap around
        hashes = [np.zeros(int(live.sum()), np.uint64)]
        for n in range(1, ORDER + 1):
            at = ORDER - shift - n + 1
            value = value + padded[:, at : at + MAX_WORD + 1] * power
            power = power * _BASE
            hashes.append(mix64(value[live] + np.uint64(n)))
        out += hashes
    return out, np.repeat(np.arange(len(words)), lens + 1)


@dataclass
class Model:
    """Sorted hash arrays per order n (index n - 1) with one column per language, and the calibration."""

    languages: list[str]
    grams: list[np.ndarray]
    shares: list[np.ndarray]
    contexts: list[np.ndarray]
    backoffs: list[np.ndarray]
    floor: np.ndarray
    slope: float = 4.0
    offset: float = 0.0
    worst: np.ndarray | None = None

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log-probability of each word (and its closing blank) under each language."""
        out = np.zeros((len(words), len(self.languages)))
        for lo in range(0, len(words), 20_000):
            part = words[lo : lo + 20_000]
            hashes, word = gram_hashes(part)
            p = np.tile(self.floor, (len(word), 1))
            for n in range(1, ORDER + 1):
                share = _rows(self.grams[n - 1], self.shares[n - 1], hashes[n], 0.0)
                backoff = _rows(self.contexts[n - 1], self.backoffs[n - 1], hashes[ORDER + n], 1.0)
                p = share + backoff * p
            np.log(p, out=p)
            starts = np.concatenate([[0], np.flatnonzero(np.diff(word)) + 1])
            out[lo : lo + len(part)] = np.add.reduceat(p, starts, axis=0)
        return out


def _rows(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> np.ndarray:
    """The value rows of `wanted` in the sorted `keys`; `default` where a key is missing."""
    if not len(keys):
        return np.full((len(wanted), values.shape[1]), default)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    out = values[at]
    out[keys[at] != wanted] = default
    return out


def build_model(languages: list[str], grams: np.ndarray, counts: np.ndarray, vocabulary: int) -> Model:
    """Kneser-Ney arrays from the distinct ORDER-grams (rows of code points) and their counts per language.

    The highest order uses counts; each lower one the number of different
    characters seen before an n-gram. Order n takes off the discount
    n1 / (n1 + 2 n2), from the numbers of n-grams seen once and twice.
    """
    k = len(languages)
    model = Model(languages, [], [], [], [], np.full(k, 1.0 / (vocabulary + 1)))
    current, weights = grams, counts.astype(float)
    for n in range(ORDER, 0, -1):
        once, twice = (weights == 1).sum(0), (weights == 2).sum(0)
        discount = np.where(once + 2 * twice > 0, once / np.maximum(once + 2 * twice, 1), 0.5)
        discount = np.clip(discount, 0.1, 0.9)
        heads, inverse = np.unique(current[:, :-1], axis=0, return_inverse=True) if n > 1 else (np.zeros((1, 0), np.uint32), np.zeros(len(current), np.int64))
        inverse = inverse.ravel()
        totals, kinds = np.zeros((len(heads), k)), np.zeros((len(heads), k))
        np.add.at(totals, inverse, weights)
        np.add.at(kinds, inverse, weights > 0)
        share = np.maximum(weights - discount, 0) / np.maximum(totals[inverse], 1e-9)
        backoff = np.where(totals > 0, discount * kinds / np.maximum(totals, 1e-9), 1.0)
        for keys, values, into_keys, into_values, size in (
            (current, share, model.grams, model.shares, n),
            (heads, backoff, model.contexts, model.backoffs, n - 1),
        ):
            hashes = _row_hashes(keys, size)
            order = np.argsort(hashes)
            into_keys.insert(0, hashes[order])
            into_values.insert(0, values[order])
        if n > 1:
            tails, back = np.unique(current[:, 1:], axis=0, return_inverse=True)
            lower = np.zeros((len(tails), k))
            np.add.at(lower, back.ravel(), weights > 0)
            current, weights = tails, lower
    return model


def _row_hashes(rows: np.ndarray, n: int) -> np.ndarray:
    """The hash of gram_hashes for whole n-grams given as rows of code points."""
    if n == 0:
        return np.zeros(len(rows), np.uint64)
    value, power = np.zeros(len(rows), np.uint64), np.ones(1, np.uint64)
    for i in range(n):
        value = value + rows[:, n - 1 - i].astype(np.uint64) * power
        power = power * _BASE
    return mix64(value + np.uint64(n))


def _sampled(rows: DataFrame, per_language: int) -> DataFrame:
    """About `per_language` rows of each language, drawn by a hash of the id."""
    shares = rows.groupBy(F.col("lang").alias("of")).agg((F.lit(per_language) / F.count("*")).alias("share"))
    draw = F.pmod(F.xxhash64("r.doc_id"), F.lit(1_000_000)) / 1_000_000
    # a row per language is sent, so that no text is dealt by its language
    return rows.alias("r").join(F.broadcast(shares).alias("s"), F.expr("r.lang = s.of")).where(draw < F.col("s.share")).select("r.*")


def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """lang, text -> lang, gram (ORDER characters), n of each batch."""
    for batch in batches:
        for lang, texts in batch.groupby("lang")["text"]:
            words = pd.Series([w for t in texts for w in letter_words(t)], dtype=object)
            counts: dict[str, int] = {}
            for word, n in words.value_counts().items():
                padded = " " * (ORDER - 1) + word + " "
                for i in range(len(padded) - ORDER + 1):
                    gram = padded[i : i + ORDER]
                    counts[gram] = counts.get(gram, 0) + int(n)
            yield pd.DataFrame({"lang": lang, "gram": pd.Series(list(counts), dtype=object), "n": pd.Series(list(counts.values()), dtype="int64")})


def learn(rows: DataFrame, calibration: Column, per_language: int = ROWS_PER_LANGUAGE) -> Model | None:
    """Models from `rows` (doc_id, text, lang not null); the curve from those where `calibration` holds."""
    rows = rows.where(F.col("lang").isNotNull()).withColumn("calibration", calibration)
    sample = _sampled(rows, per_language)
    counted = (
        sample.where(~F.col("calibration")).select("lang", "text").mapInPandas(_count_grams, "lang string, gram string, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    )  # n-grams of at most per_language rows of each language
    if not len(counted):
        return None
    languages = sorted(counted["lang"].unique())
    table_ = counted.pivot_table(index="gram", columns="lang", values="n", fill_value=0, aggfunc="sum")[languages]
    grams = utf8_rows(list(table_.index), ORDER)[0]
    model = build_model(languages, grams, table_.to_numpy(), len(np.unique(grams)))
    judge = verdicts(rows.sparkSession, model)
    judged = sample.where(F.col("calibration")).select("lang", judge(F.col("text")).alias("v")).select("lang", "v.*").toPandas()
    judged = judged[judged["lang_pred"] != UNKNOWN]
    if len(judged):
        x = judged["margin"].to_numpy()
        y = (judged["lang_pred"] == judged["lang"]).to_numpy(float)
        # one row of either kind more, so that the curve exists if all are right
        model.slope, model.offset = fit_logistic(np.concatenate([x, [0.0, 0.0]]), np.concatenate([y, [0.0, 1.0]]))
        right = judged[judged["lang_pred"] == judged["lang"]]
        worst = right.groupby("lang")["entropy"].max().to_dict()
        most = max(worst.values(), default=np.inf)
        model.worst = np.array([worst.get(lang, most) for lang in languages])
    return model


VERDICT = "lang_pred string, score double, entropy double, margin double, rejected boolean"


def verdicts(spark: SparkSession, model: Model | None) -> Callable[[Column], Column]:
    """A column function: text -> lang_pred, score, entropy (nats per character), margin, rejected.

    The margin is the lead over the second best language times the root of the
    length. Rejected: no letter, a score under 0.5, or an entropy nearer to that
    of guessing every character than to the largest seen in calibration.
    """
    sent = spark.sparkContext.broadcast(model)  # bounded by the learning sample

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = sent.value
        memo: dict[str, int] = {}
        scores = np.zeros((0, len(m.languages) if m else 0))
        for batch in batches:
            parts = []
            for lo in range(0, max(1, len(batch)), 200):
                words = [letter_words(t) for t in batch.iloc[lo : lo + 200]]
                if m:
                    seen = set().union(*words)
                    if len(memo) + len(seen) > MEMO_ENTRIES:
                        memo, scores = {}, scores[:0]
                    new = [w for w in seen if w not in memo]
                    if new:
                        memo.update(zip(new, range(len(memo), len(memo) + len(new)), strict=True))
                        if len(memo) > len(scores):  # room for as many again
                            grown = np.zeros((max(2 * len(scores), len(memo)), len(m.languages)))
                            grown[: len(memo) - len(new)] = scores[: len(memo) - len(new)]
                            scores = grown
                        scores[len(memo) - len(new) : len(memo)] = m.word_scores(new)
                parts += [_verdict(own, m, memo, scores) for own in words]
            frame = pd.DataFrame(parts, columns=["lang_pred", "score", "entropy", "margin", "rejected"])
            yield frame.astype({"lang_pred": object, "entropy": float, "margin": float, "score": float, "rejected": bool})

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, VERDICT).asNondeterministic()  # evaluated once, however often its fields are used


def _verdict(words: list[str], m: Model | None, memo: dict[str, int], scores: np.ndarray) -> tuple:
    if not words or m is None:
        return UNKNOWN, 0.0, None, None, True
    n = len(words) + sum(map(len, words))
    entropy = -scores[np.fromiter(map(memo.__getitem__, words), np.int64, len(words))].sum(0) / n
    best = int(entropy.argmin())
    second = np.delete(entropy, best).min() if len(entropy) > 1 else entropy[best] + 1
    margin = float((second - entropy[best]) * np.sqrt(n))
    score = float(1 / (1 + np.exp(-np.clip(m.slope * margin + m.offset, -30, 30))))
    uniform = -float(np.log(m.floor[0]))
    far = m.worst is not None and entropy[best] > (m.worst[best] + uniform) / 2
    return m.languages[best], score, float(entropy[best]), margin, bool(score < 0.5 or far)


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned from rows whose crc32(doc_id) mod 4 is not 2 (3: calibration)."""
    docs = table(spark, sf_dir, "documents")
    rest = id_remainder(F.col("doc_id"), 4)
    model = learn(docs.select("doc_id", "text", "lang").where(rest != 2), rest == 3)
    held_out = F.coalesce(rest == 2, F.lit(False))  # a null id is not held out
    judged = docs.select("doc_id", held_out.alias("held_out"), verdicts(spark, model)(F.col("text")).alias("v"))
    return judged.select("doc_id", "held_out", "v.lang_pred", "v.score", "v.entropy", "v.rejected")
