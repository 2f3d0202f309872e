"""Operator 8: compression classifier.

Two zstandard dictionaries are built, from good and from bad labelled texts.
Every text is cut into pieces of equal size and each piece is compressed with
either dictionary; the difference of the summed sizes over the text's length is
small or negative where the text looks like the bad ones. A logistic curve,
fitted on labelled rows that the dictionaries have not seen, turns it into a
score between 0 and 1.

The labelled rows used are a bounded sample (`Sample`): those with the lowest
md5 of their id. The dictionaries learn from pieces drawn by a hash from all
places of all sampled texts, so that the driver gets `max_chars` at most, however
long the texts are; the curve learns from whole texts, measured in the tasks. An id
with two labels has the smaller one. Everything else covers all rows and whole
texts. Defined results: null and empty texts have the difference 0 and the
score of the curve there; rows of one id are scored one by one; labels, lang,
source and doc_id are no inputs of a score. A null doc_id is not held out, and no
label is its. Without labelled texts of both labels nothing can be told apart: every
text then scores the share of label 1 among the labelled rows (0.5 if there are
none). No documents give no rows.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chirpstat.llm.common import id_remainder, land, table

PIECE_BYTES = 1024
LEVEL = 3
DICT_BYTES = 112_640
THRESHOLD = 0.3


@dataclass(frozen=True)
class Sample:
    """Bound of what is learned from: rows of each label, and bytes of all pieces drawn for the dictionaries."""

    dictionary_rows: int = 1500
    calibration_rows: int = 2500
    max_chars: int = 12_000_000


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    slope: float
    offset: float


def pieces(data: bytes) -> list[bytes]:
    return [data[i : i + PIECE_BYTES] for i in range(0, len(data), PIECE_BYTES)]


@functools.lru_cache(maxsize=4)
def _compressors(good: bytes, bad: bytes):
    import zstandard

    made = []
    for content in (good, bad):
        d = zstandard.ZstdCompressionDict(content)
        d.precompute_compress(level=LEVEL)
        made.append(zstandard.ZstdCompressor(dict_data=d, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False))
    return made


def difference(text: str | None, good: bytes, bad: bytes) -> float:
    """(size with the bad dictionary - size with the good one) / length; 0 for an empty text."""
    data = (text or "").encode("utf-8", "replace")
    if not data:
        return 0.0
    with_good, with_bad = _compressors(good, bad)
    total = 0
    for piece in pieces(data):
        total += len(with_bad.compress(piece)) - len(with_good.compress(piece))
    return total / len(data)


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of P(y=1) = 1 / (1 + exp(-(slope * x + offset))), by Newton steps with a little shrinkage."""
    scale = float(np.abs(x).max()) or 1.0
    z = np.column_stack([x / scale, np.ones(len(x))])
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (y - p) - 1e-3 * w
        hessian = (z * (p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2)
        w += np.clip(np.linalg.solve(hessian, gradient), -5, 5)
    return float(w[0] / scale), float(w[1])


def sample_ids(labelled: DataFrame, calibration: Column, sample: Sample) -> DataFrame:
    """The rows learned from: (doc_id, label, calibration), bounded by `sample`.

    `labelled` has doc_id and label (0 or 1). Rows for the curve (where
    `calibration` holds) keep the labels' own proportions; rows for the
    dictionaries are as many of either label.
    """
    rows = labelled.groupBy("doc_id").agg(F.min("label").alias("label")).withColumn("calibration", calibration)
    order = [F.md5(F.col("doc_id").cast("string")), F.col("doc_id")]
    parts = [rows.where("calibration").orderBy(*order).limit(sample.calibration_rows)]
    for label in (0, 1):
        own = rows.where(~F.col("calibration") & (F.col("label") == label))
        parts.append(own.orderBy(*order).limit(sample.dictionary_rows))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def sample_pieces(texts: DataFrame, max_chars: int = Sample.max_chars) -> DataFrame:
    """label and piece for the dictionaries, at most `max_chars` / 2 bytes of either label, drawn from all of `texts` (doc_id, label, text)."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, label, text in zip(batch["doc_id"], batch["label"], batch["text"], strict=True):
                for at, piece in enumerate(pieces((text or "").encode("utf-8", "replace"))):
                    rows.append((label, hashlib.md5(f"{doc_id}:{at}".encode()).hexdigest(), piece))
            yield pd.DataFrame(rows, columns=["label", "draw", "piece"])

    drawn = texts.select("doc_id", "label", "text").mapInPandas(cut, "label int, draw string, piece binary")
    each = max(1, max_chars // 2 // PIECE_BYTES)
    good, bad = (drawn.where(F.col("label") == label).orderBy("draw", "piece").limit(each) for label in (1, 0))
    return good.unionByName(bad).select("label", "piece")


def dictionaries(drawn: list[tuple[int, bytes]]) -> tuple[bytes, bytes]:
    """The dictionaries of good and of bad pieces; `drawn` are (label, piece)."""
    import zstandard

    made = []
    for label in (1, 0):
        chunks = [bytes(p) for own, p in drawn if own == label]
        if not chunks:
            raise ValueError(f"no labelled text of label {label} to learn from")
        try:
            made.append(zstandard.train_dictionary(DICT_BYTES, chunks).as_bytes())
        except zstandard.ZstdError:  # too little text for the trainer: the texts themselves serve
            made.append(b"".join(chunks)[-DICT_BYTES:])
    return made[0], made[1]


def with_curve(good: bytes, bad: bytes, curve: list[tuple[float, int]]) -> Model:
    """The model of two dictionaries and the curve through (difference, label)."""
    if len({label for _, label in curve}) < 2:  # no curve can be fitted: a fixed one through 0
        return Model(good, bad, 100.0, 0.0)
    x, y = (np.array(v, float) for v in zip(*curve, strict=True))
    return Model(good, bad, *fit_logistic(x, y))


def learn(rows: list[tuple[int, bool, str]]) -> Model:
    """Dictionaries and curve from (label, for the curve, text) rows."""
    good, bad = dictionaries([(label, p) for label, curve, t in rows if not curve for p in pieces(t.encode("utf-8", "replace"))])
    return with_curve(good, bad, [(difference(t, good, bad), label) for label, curve, t in rows if curve])


def differences(texts: DataFrame, good: bytes, bad: bytes) -> DataFrame:
    """x (the difference) and label of every row of `texts` (label, text)."""
    sent = texts.sparkSession.sparkContext.broadcast((good, bad))  # two dictionaries of at most DICT_BYTES each

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"x": [difference(t, *sent.value) for t in batch["text"]], "label": batch["label"]})

    return texts.select("text", "label").mapInPandas(run, "x double, label int")


def constant(good: int, labels: int) -> Model:
    """Where nothing can be told apart, every text has the share of label 1 as its score (0.5 without labels)."""
    share = good / labels if labels else 0.5
    return Model(b"", b"", 0.0, math.log((share + 1e-12) / (1 - share + 1e-12)))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row of `docs` (doc_id, text)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of at most DICT_BYTES each

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = sent.value
        for batch in batches:
            x = [difference(t, m.good, m.bad) if m.slope else 0.0 for t in batch["text"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"),
                "score": [1 / (1 + math.exp(-max(-30.0, min(30.0, m.slope * v + m.offset)))) for v in x],
            })

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(run, "doc_id long, score double")


def op8_quality_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document; learned from labelled rows whose crc32(doc_id) mod 5 is not 0."""
    docs = table(spark, sf_dir, "documents")
    rest = id_remainder(F.col("doc_id"), 5)
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("int").alias("label"))
    labels = labels.where((rest != 0) & F.col("label").isin(0, 1))
    ids = sample_ids(labels, rest == 1, Sample())
    # at most 2 * dictionary_rows + calibration_rows ids are broadcast
    found = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(ids), "doc_id")
    found = land(found, "quality-sample")
    drawn = sample_pieces(found.where("NOT calibration"))
    drawn = sorted((r["label"], bytes(r["piece"])) for r in drawn.collect())  # at most max_chars bytes
    if {label for label, _ in drawn} == {0, 1}:
        good, bad = dictionaries(drawn)
        # one number a sampled row
        model = with_curve(good, bad, sorted((r["x"], r["label"]) for r in differences(found.where("calibration"), good, bad).collect()))
    else:
        by_label = {r["label"]: r["count"] for r in found.groupBy("label").count().collect()}
        model = constant(by_label.get(1, 0), sum(by_label.values()))
    scored = score_documents(docs, model)
    return scored.select(
        "doc_id",
        F.coalesce(id_remainder(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
