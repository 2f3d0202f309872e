"""Operator 10: removal of repeated 100-byte strings by bucket-pointer refinement.

Every byte covered by a string of `LENGTH` bytes that also starts earlier (in a
document of smaller id, or earlier in the same one) is removed. Suffixes are
sorted only as deep as that takes, by refining buckets:

1. Initial buckets hold equal q-grams. One suffix in about 35 is enough: every
   LENGTH-byte string is represented by its smallest q-gram (by hash; the
   leftmost of equals), so equal strings are represented at the same offset.
2. Buckets are refined by what lies around the q-gram: two suffixes whose whole
   surroundings (every string that the q-gram may represent) agree stay
   together, and all but the first of them are repeated throughout. Buckets of
   one suffix are settled: nothing there is repeated.
3. First suffixes of different surroundings in one bucket may still share some
   of the strings. Their buckets are refined for each offset x between string
   and q-gram by the identifiers of the parts before and behind: a string is
   repeated if its refined bucket holds an earlier suffix.

Step 2 is one shuffle. Each batch of documents first settles equal surroundings
among its own suffixes and sends one row for each; a bucket that is seen to
hold several surroundings in a batch is dealt by surroundings instead of by
q-gram (with one marker row to tell the others), so that no group has more rows
than there are batches, however common a passage is. Step 3 sends the bytes
around the suffixes left; buckets of over `GROUP_ROWS` rows are dealt by the
refined buckets themselves, with partial aggregation.

Identifiers are 64-bit hashes, compared within a bucket, so that two
independent ones must agree. Defined results: a null text has no bytes; texts
under LENGTH bytes are kept whole; rows with equal id and text are one document
(each gets its result), rows with equal id and other text are ordered by a hash
of the text, null ids come first; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chirpstat.llm.common import land, mix64, numbered, table, whole_groups

LENGTH = 100
GRAM = 32
#: Bytes on either side of a q-gram that a string represented by it may reach.
REACH = LENGTH - GRAM
#: Bytes of a text worked on at once, and rows of a bucket that one task holds.
CHUNK = 1 << 19
GROUP_ROWS = 100_000
_BASE = 0x9E3779B97F4A7C15
_MASK64 = (1 << 64) - 1


@functools.lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number for each byte, and the powers and inverse powers of the base, modulo 2**64."""
    values = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    n, one = CHUNK + 4 * LENGTH, np.ones(1, np.uint64)
    inverse = pow(_BASE, -1, 1 << 64)
    powers = np.cumprod(np.concatenate([one, np.full(n, _BASE, np.uint64)]))
    inverses = np.cumprod(np.concatenate([one, np.full(n, inverse, np.uint64)]))
    return values, powers, inverses


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position."""
    h = _tables()[0][data]
    n, power = 1, _BASE
    while n < GRAM:
        h = h[:-n] * np.array([power], np.uint64) + h[n:]
        power = power * power & _MASK64
        n *= 2
    return mix64(h)


def _smallest(h: np.ndarray) -> np.ndarray:
    """Positions that are the leftmost smallest of some window of REACH + 1 neighbours."""
    low = np.uint64((1 << 20) - 1)
    s = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    n, width = 1, REACH + 1
    while 2 * n <= width:
        s = np.minimum(s[:-n], s[n:])
        n *= 2
    if n < width:
        s = np.minimum(s[: len(s) - (width - n)], s[width - n :])
    at = (s & low).astype(np.int64)
    return at[np.concatenate([[True], at[1:] != at[:-1]])]


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets of the representing q-grams, their hashes, and hashes of their surroundings."""
    raw = np.frombuffer(data, np.uint8)
    if len(raw) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    values, powers, inverses = _tables()
    out = []
    for lo in range(0, max(1, len(raw) - LENGTH + 1), CHUNK):  # strings that start in [lo, lo + CHUNK)
        part = raw[lo : lo + CHUNK + LENGTH - 1]
        if len(part) < LENGTH:
            break
        h = _gram_hashes(part)
        at = _smallest(h)
        first = max(0, lo - REACH)
        around = raw[first : lo + CHUNK + 2 * LENGTH]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values[around] * powers[: len(around)])])
        begin = np.maximum(at + lo - REACH, 0) - first
        end = np.minimum(at + lo + LENGTH, len(raw)) - first
        shape = (begin + first - at - lo).astype(np.uint64) * np.array([1 << 32], np.uint64) + (end - begin).astype(np.uint64)
        out.append((at + lo, h[at], mix64((sums[end] - sums[begin]) * inverses[begin] + mix64(shape))))
    at, h, f = (np.concatenate(x) for x in zip(*out, strict=True))
    keep = np.concatenate([[True], at[1:] != at[:-1]])
    return at[keep], h[keep], f[keep]


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


CANDIDATES = "key long, f long, h long, doc long, off int, kind byte"
_CANDIDATE, _MARKER, _REPEATED, _MANY = 0, 1, 2, 3


def _candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(doc, text) -> one row for each surroundings in the batch, settled rows, and markers."""
    for batch in batches:
        found = [(doc, *anchors(_bytes(text))) for doc, text in zip(batch["doc"].tolist(), batch["text"], strict=True)]
        found = [x for x in found if len(x[1])]
        if not found:
            continue
        doc = np.concatenate([np.full(len(x[1]), x[0], np.int64) for x in found])
        off, h, f = (np.concatenate([x[k] for x in found]) for k in (1, 2, 3))
        del found
        order = np.lexsort((off, doc, f, h))
        doc, off, h, f = doc[order], off[order], h[order], f[order]
        new_h = np.concatenate([[True], h[1:] != h[:-1]])
        new_f = new_h | np.concatenate([[True], f[1:] != f[:-1]])
        group = np.cumsum(new_h) - 1
        many = (np.bincount(group, weights=new_f) > 1)[group]
        kind = np.where(~new_f, _REPEATED, np.where(many, _MANY, _CANDIDATE)).astype(np.int8)
        key = np.where(kind == _CANDIDATE, h, np.where(kind == _MANY, mix64(h + f * np.array([3], np.uint64)), mix64(doc.astype(np.uint64) + off.astype(np.uint64))))
        marker = np.flatnonzero(new_h & many)
        yield pd.DataFrame({
            "key": np.concatenate([key, h[marker]]).view(np.int64), "f": np.concatenate([f, f[marker]]).view(np.int64),
            "h": np.concatenate([h, h[marker]]).view(np.int64), "doc": np.concatenate([doc, doc[marker]]),
            "off": np.concatenate([off, off[marker]]).astype(np.int32),
            "kind": np.concatenate([kind, np.full(len(marker), _MARKER, np.int8)]),
        })


def _settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by (key, f, doc, off) -> repeated suffixes (open: False) and those left for step 3 (open: True)."""

    def judge(rows: pd.DataFrame) -> pd.DataFrame:
        key, f, kind = rows["key"].to_numpy(), rows["f"].to_numpy(), rows["kind"].to_numpy()
        sure = kind == _REPEATED  # settled in its batch; its key means nothing
        real = ~sure & (kind != _MARKER)
        new_key = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.cumsum(new_key) - 1
        # the first real row of each surroundings
        run = np.cumsum(new_key | np.concatenate([[True], f[1:] != f[:-1]])) - 1
        seen = np.cumsum(real)
        before = np.concatenate([[0], seen[:-1]])
        starts = np.concatenate([[0], np.flatnonzero(np.diff(run)) + 1])
        first = real & (before == before[starts][run])
        many = (np.bincount(group, weights=first) > 1)[group] | (np.bincount(group, weights=(kind == _MARKER) | (kind == _MANY)) > 0)[group]
        repeated = sure | (real & ~first)
        take = repeated | (first & many)
        return pd.DataFrame({"doc": rows["doc"][take], "off": rows["off"][take], "h": rows["h"][take], "open": ~repeated[take]})

    for rows in whole_groups(batches, "key"):
        yield judge(rows)


def _unpack(data: bytes) -> bytes:
    import zstandard

    return zstandard.decompress(data)


def _surroundings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(doc, body, open suffixes) -> h, doc, off, pad (missing bytes on the left), bytes around."""
    for batch in batches:
        out = []
        for doc, body, spots in zip(batch["doc"].tolist(), batch["body"], batch["spots"], strict=True):
            data = _unpack(body)
            for spot in spots:
                off, h = spot["off"], spot["h"]
                out.append((h, doc, off, max(0, REACH - off), data[max(0, off - REACH) : off + LENGTH]))
        yield pd.DataFrame(out, columns=["h", "doc", "off", "pad", "around"])


def _string_keys(pads: np.ndarray, around: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the REACH + 1 strings around each suffix (column x starts at off - REACH + x), and which exist."""
    width = REACH + LENGTH
    values, powers, inverses = _tables()
    matrix = np.zeros((len(around), width), np.uint64)
    lens = np.fromiter(map(len, around), np.int64, len(around))
    flat = np.frombuffer(b"".join(around), np.uint8)
    column = np.arange(width)
    inside = (column >= pads[:, None]) & (column < (pads + lens)[:, None])
    matrix[inside] = values[flat]
    matrix *= powers[:width]
    sums = np.concatenate([np.zeros((len(around), 1), np.uint64), np.cumsum(matrix, axis=1)], axis=1)
    keys = mix64((sums[:, LENGTH:] - sums[:, : REACH + 1]) * inverses[: REACH + 1])
    start = np.arange(REACH + 1)
    exists = (start >= pads[:, None]) & (start + LENGTH <= (pads + lens)[:, None])
    return keys, exists


def _spans(doc: np.ndarray, off: np.ndarray, hit: np.ndarray) -> pd.DataFrame:
    """Covered bytes of the strings marked in hit (rows x REACH + 1), as runs per row."""
    edge = np.zeros((len(hit), 1), bool)
    step = np.diff(np.concatenate([edge, hit, edge], axis=1).astype(np.int8), axis=1)
    row, begin = np.nonzero(step == 1)
    _, end = np.nonzero(step == -1)
    at = off[row] - REACH
    return pd.DataFrame({"doc": doc[row], "begin": (at + begin).astype(np.int32), "end": (at + end - 1 + LENGTH).astype(np.int32)})


def _refine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by (h, doc, off) -> spans of strings that an earlier row of the bucket has too."""

    def judge(rows: pd.DataFrame) -> pd.DataFrame:
        doc, off, h = rows["doc"].to_numpy(), rows["off"].to_numpy().astype(np.int64), rows["h"].to_numpy().view(np.uint64)
        keys, exists = _string_keys(rows["pad"].to_numpy().astype(np.int64), rows["around"].tolist())
        at, x = np.nonzero(exists)
        own = mix64(keys[at, x] ^ mix64(h[at]))
        hit = np.zeros(exists.shape, bool)
        if not len(own):
            return _spans(doc, off, hit)
        place = (np.unique(doc, return_inverse=True)[1].astype(np.int64)[at] << 32) + off[at] + x  # one string may be met at several q-grams
        order = np.argsort(own, kind="stable")
        new = np.concatenate([[True], own[order][1:] != own[order][:-1]])
        first = np.minimum.reduceat(place[order], np.flatnonzero(new))
        later = np.zeros(len(own), bool)
        later[order] = place[order] > first[np.cumsum(new) - 1]
        hit[at[later], x[later]] = True
        return _spans(doc, off, hit)

    for rows in whole_groups(batches, "h"):
        yield judge(rows)


def _string_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of a large bucket -> one row for each string: refined bucket, doc, begin."""
    for batch in batches:
        for lo in range(0, len(batch), 2000):
            rows = batch.iloc[lo : lo + 2000]
            keys, exists = _string_keys(rows["pad"].to_numpy().astype(np.int64), rows["around"].tolist())
            at, x = np.nonzero(exists)
            yield pd.DataFrame({
                "h": rows["h"].to_numpy()[at], "string": keys[at, x].view(np.int64), "doc": rows["doc"].to_numpy()[at],
                "begin": (rows["off"].to_numpy().astype(np.int64)[at] - REACH + x).astype(np.int32),
            })


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(doc_id, body, repeated suffixes, spans) -> the result row of each document."""
    for batch in batches:
        out = []
        for doc_id, body, offs, spans in zip(batch["doc_id"], batch["body"], batch["offs"], batch["spans"], strict=True):
            data = _unpack(body)
            n = len(data)
            marks = np.zeros(n + 1, np.int32)
            if offs is not None and len(offs):
                off = np.asarray(offs, np.int64)
                begin, end = np.maximum(off - REACH, 0), np.minimum(off + LENGTH, n)
                full = end - begin >= LENGTH
                np.add.at(marks, begin[full], 1)
                np.add.at(marks, end[full], -1)
            for s in spans if spans is not None else ():
                marks[s["begin"]] += 1
                marks[s["end"]] -= 1
            gone = np.cumsum(marks[:n]) > 0
            kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
            runs = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + (n > 0 and gone[0]))
            out.append((doc_id, n, int(gone.sum()), runs, hashlib.sha256(kept).hexdigest(), kept))
        frame = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
        frame["doc_id"] = frame["doc_id"].astype("Int64")
        yield frame


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import zstandard

    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        bodies = [packer.compress(_bytes(t)) for t in batch["text"]]
        yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "doc": batch["doc"], "body": bodies})


def remove_repeats(docs: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes left) of every row of `docs`."""
    rows = numbered(docs)
    repeated = rows.groupBy("doc").count().where("count > 1")
    once = rows if repeated.isEmpty() else rows.dropDuplicates(["doc"])  # a repeated row does not start earlier than itself
    sent = once.select("doc", "text").mapInPandas(_candidates, CANDIDATES)
    settled = sent.repartition("key").sortWithinPartitions("key", "f", "doc", "off").mapInPandas(_settle, "doc long, off int, h long, open boolean")
    settled = land(settled, "dedup-settled")
    bodies = "doc_id long, doc long, body binary"
    packed = rows.mapInPandas(_pack, bodies)

    left = settled.where("open")
    spots = left.groupBy("doc").agg(F.collect_list(F.struct("off", "h")).alias("spots"))  # bounded by a document's length
    around = once.mapInPandas(_pack, bodies).join(spots, "doc").select("doc", "body", "spots").mapInPandas(_surroundings, "h long, doc long, off int, pad int, around binary")
    large = left.groupBy("h").count().where(F.col("count") > group_rows).select("h")
    spans_schema = "doc long, begin int, end int"
    if large.isEmpty():
        spans = around.repartition("h").sortWithinPartitions("h", "doc", "off").mapInPandas(_refine, spans_schema)
    else:
        # at most 1 / group_rows of the suffixes left are bucket names: Spark sends them by their size
        around = land(around, "dedup-around")
        few = around.join(large, "h", "left_anti").repartition("h").sortWithinPartitions("h", "doc", "off").mapInPandas(_refine, spans_schema)
        strings = land(around.join(large, "h", "left_semi").mapInPandas(_string_rows, "h long, string long, doc long, begin int"), "dedup-strings")
        first = strings.groupBy("h", "string").agg(F.min(F.struct("doc", "begin")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
        later = strings.join(first, ["h", "string"]).where(F.struct("doc", "begin") > F.col("first"))
        spans = few.unionByName(later.select("doc", "begin", (F.col("begin") + LENGTH).cast("int").alias("end")))

    offs = settled.where("NOT open").groupBy("doc").agg(F.collect_list("off").alias("offs"))
    found = spans.groupBy("doc").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    joined = packed.join(offs.join(found, "doc", "full"), "doc", "left").select("doc_id", "body", "offs", "spans")
    return joined.mapInPandas(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is removed from every document, and a digest of what is kept."""
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")
