"""Operator 1: token ids in directly addressable codes (DAC).

A segment holds the token ids of consecutive documents. Every id is split into
chunk levels (8, 8 and 16 bits): level k holds the k-th chunk of each id that
has one, a continuation bitmap tells which ids go on at the next level, and a
rank directory (ones before each 512-bit block) turns a position at one level
into a position at the next. Any token is read by one address per level, with
no block to decode.

Segment bytes, little endian: magic ``DAC1``, n_docs u64, n_tokens u64, document
ends u64[n_docs]; per level: n_values u64, n_blocks u64, chunks, bitmap bytes,
rank directory u64[n_blocks]. Segments are the rows of a Parquet folder in the
shared store (Spark's writers are the only ones that reach every store).
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chirpstat.llm.common import MEMO_ENTRIES, release_memory, table
from chirpstat.session import scratch_path

END_ID = 2
LEVEL_BITS = (8, 8, 16)
BLOCK_BITS = 512
#: A segment is closed when it holds this many tokens; a longer document has a segment of its own.
SEGMENT_TOKENS = 1_000_000
#: Texts are looked up together up to so many bytes: the table is hashed once a slice.
SLICE_BYTES = 24_000_000
#: Texts of a slice are cut, and their ids put together, up to so many bytes at once: these steps need many times their bytes.
CUT_BYTES = 1_000_000
#: New words encoded in one call: longer rows cost more a word.
ROW_WORDS = 64
_CHUNK = {8: "u1", 16: "<u2"}
_MAGIC = b"DAC1"


def dac_encode(tokens: np.ndarray, ends: np.ndarray) -> bytes:
    """Segment bytes of `tokens` (ids below 2**32) with the documents' end positions."""
    parts = [_MAGIC, np.array([len(ends), len(tokens)], "<u8").tobytes(), ends.astype("<u8").tobytes()]
    rest = tokens.astype(np.uint32)
    for level, bits in enumerate(LEVEL_BITS):
        last = level == len(LEVEL_BITS) - 1
        chunk = (rest & np.uint32((1 << bits) - 1)).astype(_CHUNK[bits])
        more = np.zeros(len(rest), bool) if last else (rest >> np.uint32(bits)) > 0
        bitmap = np.packbits(more, bitorder="little")
        starts = np.arange(0, len(rest), BLOCK_BITS)
        ones = np.add.reduceat(more, starts, dtype=np.int64) if len(rest) else np.zeros(0, np.int64)
        ranks = np.concatenate([[0], np.cumsum(ones)[:-1]]) if len(ones) else ones
        parts += [np.array([len(rest), len(ranks)], "<u8").tobytes(), chunk.tobytes(), bitmap.tobytes(), ranks.astype("<u8").tobytes()]
        rest = np.zeros(0, np.uint32) if last else rest[more] >> np.uint32(bits)
    return b"".join(parts)


class DacSegment:
    """Reader of one segment: random access by address, or all ids at once."""

    def __init__(self, data: bytes):
        if data[:4] != _MAGIC:
            raise ValueError("not a DAC segment")
        self.n_docs, self.n_tokens = (int(x) for x in np.frombuffer(data, "<u8", 2, 4))
        at = 20
        self.ends = np.frombuffer(data, "<u8", self.n_docs, at).astype(np.int64)
        at += 8 * self.n_docs
        self.levels = []
        for bits in LEVEL_BITS:
            n, blocks = (int(x) for x in np.frombuffer(data, "<u8", 2, at))
            at += 16
            chunk = np.frombuffer(data, _CHUNK[bits], n, at)
            at += chunk.nbytes
            bitmap = np.frombuffer(data, "u1", (n + 7) // 8, at)
            at += bitmap.nbytes
            ranks = np.frombuffer(data, "<u8", blocks, at)
            at += ranks.nbytes
            self.levels.append((chunk, bitmap, ranks))

    def token(self, i: int) -> int:
        """The id at position i, by one address per level."""
        value, shift = 0, 0
        for bits, (chunk, bitmap, ranks) in zip(LEVEL_BITS, self.levels, strict=True):
            value |= int(chunk[i]) << shift
            shift += bits
            if not bitmap[i >> 3] >> (i & 7) & 1:
                break
            block = i // BLOCK_BITS
            before = bitmap[block * (BLOCK_BITS // 8) : (i >> 3) + 1].copy()
            before[-1] &= (1 << (i & 7)) - 1
            i = int(ranks[block]) + int(np.bitwise_count(before).sum())
        return value

    def tokens(self) -> np.ndarray:
        """All ids, in order."""
        value = np.zeros(0, np.uint32)
        for bits, (chunk, bitmap, _) in reversed(list(zip(LEVEL_BITS, self.levels, strict=True))):
            own = chunk.astype(np.uint32)
            more = np.unpackbits(bitmap, count=len(chunk), bitorder="little").view(bool)
            if len(value):
                own[more] |= value << np.uint32(bits)
            value = own
        return value


#: White space that may close units; any other (of Unicode) has its text encoded in one go.
_SPACES = " \t\n\v\f\r"
_SPACE, _OTHER_SPACE, _ALNUM, _CLOSING = 1, 2, 3, 4
_KIND = np.zeros(256, np.uint8)
_KIND[list(_SPACES.encode())] = _OTHER_SPACE
_KIND[ord(" ")] = _SPACE
_KIND[list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = _ALNUM
_KIND[list(b"!#$%&*+,./:;=?@^~-")] = _CLOSING  # no apostrophe, as contractions begin with it


def cut_units(texts: pa.LargeStringArray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """All units of `texts` (no nulls) in order, and for each text the number of units up to its end."""
    at = np.frombuffer(texts.buffers()[1], "<i8")[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data else np.zeros(0, np.uint8)
    at = at - at[0]
    kind = _KIND[raw]
    space = (kind == _SPACE) | (kind == _OTHER_SPACE)
    first = space.copy()  # of a run of white space
    first[1:] &= ~space[:-1]
    last = space.copy()
    last[:-1] &= ~space[1:]
    filled = at[1:][at[1:] > at[:-1]]
    last[filled - 1] = False  # a run that ends the text is one piece
    begins = first | last
    begins[1:] |= (kind[:-1] == _OTHER_SPACE) & ~space[1:]
    begins[1:] |= (kind[:-1] == _ALNUM) & (kind[1:] == _CLOSING)
    begins[at[:-1][at[:-1] < len(raw)]] = True
    places = np.append(np.flatnonzero(begins), len(raw))
    units = pa.LargeStringArray.from_buffers(len(places) - 1, pa.py_buffer(places.astype("<i8")), pa.py_buffer(raw))
    return units, np.searchsorted(places[:-1], at[1:])


def _id_bytes(ids: np.ndarray, lens: np.ndarray) -> pa.LargeBinaryArray:
    """Rows of `lens` ids each, as the bytes of unsigned 32-bit integers."""
    places = np.concatenate([[0], np.cumsum(lens)]) * 4
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(lens), [None, pa.py_buffer(places.astype("<i8")), pa.py_buffer(ids.astype("<u4"))]
    )


def _spans(texts: pa.Array, text_bytes: int) -> Iterator[tuple[int, int]]:
    """First place, and the place after the last, of texts in order that have up to `text_bytes`; a longer one is alone."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64))
    lo = 0
    while lo < len(texts):
        before = upto[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(upto, before + text_bytes, side="right")))
        yield lo, hi
        lo = hi


class TextEncoder:
    """Whole texts to ids with the given tokenizer file.

    The byte-level pre-tokenizer starts a new piece at the first and at the last
    character of a run of white space inside a text, after a run that does not
    end in a space, and where a letter or digit is followed by punctuation other
    than an apostrophe. Texts are cut there into units whose ids depend on
    nothing outside them. Distinct units are encoded once and remembered, in a
    packed table of bounded size (some 50 bytes a unit). A text with white
    space beyond ASCII's, or with an added token of the tokenizer, is encoded
    in one go.
    """

    def __init__(self, path: str, entries: int = MEMO_ENTRIES):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self._tokenizer = Tokenizer.from_file(path)
        # units come once, so the model's own table of words would only be written
        getattr(self._tokenizer.model, "_resize_cache", lambda _: None)(0)
        self._added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._spaced = np.zeros(self._tokenizer.get_vocab_size(), bool)
        for token, i in self._tokenizer.get_vocab(with_added_tokens=False).items():
            if token[0] == "\u0120":  # the space, in the byte-level alphabet
                self._spaced[i] = True
        self._line_feed = self._encode_whole("\n")[0]
        self._entries = entries
        self._units, self._ids, self._uses = pa.array([], pa.large_string()), pa.array([], pa.large_binary()), np.zeros(0)

    def _encode_whole(self, text: str) -> np.ndarray:
        return np.array(self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    @staticmethod
    def _is_whole(unit: str) -> bool:
        """Whether texts with this unit are to be encoded in one go."""
        word = unit.removeprefix(" ")
        return word.split() != [word] and unit.strip(_SPACES) != ""

    def _encode_units(self, units: list[str]) -> pa.LargeBinaryArray:
        """Ids of each unit; none for one whose texts are encoded in one go."""
        # Words are encoded in rows: after a space or a line feed each stays what it is, and begins where these have their token.
        words = [i for i, u in enumerate(units) if u.split() == [u.removeprefix(" ")]]
        ids, lens, done = [], [], []
        for lo in range(0, len(words), ROW_WORDS):
            some = words[lo : lo + ROW_WORDS]
            row = [units[i] if units[i][0] == " " else "\n" + units[i] for i in some]
            text = "".join(row)
            if any(t in text for t in self._added):
                continue  # these one by one
            found = self._encode_whole(text)
            fed = found == self._line_feed
            begins = np.append(np.flatnonzero(self._spaced[found] | fed), len(found))
            if len(begins) == len(some) + 1:
                ids.append(found[~fed])
                lens.append(begins[1:] - begins[:-1] - fed[begins[:-1]])
                done += some
        for i in sorted(set(range(len(units))).difference(done)):
            ids.append(np.zeros(0, np.uint32) if self._is_whole(units[i]) else self._encode_whole(units[i]))
            lens.append([len(ids[-1])])
            done.append(i)
        return _id_bytes(np.concatenate(ids), np.concatenate(lens)).take(pa.array(np.argsort(done)))

    def _look_up(self, units: pa.LargeStringArray) -> np.ndarray:
        """Places of the distinct `units` in the table, which gets those it lacks."""
        at = pc.index_in(units, self._units)
        places = at.fill_null(-1).to_numpy().astype(np.int64)
        new = units.filter(at.is_null())
        if len(new):
            places[places < 0] = np.arange(len(self._units), len(self._units) + len(new))
            ids = self._encode_units(new.to_pylist())
            self._units, self._ids = pa.concat_arrays([self._units, new]), pa.concat_arrays([self._ids, ids])
            self._uses = np.append(self._uses, np.zeros(len(new)))
        self._uses *= 0.95
        self._uses[places] += 1
        return places

    def _forget(self) -> None:
        """Keep the units used most, and latest, of a table that has grown by half."""
        if len(self._units) > self._entries * 3 // 2:
            kept = np.sort(np.argpartition(self._uses, -self._entries)[-self._entries :])
            self._units, self._ids = self._units.take(pa.array(kept)), self._ids.take(pa.array(kept))
            self._uses = self._uses[kept]

    def encode_parts(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For some texts (null: empty) after the others, their ids and the position after each text's last id.

        All texts are looked up at once, by their distinct units; what is as
        long as the texts is held for up to `CUT_BYTES` of them at a time,
        except for a number a unit.
        """
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        spans, coded, ends = list(_spans(texts, CUT_BYTES)), [], []
        for lo, hi in spans:
            units, upto = cut_units(texts.slice(lo, hi - lo))
            coded.append(units.dictionary_encode())
            ends.append(upto)
        if not coded:
            return
        coded = pa.chunked_array(coded).unify_dictionaries().chunks
        distinct = coded[0].dictionary
        places = self._look_up(distinct) if len(distinct) else np.zeros(0, np.int64)
        own = self._ids.take(pa.array(places))
        self._forget()
        release_memory()  # what cutting and the look-up needed
        coded.reverse()
        for (lo, hi), upto in zip(spans, ends, strict=True):
            yield self._put_together(texts.slice(lo, hi - lo), own.take(coded.pop().indices), upto)

    def _put_together(self, texts: pa.LargeStringArray, found: pa.LargeBinaryArray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of `texts` from those of their units, `ends` of which are up to the end of each text."""
        if not len(found):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        upto = np.frombuffer(found.buffers()[1], "<i8")[: len(found) + 1] // 4
        ids = np.frombuffer(found.buffers()[2], "<u4")[: upto[-1]] if upto[-1] else np.zeros(0, np.uint32)
        id_ends = upto[ends]
        whole = np.zeros(len(texts), bool)
        whole[np.searchsorted(ends, np.flatnonzero(upto[1:] == upto[:-1]), side="right")] = True
        for token in self._added:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        if not whole.any():
            return ids, id_ends
        parts = np.split(ids, id_ends[:-1])
        for i in np.flatnonzero(whole).tolist():
            parts[i] = self._encode_whole(texts[i].as_py())
        return np.concatenate(parts), np.cumsum([len(p) for p in parts])

    def encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: empty) one after another, and the position after each text's last id."""
        parts = list(self.encode_parts(texts))
        before = np.cumsum([0, *(len(ids) for ids, _ in parts)])
        ids = np.concatenate([np.zeros(0, np.uint32), *(ids for ids, _ in parts)])
        return ids, np.concatenate([np.zeros(0, np.int64), *(ends + n for (_, ends), n in zip(parts, before[:-1], strict=True))])

    def encode(self, text: str | None) -> bytes:
        """Ids of a text (null: empty) as unsigned 32-bit integers in little-endian order."""
        return self.encode_texts(pa.array([text], pa.large_string()))[0].astype("<u4").tobytes()


@lru_cache(maxsize=1)
def _encoder(path: str) -> TextEncoder:
    """The encoder of a Python worker: its table of units serves the worker's next tasks, too."""
    return TextEncoder(path)


def _slices(batch: pa.RecordBatch, text_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows of `batch` in order, so many at once that their texts have up to `text_bytes`; a longer one comes alone."""
    for lo, hi in _spans(batch["text"], text_bytes):
        yield batch.slice(lo, hi - lo)


def _segments(path: str, segment_tokens: int):
    """Partition of (doc_id, text) rows in order -> segment rows."""

    def closed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder = _encoder(path)
        end = np.array([END_ID], np.uint32)
        state = {"ids": [], "data": [], "n": 0, "seq": 0, "before": 0}

        def close() -> pa.RecordBatch:
            ends = np.cumsum([len(d) + 1 for d in state["data"]])
            tokens = np.concatenate([x for d in state["data"] for x in (d, end)])
            row = {
                "part": part, "seq": state["seq"], "before": state["before"], "n_tokens": len(tokens),
                "doc_ids": state["ids"], "body": dac_encode(tokens, ends),
            }
            state.update(ids=[], data=[], n=0, seq=state["seq"] + 1, before=state["before"] + len(tokens))
            return pa.RecordBatch.from_pylist([row], _SEGMENT_ARROW)

        for rows in (some for batch in batches for some in _slices(batch, SLICE_BYTES)):
            doc_ids = iter(rows["doc_id"].to_pylist())
            for tokens, ends in encoder.encode_parts(rows["text"]):
                begin = 0
                for stop in ends.tolist():
                    n = stop - begin + 1
                    if state["n"] and state["n"] + n > segment_tokens:
                        yield close()
                    state["ids"].append(next(doc_ids))
                    state["data"].append(tokens[begin:stop])
                    state["n"] += n
                    begin = stop
        if state["data"]:
            yield close()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()  # left by the worker's earlier tasks
        yield from closed(batches)
        release_memory()

    return run


SEGMENT_SCHEMA = "part int, seq int, before long, n_tokens long, doc_ids array<long>, body binary"
_SEGMENT_ARROW = pa.schema([
    ("part", pa.int32()), ("seq", pa.int32()), ("before", pa.int64()), ("n_tokens", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("body", pa.binary()),
])


def write_tokens(
    docs: DataFrame, folder: str, tokenizer_path: str, segment_tokens: int = SEGMENT_TOKENS, partitions: int | None = None
) -> None:
    """Encode `docs` (doc_id, text) and write segments in ascending doc_id order.

    Null ids come first, rows of one id are ordered by text; a null or empty
    text has the end id alone. Documents are dealt to partitions by ranges of
    doc_id, so a partition's segments follow those of the one before it. Only
    the given columns are read; others may be there under any name.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(_segments(tokenizer_path, segment_tokens), SEGMENT_SCHEMA).write.option("compression", "zstd").parquet(folder)


def read_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Segments with `start`: the number of ids in all segments before them.

    Running counts inside a partition were taken as it was written; across
    partitions one row per partition (not per document) is summed.
    """
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(folder)
    totals = sorted(
        (r["part"], int(r["n"])) for r in segments.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()
    )
    starts, total = [], 0
    for part, n in totals:
        starts.append((part, total))
        total += n
    offsets = spark.createDataFrame(starts, "part int, offset long")
    # one row per written partition: bounded by the cluster's shuffle width, not by the data
    return segments.join(F.broadcast(offsets), "part").withColumn("start", F.col("offset") + F.col("before"))


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for doc_ids, start, body in zip(batch["doc_ids"], batch["start"], batch["body"], strict=True):
                segment = DacSegment(body)
                data = segment.tokens().astype("<u4")
                begins = np.concatenate([[0], segment.ends[:-1]]).astype(np.int64)
                yield pd.DataFrame({
                    "doc_id": pd.array([None if x is None or x != x else int(x) for x in doc_ids], dtype="Int64"),
                    "start": begins + int(start),
                    "n_tokens": segment.ends - begins,
                    "ids_crc32": [zlib.crc32(data[b:e].tobytes()) for b, e in zip(begins, segment.ends, strict=True)],
                })

    one_by_one = read_segments(spark, folder).select("doc_ids", "start", "body")
    return one_by_one.mapInPandas(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_documents(docs: DataFrame, tokenizer_path: str, segment_tokens: int = SEGMENT_TOKENS) -> DataFrame:
    """Write `docs` to segment files in the shared folder and read them back per document."""
    folder = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, folder, tokenizer_path, segment_tokens)
    return read_documents(docs.sparkSession, folder)


def op1_token_dac(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of the whole documents table, read back per document."""
    import public_tokenizers

    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
