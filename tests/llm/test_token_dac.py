import os
import sys
import tracemalloc
import types
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chirpstat.llm import token_dac as td
from chirpstat.llm.common import release_memory

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1500))
@settings(max_examples=40, deadline=None)
def test_segment_round_trip_and_random_access(ids):
    tokens = np.array(ids, np.uint32)
    ends = np.array([len(ids)])
    segment = td.DacSegment(td.dac_encode(tokens, ends))
    assert (segment.tokens() == tokens).all() and segment.n_tokens == len(ids)
    assert [segment.token(i) for i in range(0, len(ids), 7)] == ids[::7]


def test_not_a_segment():
    with pytest.raises(ValueError):
        td.DacSegment(b"nope" + bytes(40))


TEXTS = [
    "a  b", "\n a b", " a", " ", "a \n", "x<|endoftext|> y <|endoftext|>z", "", "it's 'll a\n\nb c\td", "a b　c d", "a  b",
    "é 12 3a", "a b\x1c c", "ab.,.. cd... ,, ef,", "日本 語", "Wort!! WORT!! don't we'll\nThe *** end.", "l'été ou À-b", "a_b _c d_",
]


def test_units_give_the_tokenizers_ids():
    encoder = td.TextEncoder(PATH, entries=5)  # a table that is emptied again and again
    for text in [*TEXTS, " ".join(TEXTS * 3), None]:
        want = encoder._tokenizer.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want, text


def _expected(rows):
    encoder = td.TextEncoder(PATH)
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*encoder._tokenizer.encode(text or "", add_special_tokens=False).ids, td.END_ID]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("segment_tokens", [50, 1_000_000])
def test_odd_documents(odd_docs, odd_rows, segment_tokens):
    got = [tuple(r) for r in td.encode_documents(odd_docs, PATH, segment_tokens).collect()]
    assert sorted(got, key=lambda r: r[1]) == _expected([r[:2] for r in odd_rows])


def test_no_documents(no_docs):
    assert td.encode_documents(no_docs, PATH).collect() == []


def test_real_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = sorted((tuple(r) for r in td.encode_documents(docs, PATH, 5000).collect()), key=lambda r: r[1])
    assert got == _expected([(r.doc_id, r.text) for r in docs.collect()])


class _Asked:
    """A tokenizer that counts the characters it is asked to encode."""

    def __init__(self, tokenizer):
        self._of, self.n = tokenizer, 0

    def __getattr__(self, name):
        return getattr(self._of, name)

    def encode(self, text, **how):
        self.n += len(text)
        return self._of.encode(text, **how)

    def encode_batch_fast(self, texts, **how):
        self.n += sum(map(len, texts))
        return self._of.encode_batch_fast(texts, **how)


def test_paragraphs_and_indents_cost_no_second_encoding():
    encoder = td.TextEncoder(PATH)
    tokenizer = encoder._tokenizer
    encoder._tokenizer = _Asked(tokenizer)
    text = "Vier Wörter, no more...\n\n    x = y;\tend\r\n  Vier.\n" * 40
    for lead in ["", "x", "\n\n", "  no"]:
        assert np.frombuffer(encoder.encode(lead + text), "<u4").tolist() == tokenizer.encode(lead + text, add_special_tokens=False).ids
    assert encoder._tokenizer.n < len(text)


ATOMS = [*" \n\t\r'.,-!|<>()0aZé\x1c\x85\xa0  　᠎​²…́", "\n\n", "  ", " the", "'ll", "日本", "<|endoftext|>", "😀"]


_SMALL = {}


@given(st.lists(st.lists(st.sampled_from(ATOMS), max_size=25).map("".join) | st.none(), max_size=12))
@settings(max_examples=150, deadline=None)
def test_texts_together_give_the_tokenizers_ids(texts):
    small = _SMALL.setdefault(0, td.TextEncoder(PATH, entries=20))
    ids, ends = small.encode_texts(pa.array(texts, pa.string()))
    want = [small._tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [p.tolist() for p in np.split(ids, ends)] == [*want, []]
    assert len(small._units) <= 30  # the table is bounded


def test_a_workers_tasks_share_the_table_of_units():
    first = td._encoder(PATH)
    first.encode_texts(pa.array(["nowhereelse words"]))
    again = td._encoder(PATH)
    again._tokenizer = _Asked(tokenizer := again._tokenizer)
    again.encode_texts(pa.array(["words nowhereelse words", "nowhereelse"]))
    assert again._tokenizer.n <= len("\nwords nowhereelse")
    again._tokenizer = tokenizer


def test_slices_hold_every_row_once():
    rows = pa.RecordBatch.from_pydict({"doc_id": list(range(7)), "text": ["a" * 9, None, "", "é" * 5, "b", "c" * 50, "d"]})
    parts = list(td._slices(rows, 10))
    assert [p["doc_id"].to_pylist() for p in parts] == [[0, 1, 2], [3], [4], [5], [6]]
    assert list(td._slices(rows.slice(0, 0), 10)) == []


@pytest.mark.parametrize("cut_bytes", [1, 9, 60])
def test_texts_cut_in_parts_give_the_tokenizers_ids(monkeypatch, cut_bytes):
    monkeypatch.setattr(td, "CUT_BYTES", cut_bytes)
    encoder = td.TextEncoder(PATH, entries=5)
    texts = [None, "", *TEXTS, *TEXTS, "", None]
    parts = list(encoder.encode_parts(pa.array(texts, pa.string())))
    assert len(parts) > 2
    got = [p.tolist() for ids, ends in parts for p in np.split(ids, ends)[:-1]]
    assert got == [encoder._tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert list(encoder.encode_parts(pa.array([], pa.string()))) == []
    assert all(not len(ids) for ids, _ in encoder.encode_parts(pa.array([None, ""], pa.string())))


def test_encoding_needs_few_bytes_for_a_byte_of_text():
    encoder = td.TextEncoder(PATH)
    text = "Vier Wörter, no more...\n\n    x = y;\tend\r\n  Vier.\n" * 100
    texts = pa.array([text] * 2_000)
    encoder.encode_texts(texts[:1])
    tracemalloc.start()
    try:
        before, n, held = pa.total_allocated_bytes(), 0, 0
        for _, ends in encoder.encode_parts(texts):
            n, held = n + len(ends), max(held, pa.total_allocated_bytes() - before)
        assert n == len(texts)
        assert tracemalloc.get_traced_memory()[1] + held < 5 * texts.nbytes
    finally:
        tracemalloc.stop()


def _resident():
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
def test_freed_memory_goes_back_to_the_system():
    release_memory()
    held = [bytes(b"x" * 50_000) for _ in range(3_000)]
    full = _resident()
    held = held[::100]
    release_memory()
    assert len(held) == 30 and full - _resident() > 100_000_000


def test_a_task_releases_memory_before_and_after(monkeypatch):
    from pyspark import TaskContext

    monkeypatch.setattr(TaskContext, "get", classmethod(lambda cls: types.SimpleNamespace(partitionId=lambda: 3)))
    calls = []
    monkeypatch.setattr(td, "release_memory", lambda: calls.append(len(calls)))
    rows = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["a b", None]})
    out = td._segments(PATH, 1_000_000)(iter([rows]))
    segment = next(out)
    before = len(calls)
    assert segment["doc_ids"].to_pylist() == [[1, 2]] and before >= 2
    assert list(out) == [] and len(calls) == before + 1
