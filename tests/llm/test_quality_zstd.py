import numpy as np
import pytest
from pyspark.sql import functions as F

from chirpstat.llm import quality_zstd as qz

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    got = qz.op8_quality_zstd(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").toPandas()
    held = got[got.held_out]
    assert got.score.between(0, 1).all() and ((got.score >= qz.THRESHOLD) == (got.predicted == 1)).all()
    good, bad = held[held.quality == 1].score.to_numpy(), held[held.quality == 0].score.to_numpy()
    area = np.mean([(good > b).mean() + (good == b).mean() / 2 for b in bad])
    assert area > 0.95 and (good >= qz.THRESHOLD).mean() > 0.98 and (held.predicted == held.quality).mean() > 0.93
    # calibrated: the mean score is near the share of good documents
    assert abs(held.score.mean() - held.quality.mean()) < 0.05


def test_difference_covers_the_whole_text():
    good, bad = b"the quick brown fox jumps over the lazy dog. " * 60, b"*** BUY!! NOW!! $$$ " * 60
    text = "the quick brown fox " * 400 + "*** BUY!! NOW!! $$$ " * 400
    whole = qz.difference(text, good, bad)
    first = qz.difference(text[: len(text) // 2], good, bad)
    assert first > whole and qz.difference("", good, bad) == qz.difference(None, good, bad) == 0


def test_logistic_fit():
    draw = np.random.default_rng(1)
    x = draw.normal(size=4000)
    y = (draw.random(4000) < 1 / (1 + np.exp(-(2 * x - 1)))).astype(float)
    slope, offset = qz.fit_logistic(x, y)
    assert abs(slope - 2) < 0.25 and abs(offset + 1) < 0.2


def test_sample_is_bounded_and_apart(spark):
    labelled = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 3 == 0).cast("int").alias("label"))
    ids = qz.sample_ids(labelled, F.col("doc_id") % 2 == 0, qz.Sample(100, 150)).collect()
    assert len(ids) == 350 and len({r.doc_id for r in ids}) == 350
    assert all(r.calibration == (r.doc_id % 2 == 0) for r in ids)


def test_pieces_come_from_all_of_the_texts(spark):
    """A bound on bytes, not a prefix: with it reached, pieces of every long text and of all its parts are drawn."""
    texts = [(d, d % 2, "".join(f"{d:03d}:{k:06d} " * 93 for k in range(200))) for d in range(6)]
    frame = spark.createDataFrame(texts, "doc_id long, label int, text string")
    drawn = [(r.label, bytes(r.piece)) for r in qz.sample_pieces(frame, 400 * qz.PIECE_BYTES).collect()]
    assert sorted(label for label, _ in drawn) == [0] * 200 + [1] * 200 and all(len(p) <= qz.PIECE_BYTES for _, p in drawn)
    assert {p[15:18] for _, p in drawn} <= {p[15:18] for t in texts for p in qz.pieces(t[2].encode())}
    places = {(d, at * 4 // len(qz.pieces(t.encode()))) for d, _, t in texts for at, p in enumerate(qz.pieces(t.encode())) if (d % 2, p) in set(drawn)}
    assert len(places) == 24


def test_query_equals_brute_force(spark, tmp_path):
    """The score of every document by plain loops: drawn pieces, dictionaries, sizes, curve."""
    import hashlib
    import math
    import zlib

    import zstandard

    docs = [(i, ("fine words of a calm story number %d. " % i if i % 3 else "BUY!! NOW!! $$$ %d " % i) * (1 + i % 90), "en", "s") for i in range(300)]
    labels = [(i, int(i % 3 > 0), 0) for i in range(0, 300)]
    got = {r.doc_id: r for r in qz.op8_quality_zstd(spark, _tables(spark, tmp_path, docs, labels)).collect()}

    def rest(i):
        return zlib.crc32(str(i).encode()) % 5

    cuts = {label: [] for label in (0, 1)}
    for i, text, _, _ in docs:
        if rest(i) not in (0, 1):
            data = text.encode()
            cuts[int(i % 3 > 0)] += [(hashlib.md5(f"{i}:{k}".encode()).hexdigest(), data[o : o + 1024]) for k, o in enumerate(range(0, len(data), 1024))]
    made = {label: zstandard.train_dictionary(qz.DICT_BYTES, sorted(p for _, p in cuts[label])).as_bytes() for label in cuts}

    def measure(text):
        sizes = []
        for label in (0, 1):
            c = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(made[label]), write_content_size=False, write_checksum=False, write_dict_id=False)
            sizes.append(sum(len(c.compress(text.encode()[o : o + 1024])) for o in range(0, len(text), 1024)))
        return (sizes[0] - sizes[1]) / len(text)

    pairs = [(measure(t), int(i % 3 > 0)) for i, t, _, _ in docs if rest(i) == 1]
    slope, offset = qz.fit_logistic(np.array([x for x, _ in pairs]), np.array([y for _, y in pairs], float))
    for i, text, _, _ in docs:
        want = 1 / (1 + math.exp(-max(-30.0, min(30.0, slope * measure(text) + offset))))
        assert abs(got[i].score - want) < 1e-6 and got[i].held_out == (rest(i) == 0) and got[i].predicted == int(want >= 0.3)


def test_nothing_to_learn():
    with pytest.raises(ValueError):
        qz.learn([(1, False, "only good")])


def test_odd_documents(odd_docs, no_docs):
    model = qz.learn([(1, False, "good words here"), (0, False, "BAD!! ***"), (1, True, "good words"), (0, True, "BAD!!")])
    got = qz.score_documents(odd_docs, model).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
    empty = {r.score for r in got if r.doc_id in (2, 3)}
    assert len(empty) == 1
    assert qz.score_documents(no_docs, model).collect() == []


def _tables(spark, path, documents, labels):
    spark.createDataFrame(documents, "doc_id long, text string, lang string, source string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 1, 0), (3, 0, 0)], [(1, None, None), (None, 1, 0)]])
def test_query_where_nothing_can_be_learned(spark, tmp_path, labels):
    """One label has no text, or no label is there: a constant score; null ids are not held out."""
    docs = [(1, "one text", "en", "a"), (2, "two texts", None, "a"), (3, None, "en", "a"), (None, "no id", "en", "a"), (None, None, None, None)]
    got = qz.op8_quality_zstd(spark, _tables(spark, tmp_path, docs, labels)).collect()
    share = 1.0 if len(labels) == 3 else 0.5  # the null text teaches nothing
    assert len(got) == 5 and all(abs(r.score - share) < 1e-6 and r.predicted == 1 for r in got)
    assert all(r.held_out is False for r in got if r.doc_id is None) and all(r.held_out is not None for r in got)


def test_query_on_empty_tables(spark, tmp_path):
    assert qz.op8_quality_zstd(spark, _tables(spark, tmp_path / "a", [], [])).collect() == []
    assert qz.op8_quality_zstd(spark, _tables(spark, tmp_path / "b", [], [(1, 1, 0)])).collect() == []
