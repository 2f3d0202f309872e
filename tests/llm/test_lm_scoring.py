import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from chirpstat.llm import lm_scoring as lm


def test_gradients_by_finite_differences():
    draw = np.random.default_rng(3)
    counts = draw.integers(1, 9, lm.CLASSES).astype(float)
    net = lm.Network.start(counts, 1)
    context, target = draw.integers(0, lm.CLASSES + 1, (6, 2 * lm.SIDE)), draw.integers(0, lm.CLASSES, 6)
    before = net.log_prob(context, target).sum()
    squares = lm.Network(np.zeros(lm.Network.SIZE, np.float32))
    net.train(context, target, squares, 0.01)
    assert net.log_prob(context, target).sum() > before


def test_gradients_equal_finite_differences():
    draw = np.random.default_rng(4)
    net = lm.Network(draw.normal(0, 0.5, lm.Network.SIZE))  # 64-bit numbers
    context, target = draw.integers(0, lm.CLASSES + 1, (40, 2 * lm.SIDE)), draw.integers(0, lm.CLASSES, 40)
    gradients, met = net.gradients(context, target)
    assert [m.tolist() for m in met] == [sorted(set(context[:, k].tolist())) for k in range(2 * lm.SIDE)]
    most = np.argsort(-np.abs(gradients.flat))[:60]
    for i in [*most.tolist(), *draw.integers(0, lm.Network.SIZE, 60).tolist()]:
        sides = []
        for step in (1e-5, -1e-5):
            moved = net.flat.copy()
            moved[i] += step
            sides.append(-lm.Network(moved).log_prob(context, target).mean())
        assert abs((sides[0] - sides[1]) / 2e-5 - gradients.flat[i]) < 1e-7


def test_large_logits_do_not_overflow():
    draw = np.random.default_rng(6)
    flat = draw.normal(0, 300, lm.Network.SIZE).astype(np.float32)
    context, target = draw.integers(0, lm.CLASSES + 1, (50, 2 * lm.SIDE)), draw.integers(0, lm.CLASSES, 50)
    got = lm.Network(flat).log_prob(context, target)
    assert np.allclose(got, lm.Network(flat.astype(float)).log_prob(context, target), rtol=1e-3)
    assert np.isfinite(got).all() and np.isfinite(lm.Network(flat).gradients(context, target)[0].flat).all()


def test_probabilities_sum_to_one():
    net = lm.Network.start(np.ones(lm.CLASSES), 5)
    context = np.tile(np.arange(2 * lm.SIDE), (lm.CLASSES, 1))
    assert abs(np.exp(net.log_prob(context, np.arange(lm.CLASSES))).sum() - 1) < 1e-3


def test_windows_stay_in_their_text():
    context, target, lens = lm.windows([np.array([1, 2, 3]), np.zeros(0, np.int64), np.array([4])])
    p = lm.PAD
    assert target.tolist() == [1, 2, 3, 4] and lens.tolist() == [3, 0, 1]
    assert context.tolist() == [[p, p, 2, 3], [p, 1, 3, p], [1, 2, p, p], [p, p, p, p]]


def test_counts_cover_the_corpus(spark):
    docs = spark.createDataFrame([(1, "A a b"), (2, None), (3, "c  a\nb")], "doc_id long, text string").repartition(3)
    vocabulary, counts = lm.count_classes(docs)
    assert vocabulary == {"a": 0, "b": 1, "c": 2} and counts[:3].tolist() == [3, 2, 1] and counts.sum() == 6


def test_natural_order_scores_above_shuffled_and_unigrams(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").repartition(4)
    train, held = docs.where("doc_id % 10 <> 0"), docs.where("doc_id % 10 = 0")
    vocabulary, flat = lm.learn(train)
    draw = random.Random(1)
    mixed = [(r.doc_id, " ".join(draw.sample(w, len(w)))) for r in held.collect() for w in [lm.words_of(r.text)]]

    def mean(frame, parameters):
        row = lm.score_documents(frame, vocabulary, parameters).agg(F.sum("log_prob") / F.sum("n_words")).first()
        return row[0]

    start = lm.Network.start(lm.count_classes(train)[1], lm.Training.seed).flat
    trained = mean(held, flat)
    assert trained > mean(held, start) + 0.05
    assert trained > mean(spark.createDataFrame(mixed, "doc_id long, text string"), flat) + 0.02


def test_odd_documents(odd_docs, no_docs, odd_rows):
    vocabulary, flat = lm.learn(odd_docs)
    got = lm.score_documents(odd_docs, vocabulary, flat).collect()
    assert len(got) == len(odd_rows)
    for r in got:
        assert r.log_prob <= 0 and (r.n_words == 0) == (r.mean_log_prob is None) == (r.log_prob == 0)
    vocabulary, flat = lm.learn(no_docs)
    assert vocabulary == {} and lm.score_documents(no_docs, vocabulary, flat).collect() == []


def test_words_outside_the_vocabulary_have_their_share(spark, odd_docs, no_docs):
    words = [f"w{i}" for i in range(lm.VOCABULARY + 400)]
    often = {w: 3 if i < lm.VOCABULARY else 1 + i % 2 for i, w in enumerate(words)}
    docs = spark.createDataFrame([(i, " ".join([w] * often[w])) for i, w in enumerate(words)], "doc_id long, text string")
    counted = lm.count_words(docs)
    vocabulary, counts = lm.count_classes(docs, counted)
    flat = lm.Network.start(counts, 1).flat
    rare = [w for w in words if w not in vocabulary]
    assert len(rare) == 400 and {r.word: r.n for r in counted.collect()} == often
    texts = [rare[0], f"{rare[1]} {words[0]} {rare[1]}", words[1], f"{rare[2]} never seen", "", None, rare[0]]
    held = spark.createDataFrame([(7, t) for t in texts], "doc_id long, text string").coalesce(1)
    whole = [r.log_prob for r in lm.score_documents(held, vocabulary, flat).collect()]
    got = lm.score_documents(held, vocabulary, flat, counted).collect()
    total = {b: sum(often[w] for w in rare if lm._bucket(w) == b) for b in range(lm.BUCKETS)}
    want = [p + sum(np.log(often.get(w, 1) / (total[lm._bucket(w)] + 1)) for w in lm.words_of(t) if w not in vocabulary) for p, t in zip(whole, texts, strict=True)]
    assert np.allclose(sorted(r.log_prob for r in got), sorted(want)) and min(want) < min(whole)
    for r in got:
        assert r.mean_log_prob == (r.log_prob / r.n_words if r.n_words else None)
    counted = lm.count_words(odd_docs)
    assert lm.score_documents(odd_docs, *lm.learn(odd_docs, counted=counted), counted).count() == odd_docs.count()
    counted = lm.count_words(no_docs)
    assert lm.score_documents(no_docs, *lm.learn(no_docs, counted=counted), counted).collect() == []


def test_network_has_24_hidden_units():
    net = lm.Network(np.zeros(lm.Network.SIZE, np.float32))
    assert net.embed.shape[-1] == net.bias.shape[0] == 24


def _by_loops(text, vocabulary, net, counts):
    """Log-probability of a text, word by word, with plain loops."""
    words = lm.words_of(text)
    of = [vocabulary[w] if w in vocabulary else lm.VOCABULARY + lm._bucket(w) for w in words]
    total = 0.0
    for i, (word, target) in enumerate(zip(words, of, strict=True)):
        around = [of[j] if 0 <= j < len(of) else lm.PAD for j in (*range(i - lm.SIDE, i), *range(i + 1, i + lm.SIDE + 1))]
        h = [np.tanh(net.bias[u] + sum(net.embed[k][c][u] for k, c in enumerate(around))) for u in range(lm.HIDDEN)] + [1.0]
        for weights, own in ((net.group, target // lm.MEMBERS), (net.member[target // lm.MEMBERS], target % lm.MEMBERS)):
            logits = [sum(h[u] * weights[u][o] for u in range(lm.HIDDEN + 1)) for o in range(weights.shape[1])]
            total += logits[own] - np.log(sum(np.exp(x) for x in logits))
        if word not in vocabulary:
            shared = sum(n for w, n in counts.items() if w not in vocabulary and lm._bucket(w) == lm._bucket(word))
            total += np.log(counts.get(word, 1) / (shared + 1))
    return total


@pytest.mark.parametrize("common", [lm.COMMON, 40, 0])
def test_scores_equal_plain_loops(spark, common):
    """Whatever share of the words is sent to the tasks, and for texts with unseen words."""
    draw = random.Random(9)
    words = [f"wört{i}" for i in range(1200)]
    texts = [" ".join(draw.choice(words[: draw.choice([5, 50, 1200])]) for _ in range(draw.randint(1, 30))) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    counts = Counter(w for t in texts for w in lm.words_of(t))
    counted = lm.count_words(docs)
    vocabulary, flat = lm.learn(docs, lm.Training(batch=64), counted)
    shares = lm.Shares.of(counted, vocabulary, common)
    others = {w for w in counts if w not in vocabulary}
    assert len(others) > 100 and len(shares.hashes) <= common
    assert {r.word: r.n for r in shares.rest.collect()}.items() <= {w: counts[w] for w in others}.items()
    if common == lm.COMMON:
        assert len(shares.hashes) == len(others) and shares.rest.isEmpty()
    held = [*texts[:12], "never seen wört3 before", "", None]
    net = lm.Network(flat.astype(float))
    frame = spark.createDataFrame(list(enumerate(held)), "doc_id long, text string")
    got = {r.doc_id: r for r in lm.score_documents(frame, vocabulary, flat, counted, common).collect()}
    for i, text in enumerate(held):
        assert got[i].n_words == len(lm.words_of(text))
        assert abs(got[i].log_prob - _by_loops(text, vocabulary, net, counts)) < 1e-3
