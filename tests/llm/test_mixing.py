import math
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chirpstat.llm import mixing as mx


@given(st.dictionaries(st.text(max_size=3), st.integers(1, 10**9), min_size=1, max_size=8), st.floats(1.0, 5.0))
@settings(max_examples=60, deadline=None)
def test_exponent_keeps_to_the_repetition_limit(tokens, limit):
    target = mx.Target(max_passes=limit)
    exponent = mx.solve_exponent(tokens, target)
    times = mx.passes(tokens, mx.tempered(tokens, exponent), None)
    assert max(times.values()) <= limit * (1 + 1e-6) and min(times.values()) >= 1 - 1e-9
    if exponent > 1e-6:  # a smaller one would repeat some source too often
        looser = mx.passes(tokens, mx.tempered(tokens, exponent * 0.99), None)
        assert max(looser.values()) >= limit * (1 - 1e-6)


def test_exponent_meets_the_entropy():
    tokens = {"a": 900, "b": 80, "c": 20}
    for wanted in (0.2, 0.5, 1.0):
        weights = mx.tempered(tokens, mx.solve_exponent(tokens, mx.Target(entropy=wanted)))
        assert abs(mx.entropy(weights) - wanted) < 1e-6
    assert mx.solve_exponent(tokens, mx.Target(entropy=2.0)) == 0.0


def _docs(spark):
    rows = [(i, "w " * (1 + i % 7), "big" if i % 3 == 0 else f"s{i % 4}") for i in range(600)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)


@pytest.mark.parametrize("block_tokens", [100, 10**9])
def test_plan_against_brute_force(spark, block_tokens):
    target = mx.Target(max_passes=2.5)
    rows = mx.plan(_docs(spark), target, block_tokens).collect()
    tokens = Counter()
    for r in rows:
        tokens[r.source] += r.n_tokens
    weights = mx.tempered(tokens, mx.solve_exponent(tokens, target))
    times = mx.passes(tokens, weights, None)
    blocks = defaultdict(list)
    for r in rows:
        assert abs(r.weight - weights[r.source]) < 1e-9 and r.copies >= 1
        blocks[r.source, r.block].append(r)
    assert {s: 1 + max(b for own, b in blocks if own == s) for s in tokens} == {s: max(1, math.ceil(n / block_tokens)) for s, n in tokens.items()} or block_tokens == 100
    for (source, _), own in blocks.items():
        part = times[source] - math.floor(times[source])
        total, running = sum(r.n_tokens for r in own), 0
        for r in sorted(own, key=lambda r: r.row_hash):
            running += r.n_tokens
            extra = part > 1e-9 and running - r.n_tokens / 2 <= part * total
            assert r.copies == math.floor(times[source]) + extra
    realised = Counter()
    for r in rows:
        realised[r.source] += r.copies * r.n_tokens
    for s in tokens:
        assert abs(realised[s] / sum(realised.values()) - weights[s]) < 0.02


def test_budget_of_half_the_corpus(spark):
    docs = _docs(spark)
    total = mx.plan(docs).agg(F.sum("n_tokens")).first()[0]
    half = mx.plan(docs, mx.Target(max_passes=None, entropy=1.2, budget_tokens=total // 2))
    assert abs(half.agg(F.sum(F.col("copies") * F.col("n_tokens"))).first()[0] - total / 2) < 40


def test_mixed_rows_are_the_plans(spark):
    docs = _docs(spark)
    plan = {r.doc_id: r.copies for r in mx.plan(docs).collect()}
    mixed = Counter(r.doc_id for r in mx.mix_documents(docs).collect())
    assert mixed == plan


def test_odd_documents(odd_docs, no_docs):
    mixed = mx.mix_documents(odd_docs)
    assert mixed.columns == odd_docs.columns and mixed.count() >= odd_docs.count()
    kept = {(r.doc_id, r.text, r.source) for r in mixed.collect()}
    assert kept == {(r.doc_id, r.text, r.source) for r in odd_docs.collect()}
    assert mx.plan(odd_docs).count() == odd_docs.count()
    assert mx.plan(no_docs).collect() == [] and mx.mix_documents(no_docs).collect() == []
    wordless = odd_docs.where("doc_id IN (2, 3, 4)")
    assert mx.mix_documents(wordless).count() == 3


def test_without_a_budget_every_source_passes_once():
    draw = random.Random(2)
    for _ in range(2000):
        tokens = {s: draw.randint(1, 10**6) for s in "abcd"[: draw.randint(1, 4)]}
        times = mx.passes(tokens, mx.tempered(tokens, draw.random()), None)
        assert min(times.values()) == 1.0


def test_texts_without_words_come_once_where_passes_round(spark):
    draw = random.Random(2)
    while True:  # a corpus of which the source that sets the budget would get less than one pass
        tokens = {s: draw.randint(1, 400) for s in "abc"}
        weights = mx.tempered(tokens, mx.solve_exponent(tokens, mx.Target()))
        budget = max(n / weights[s] for s, n in tokens.items())
        if min(weights[s] * budget / n for s, n in tokens.items()) < 1:
            break
    rows = [(i, text, s) for s, n in tokens.items() for i, text in enumerate(["w " * n, *[None, "", " "] * 20])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert mx.plan(docs).where("copies < 1").count() == 0
