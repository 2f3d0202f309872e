import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from chirpstat.llm import jaccard_join as jj


def brute(docs, threshold=0.8):
    """doc -> (class, links), by counting the shared word runs of all pairs."""
    sets = {}
    for d, t in docs:
        w = jj._WORD.findall(t or "")
        sets[d] = frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
    holders, common, links = defaultdict(list), Counter(), Counter()
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    for own in holders.values():
        for i, a in enumerate(own):
            for b in own[i + 1 :]:
                common[a, b] += 1
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), c in common.items():
        if c / (len(sets[a]) + len(sets[b]) - c) >= threshold - 1e-12:
            links[a] += 1
            links[b] += 1
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {d: (find(d), links[d]) for d in sets}


@pytest.fixture(scope="module")
def near_copies():
    draw = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    base = [draw.choice(words) for _ in range(120)]
    docs = [(5000, None), (5001, ""), (5002, "a b"), (5003, "a b"), (5004, "a  b c"), (5005, " \n")]
    for i in range(250):  # a large group of near copies
        own = base[:]
        for _ in range(draw.randint(0, 4)):
            own[draw.randrange(120)] = draw.choice(words)
        docs.append((6000 + i, " ".join(own)))
    for i in range(250):  # a passage that many share
        docs.append((7000 + i, " ".join(base[:30] + [draw.choice(words) for _ in range(60)])))
    for i in range(300):  # pairs of any similarity
        own = [draw.choice(words) for _ in range(draw.randint(5, 90))]
        docs.append((8000 + 2 * i, " ".join(own)))
        for _ in range(draw.randint(0, 3)):
            own[draw.randrange(len(own))] = "x"
        docs.append((8001 + 2 * i, " ".join(own)))
    return docs


@pytest.mark.parametrize("join", [jj.Join(), jj.Join(bucket_rows=20, block_rows=30, depth=3)])
def test_classes_and_links_equal_brute_force(spark, near_copies, join):
    want = brute(near_copies)
    frame = spark.createDataFrame(near_copies, "doc_id long, text string").repartition(6)
    got = {r.doc_id: (r.class_id, r.n_links) for r in jj.classes(frame, join).collect()}
    assert got == want


def test_exact_links_brute_force():
    draw = random.Random(9)
    for _ in range(40):
        sets = [np.array(sorted(draw.sample(range(30), draw.randint(0, 25))), np.uint64) for _ in range(draw.randint(2, 12))]
        got = jj.exact_links(sets, 0.6)
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                a_, b_ = set(a.tolist()), set(b.tolist())
                assert got[i, j] == (i != j and bool(a_ and b_) and len(a_ & b_) / len(a_ | b_) >= 0.6 - 1e-12)
        across = jj.exact_links(sets, 0.6, 1)
        assert not across[:1, :1].any() and not across[1:, 1:].any() and (across[0] == got[0]).all()


def test_runs_reach_the_recall():
    join = jj.Join(threshold=0.8, recall=0.999)
    assert 1 - (1 - 0.8) ** join.runs >= 0.999 > 1 - (1 - 0.8) ** (join.runs - 1)


def test_sketch_agreement_estimates_similarity():
    draw = random.Random(1)
    one = [str(draw.random()) for _ in range(400)]
    two = one[:380] + [str(draw.random()) for _ in range(20)]
    a, b = (jj.shingles(" ".join(x), jj.word_hashes()) for x in (one, two))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((jj.sketch(a) == jj.sketch(b)).mean() - true) < 0.15


def test_odd_documents(odd_docs, no_docs, odd_rows):
    got = jj.classes(odd_docs).collect()
    assert len(got) == len(odd_rows)
    by_id = defaultdict(list)
    for r in got:
        by_id[r.doc_id].append(r)
    assert all(r.n_links == 0 and r.class_id == r.doc for i in (2, 3, 4, 7, 10) for r in by_id[i])
    assert by_id[8][0].n_links == 1 and by_id[8][0].class_id == by_id[9][0].class_id
    base = odd_rows[0][1]
    same = sum(r[1] == base for r in odd_rows) + 1  # and one with a word more
    links = {r.n_links for r in by_id[6]}
    assert links == {same - 1}
    one = jj.one_of_each(odd_docs)
    assert one.columns == odd_docs.columns
    assert one.count() == len({(r.class_id) for r in got})
    assert jj.classes(no_docs).collect() == [] and jj.one_of_each(no_docs).collect() == []


def test_recall_holds_in_buckets_that_stay_large(spark):
    """Pairs at the threshold among thousands of rows that agree at a quarter of all places, in buckets split down to the greatest depth."""
    draw = np.random.default_rng(7)
    n = 2000
    one = draw.integers(0, 4, (n, jj.SKETCH))
    other = np.where(draw.random(one.shape) < 0.2, (one + draw.integers(1, 4, one.shape)) % 4, one)
    pairs = (one == other).sum(1) >= jj.Join().sketch_agreement
    assert abs((one == other).mean() - 0.8) < 0.01 and pairs.mean() > 0.999
    marks = np.concatenate([one, other])
    rows = [(i, m[:16].tolist(), m.astype("<u2").tobytes()) for i, m in enumerate(marks)]
    reps = spark.createDataFrame(rows, "rep long, places array<int>, sketch binary").repartition(4)
    group = np.arange(2 * n)
    stars = np.array([tuple(r) for r in jj.candidate_edges(reps, jj.Join(bucket_rows=8)).distinct().collect()])
    while True:  # the smallest member of every group
        new = group.copy()
        np.minimum.at(new, stars[:, 0], group[stars[:, 1]])
        np.minimum.at(new, stars[:, 1], group[stars[:, 0]])
        if (new == group).all():
            break
        group = new
    lost = int((group[:n] != group[n:])[pairs].sum())
    assert lost <= 2  # 0.2 are expected


@pytest.mark.parametrize("join", [jj.Join(), jj.Join(threshold=0.9), jj.Join(threshold=0.5), jj.Join(depth=3), jj.Join(depth=1)])
def test_splits_keep_the_recall_at_full_depth(join):
    runs, widths = join.splits
    assert runs >= join.runs and len(widths) == join.depth - 1 and max(widths, default=0) <= jj.WIDEST
    assert join.missed(runs, widths) <= 1 - join.recall


def test_classes_are_named_by_their_smallest_id(spark):
    near = " ".join(f"w{k}" for k in range(60))
    rows = [(9, near), (4, near + " tail"), (None, near), (None, "alone of null id"), (None, ""), (7, "one text"), (7, "another text"), (5, "plain"), (5, "plain")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.class_id, r.n_links) for r in jj.named(jj.classes(frame)).collect()]
    assert {x for x in got if x[1] == 4} == {(9, 4, 2), (4, 4, 2), (None, 4, 2)}
    assert [x for x in got if x[0] == 5] == [(5, 5, 1)] * 2
    sevens, nulls = [x[1] for x in got if x[0] == 7], [x[1] for x in got if x[0] is None and x[1] != 4]
    assert len(set(sevens)) == 2 and max(sevens) == 7 and min(sevens) < 0
    assert len(set(nulls)) == 2 and all(c < 0 for c in nulls) and len(got) == len(rows)
    unique = frame.where("doc_id IN (4, 9)")
    assert {(r.doc_id, r.class_id) for r in jj.named(jj.classes(unique)).collect()} == {(4, 4), (9, 4)}
    assert jj.named(jj.classes(frame.limit(0))).collect() == []
