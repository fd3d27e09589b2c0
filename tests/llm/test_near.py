"""op8 against all pairs by hand."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from cartwheel.llm import near
from cartwheel.llm.components import components
from tests.llm.conftest import AWKWARD, TINY


def shingles(text):
    w = (text or "").split()
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def classes(texts):
    """(number of class, links of the text) per row: all pairs, exact frequencies."""
    sets = [shingles(t) for t in texts]
    df = Counter(s for c in sets for s in c)
    n = max(2, len(texts))
    idf = {s: 1 + near.IDF_SPAN * math.log(n / df[s]) / math.log(n) for s in df}
    weight = [{s: (1 + math.log(k)) * idf[s] for s, k in c.items()} for c in sets]
    total = [sum(w.values()) for w in weight]
    words = [tuple((t or "").split()) for t in texts]
    firsts = list({w: i for i, w in reversed(list(enumerate(words)))}.values())
    root = list(range(len(texts)))
    by = defaultdict(list)
    for i in firsts:
        for s in weight[i]:
            by[s].append(i)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in firsts:
        common = Counter()
        for s, w in weight[i].items():
            for j in by[s]:
                if j < i:
                    common[j] += min(w, weight[j][s])
        for j, c in common.items():
            if c / (total[i] + total[j] - c) >= 0.8:
                root[find(i)] = find(j)
    first = {words[i]: i for i in firsts}
    return [find(first[w]) for w in words]


def partition(keys, labels):
    by = defaultdict(set)
    for k, c in zip(keys, labels, strict=True):
        by[c].add(k)
    return sorted(map(sorted, by.values()))


def test_op8(spark, texts):
    rows = near.op8_near_duplicates(spark, TINY).collect()
    ids = sorted(texts)
    want = partition(ids, classes([texts[i] for i in ids]))
    got = partition([r.doc_id for r in rows], [r.class_id for r in rows])
    assert got == want
    sizes = {i: len(c) for c in want for i in c}
    assert all(r.class_size == sizes[r.doc_id] and r.class_id == min(next(c for c in want if r.doc_id in c)) for r in rows)


def test_large_group_of_edited_copies(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [rng.choice(vocabulary) for _ in range(140)]
    rows = []
    for i in range(300):
        w = list(base)
        for _ in range(rng.randrange(7)):
            w[rng.randrange(len(w))] += "x" * rng.randrange(1, 4)
        if i % 10 == 0:
            w = w[:rng.randrange(100, 140)]
        rows.append((i, " ".join(w)))
    rows += [(300 + i, " ".join(rng.choice(vocabulary) for _ in range(120))) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in near.near_duplicates(docs).collect()}
    want = partition(range(350), classes([t for _, t in rows]))
    assert partition(got, [r.class_id for r in got.values()]) == want
    assert any(len(c) > 100 for c in want)


@pytest.mark.parametrize("block", [256, 16])
def test_dense_cloud_below_the_similarity(spark, monkeypatch, block):
    """Copies with so many edits that most are less than 0.8 alike: no link is lost, and only blocks are joined."""
    monkeypatch.setattr(near, "BLOCK", block)
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [rng.choice(vocabulary) for _ in range(110)]
    pool = [rng.choice(vocabulary) for _ in range(12)]
    rows = []
    for i in range(500):
        w = list(base)
        for _ in range(3):
            w[rng.randrange(4) * 25 + rng.randrange(3)] = rng.choice(pool)
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    joined = []
    pairs = near._block_pairs
    monkeypatch.setattr(near, "_block_pairs", lambda left: joined.append((left.count(), pairs(left).count())) or pairs(left))
    got = {r.doc_id: r for r in near.near_duplicates(docs).collect()}
    assert partition(got, [r.class_id for r in got.values()]) == partition(range(500), classes([t for _, t in rows]))
    ((members, rows_joined),) = joined
    assert rows_joined <= members if block == 256 else rows_joined <= members * (500 // block + 2)


def test_codes_have_no_end():
    df = np.array([1, 2, 128, 129, 1000, 7_700_000, 10 ** 9, 10 ** 12, 2 ** 62])
    codes = near.code_of(df)
    assert (np.diff(codes.astype(int)) >= 0).all() and codes[-1] > codes[-2] > codes[-3] > codes[-4]
    assert np.abs(np.log2(near._decoded()[codes] / df)).max() <= 0.5 / near.STEPS + 1e-9
    assert near.TF_WEIGHT.dtype == np.float64
    idf = near.idf_table(10 ** 12)
    assert idf[near.code_of(np.array([10 ** 12]))[0]] < idf[near.code_of(np.array([10 ** 8]))[0]] < idf[1]


def test_awkward(spark, awkward, nothing):
    rows = near.near_duplicates(awkward).collect()
    assert len(rows) == len(AWKWARD)
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[2].class_id == by[3].class_id == 1 and by[1].class_size == 4  # null, empty, blank, null without id
    assert by[4].class_id == by[5].class_id == 4
    assert [r.class_size for r in rows if r.doc_id == 9] == [2, 2]
    assert [r.class_id for r in rows if r.doc_id is None] .count(None) == 1
    assert near.near_duplicates(nothing).count() == 0


def test_samples_estimate_weighted_jaccard():
    rng = np.random.default_rng(0)
    h = rng.integers(1, 2**63, 300, dtype=np.uint64)
    wa, wb = rng.uniform(1, 3, 300), rng.uniform(1, 3, 300)
    a, b = near.samples(h[:250], wa[:250], 2000), near.samples(h[50:], wb[50:], 2000)
    x, y = np.append(wa[:250], np.zeros(50)), np.append(np.zeros(50), wb[50:])
    assert abs((a == b).mean() - np.minimum(x, y).sum() / np.maximum(x, y).sum()) < 0.035


def test_components_along_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 102), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100, 102: 100}
