"""op5 against a dictionary of all windows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cartwheel.llm import suffix
from tests.llm.conftest import AWKWARD, TINY


def removed(raws, length):
    seen = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 1, dtype=np.int64)
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = 1
        out.append(gone[:-1].astype(bool))
    return out


def expected(rows, length):
    raws = [(t or "").encode() for _, t in rows]
    out = []
    for (i, _), r, gone in zip(rows, raws, removed(raws, length), strict=True):
        kept = np.frombuffer(r, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        out.append((i, len(r), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="ab", min_size=1, max_size=60), min_size=1, max_size=5), st.sampled_from([3, 5, 8, 11]))
def test_repeated_windows(texts, length):
    raws = [t.encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    want = [[i for i in range(len(r) - length + 1) if seen[r[i:i + length]] > 1] for r in raws]
    assert [x.tolist() for x in suffix.repeated_windows(raws, length)] == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abc", max_size=120), min_size=1, max_size=4))
def test_equal_windows_have_equal_keys(texts):
    raws = [t.encode() for t in texts]
    text, v, s0, s1, twice = suffix.runs(raws, 40, 8)
    key = {}
    for t, k, a, b in zip(text.tolist(), v.tolist(), s0.tolist(), s1.tolist(), strict=True):
        for s in range(a, b):
            key[t, s] = k
    assert sorted(key) == [(t, s) for t, r in enumerate(raws) for s in range(len(r) - 39)]
    of = {}
    for (t, s), k in key.items():
        assert of.setdefault(raws[t][s:s + 40], k) == k
    for t, k, a, b, two in zip(text.tolist(), v.tolist(), s0.tolist(), s1.tolist(), twice.tolist(), strict=True):
        h = suffix.gram_hashes(np.frombuffer(raws[t], np.uint8), 8).view(np.int64)[a:b - 1 + 33]
        assert two == ((h == k).sum() > 1)


def test_op5(spark, texts):
    found = suffix.op5_suffix_dedup(spark, TINY).collect()
    assert all(r.has_repeat == (r.n_removed > 0) for r in found)
    got = sorted(tuple(r)[:5] for r in found)
    assert got == sorted(expected(sorted(texts.items()), 400))


@pytest.mark.parametrize("most", [suffix.MOST, 100])
def test_shared_passages(spark, most):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgé") for _ in range(rng.randrange(2, 8)))
    passages = [" ".join(word() for _ in range(n)) for n in (30, 40, 80)]
    rows = []
    for i in range(80):
        parts = [" ".join(word() for _ in range(rng.randrange(40)))]
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            parts += [p[rng.randrange(30):len(p) - rng.randrange(30)], word()]
        rows.append((i, " ".join(parts)))
    rows += [(100, "ab" * 400), (101, "x" * 300), (102, rows[0][1]), (103, passages[2] * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, suffix.deduplicate(docs, 100, digest=True, most=most).collect()))
    assert got == sorted(expected(rows, 100))


def test_awkward(awkward, nothing):
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    got = sorted(map(tuple, suffix.deduplicate(awkward, 20, digest=True).collect()), key=key)
    assert got == sorted(expected(AWKWARD, 20), key=key)
    whole = suffix.deduplicate(awkward, 20).collect()
    assert len(whole) == len(AWKWARD) and set(whole[0].asDict()) == set(awkward.columns)
    assert {r.text for r in whole if r.doc_id == 1} == {None} and {r.text for r in whole if r.doc_id == 9} == {""}
    assert suffix.deduplicate(nothing, digest=True).count() == 0
