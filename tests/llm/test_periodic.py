"""op11 against a plain search for runs, and grammar extensions against plain comparison."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pytest

from cartwheel.llm import periodic
from cartwheel.llm.recompress import Grammar
from tests.llm.conftest import AWKWARD, TINY


def plain_runs(words):
    """Every period, place by place."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        s = 0
        while s < n - q:
            if words[s] != words[s + q]:
                s += 1
                continue
            e = s
            while e < n - q and words[e] == words[e + q]:
                e += 1
            if e + q - s >= max(24, 3 * q):
                found.setdefault((s, e + q), q)
            s = e
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain(rows):
    out = []
    for i, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        n = len(words)
        h = zlib.crc32(str(i).encode())
        if i is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
        runs = plain_runs(words)
        from fractions import Fraction

        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
        gone = {k for s, length, q in runs for k in range(s + q, s + length)}
        text = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        out.append((i, len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256(text.encode()).hexdigest(),
                    hashlib.sha256(" ".join(w for k, w in enumerate(words) if k not in gone).encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def strings(rng):
    for _ in range(60):
        parts = []
        for _ in range(rng.integers(1, 5)):
            period = rng.integers(0, rng.integers(1, 4), rng.integers(1, 30))
            parts.append(np.resize(period, rng.integers(1, 200)))
            parts.append(rng.integers(0, 5, rng.integers(0, 20)))
        yield np.concatenate(parts)
    yield np.zeros(300, dtype=int)
    yield np.arange(300)
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    yield np.array(b)


def test_extensions_against_plain_comparison():
    rng = np.random.default_rng(11)
    for s in strings(rng):
        line = np.concatenate([[1000], s, [1001]])
        g, back = Grammar(line), Grammar(line).reversed()
        i, j = rng.integers(1, len(line) - 1, 300), rng.integers(1, len(line) - 1, 300)
        i, j = i[i != j], j[i != j]
        for one, text in ((g, line), (back, line[::-1])):
            got = one.extensions(i, j)
            for p, q, e in zip(i.tolist(), j.tolist(), got.tolist(), strict=True):
                k = 0
                while max(p, q) + k < len(text) and text[p + k] == text[q + k]:
                    k += 1
                assert e == k


def test_grammar_shrinks_and_spells_the_string():
    s = np.concatenate([[900], np.random.default_rng(2).integers(0, 50, 5000), np.tile(np.arange(7), 300), [901]])
    g = Grammar(s)
    assert len(g.levels) < 90
    sizes = np.ones(len(s), dtype=int)
    for level in g.levels:
        assert len(level.up) == len(level.symbols) == len(sizes) and level.first[-1] == len(sizes)
        sizes = np.add.reduceat(sizes, level.first[:-1])
    assert sizes.tolist() == [len(s)]


def test_runs_of_many_texts_at_once():
    rng = np.random.default_rng(7)
    texts = [*strings(rng), np.zeros(0, dtype=int), np.zeros(23, dtype=int), np.zeros(24, dtype=int)]
    assert periodic.find_runs(texts) == [plain_runs(t.tolist()) for t in texts]


@pytest.mark.parametrize("seed", range(6))
def test_neighbouring_texts_do_not_join(seed):
    rng = np.random.default_rng(seed)
    texts = [np.resize(rng.integers(0, 2, rng.integers(1, 12)), rng.integers(1, 90)) for _ in range(80)]
    assert periodic.find_runs(texts) == [plain_runs(t.tolist()) for t in texts]


def test_op11(spark, texts):
    want = plain(texts.items())
    assert found(periodic.op11_periodic_runs(spark, TINY)) == want
    assert sum(r[1] > 0 for r in want) > 10


def test_op11_awkward(spark, awkward, nothing, monkeypatch):
    monkeypatch.setattr(periodic, "table", lambda *_: awkward)
    assert found(periodic.op11_periodic_runs(spark, "")) == plain(AWKWARD)
    monkeypatch.setattr(periodic, "table", lambda *_: nothing)
    assert found(periodic.op11_periodic_runs(spark, "")) == []


def test_very_long_text(spark):
    rng = np.random.default_rng(4)
    words = [f"w{x}" for x in rng.integers(0, 3000, 150_000)]
    words[20_000:80_000] = words[20_000:20_700] * 85 + words[:500]
    text = " ".join(words)
    df = spark.createDataFrame([(1, text), (2, "a " * 400_000)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in periodic.periodic_runs(df).collect()}
    assert [(r["length"], r["period"]) for r in got[1]["runs"]][0][1] == 700
    assert got[1]["runs"][0]["start"] <= 20_000 and got[1]["runs"][0]["length"] >= 59_500
    assert [tuple(r) for r in got[2]["runs"]] == [(0, 400_000, 1)] and got[2]["collapsed"] == "a"
    assert len(got[1]["collapsed"].split()) == 150_000 - got[1]["runs"][0]["length"] + 700


def test_general_interface(spark):
    df = spark.createDataFrame([("k", "x  y " * 20, 1)], "id string, body string, key int")
    row = periodic.periodic_runs(df, "id", "body").collect()[0]
    assert (row["id"], row["n_words"], row["collapsed"], [tuple(r) for r in row["runs"]]) == ("k", 40, "x y", [(0, 40, 2)])
