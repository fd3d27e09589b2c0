"""op4 by held-out accuracy and a plain Kneser-Ney; op6 against a plain version."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq

from cartwheel.llm import langid, quality
from tests.llm.conftest import AWKWARD, TINY

MID = "/root/testdata/sf0.01"


def test_op4_held_out_accuracy(spark):
    docs = {r["doc_id"]: r for r in pq.read_table(f"{MID}/documents.parquet").to_pylist()}
    rows = langid.op4_language(spark, MID).collect()
    assert {r.doc_id for r in rows} == docs.keys()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    test = [r for r in rows if r.held_out and docs[r.doc_id]["lang"]]
    assert sum(r.lang_pred == docs[r.doc_id]["lang"] for r in test) > 0.97 * len(test)
    assert sum(r.rejected for r in rows) <= 0.002 * len(rows)


def plain_kneser_ney(words):
    """P(c | context) by definition, as a function."""
    grams = Counter()
    for w, n in words.items():
        s = "   " + w + " "
        for i in range(3, len(s)):
            grams[s[i - 3:i + 1]] += n
    levels = {4: grams}
    for k in (3, 2, 1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    stats = {}
    for k, c in levels.items():
        ones, twos = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
        total, types = Counter(), Counter()
        for g, v in c.items():
            total[g[:-1]] += v
            types[g[:-1]] += 1
        stats[k] = (min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones else 0.5, total, types)

    def p(gram, k=4):
        if k == 0:
            return 1 / langid.CHARACTERS
        g = gram[4 - k:]
        d, total, types = stats[k]
        if not total[g[:-1]]:
            return p(gram, k - 1)
        return max(levels[k][g] - d, 0) / total[g[:-1]] + d * types[g[:-1]] / total[g[:-1]] * p(gram, k - 1)

    return p


def test_model_equals_plain_kneser_ney():
    rng = random.Random(0)
    corpora = {x: Counter("".join(rng.choice(a) for _ in range(rng.randrange(1, 6))) for _ in range(400)) for x, a in (("p", "abcdé"), ("q", "cdefé"))}
    counts = {}
    for lang, c in corpora.items():
        rows = list(langid._grams_of(Counter({w.encode(): n for w, n in c.items()})))
        counts[lang] = (np.frombuffer("".join(g for g, _ in rows).encode("utf-32-le"), np.uint32).reshape(-1, 4), np.array([n for _, n in rows]))
    model = langid.Model(counts)
    words = ["abc", "edé", "z", "ffff", "a"]
    scores, sizes = model.score([w.encode() for w in words])
    for j, lang in enumerate(model.langs):
        p = plain_kneser_ney(corpora[lang])
        for i, w in enumerate(words):
            s = "   " + w + " "
            assert math.isclose(scores[i, j], sum(math.log(p(s[k - 3:k + 1])) for k in range(3, len(s))), rel_tol=1e-4)
            assert sizes[i] == len(w) + 1
    p = plain_kneser_ney(corpora["p"])
    assert math.isclose(sum(p("  a" + c) for c in map(chr, range(32, 32 + langid.CHARACTERS))), 1, rel_tol=1e-6)


def test_op4_awkward(spark, awkward, nothing):
    rows = langid.identify(awkward).collect()
    assert len(rows) == len(AWKWARD)
    letterless = {1, 2, 3, 12}
    for r in rows:
        if r.doc_id in letterless:
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        elif r.doc_id is not None:
            assert r.lang_pred == "en"
    assert langid.identify(nothing).count() == 0
    kept = langid.accepted(awkward)
    assert kept.columns == awkward.columns
    assert {r.doc_id for r in kept.collect()} == {4, 5, 7, 8, 9, 11, 13, None}
    noise = "".join(chr(0x4E00 + random.Random(1).randrange(20000)) for _ in range(800))
    base = [(i, "the cat sat on the mat and the dog ran off to the red barn " * 8, "en") for i in range(80)]
    got = {r.doc_id: r for r in langid.identify(spark.createDataFrame([*base, (999, noise, None)], "doc_id long, text string, lang string")).collect()}
    assert got[999].rejected and not got[0].rejected


def plain_counts(t):
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    at = defaultdict(list)
    for i in range(len(words) - 4):
        at[tuple(words[i:i + 5])].append(i)
    repeated = {i + k for p in at.values() if len(p) > 1 for i in p for k in range(5)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(repeated))


def test_op6_base(spark, texts, awkward, nothing):
    rows = quality.op6_quality(spark, TINY).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        want = plain_counts(texts[r.doc_id])
        assert tuple(r)[1:6] == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)
    rows = quality.judge(awkward).collect()
    assert sorted((r.doc_id or 0, *[r[c] for c in quality.COUNTS[:5]]) for r in rows) == sorted((i or 0, *plain_counts(t or "")) for i, t in AWKWARD)
    assert all(r.kept == (not r.base_failed) for r in rows)  # too few rows for an estimate
    assert quality.judge(nothing).count() == 0


def test_chi_square():
    assert math.isclose(quality.chi2_cdf(11.0705, 5), 0.95, abs_tol=1e-5)
    assert math.isclose(quality.chi2_limit(0.975, 5), 12.8325, abs_tol=1e-3)


def _texts(rng, n, sizes, odd):
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9)))
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.randrange(*sizes))]
        rows.append((i, " ".join(odd(i, words) or words), "en" if i % 3 else None, f"s{i % 4}"))
    return rows


def test_outliers_among_ordinary_texts(spark):
    odd = lambda i, words: None if i % 10 else [w.upper() + "$$" for w in words] if i % 20 else [w * 4 + " | " for w in words]
    rows = _texts(random.Random(2), 900, (30, 200), odd)
    got = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    odd = [r for r in got if r.doc_id % 10 == 0]
    assert sum(r.kept for r in odd) <= 0.05 * len(odd)
    assert [r.doc_id for r in got if r.doc_id % 10 and not r.kept] == []


def test_short_outliers_are_rejected_and_short_ordinary_texts_kept(spark):
    """Texts of 10 to 30 words: capitals, a symbol after every word, long words."""
    kinds = (lambda w: w.upper(), lambda w: w + "#", lambda w: w * 4)
    odd = lambda i, words: [kinds[i // 10 % 3](w) for w in words] if i % 10 == 0 else None
    rows = _texts(random.Random(3), 1500, (10, 31), odd) + [(10_000 + i, t, x, s) for i, t, x, s in _texts(random.Random(4), 900, (60, 200), lambda i, w: None)]
    got = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    for k in range(3):
        some = [r for r in got if r.doc_id < 10_000 and r.doc_id % 10 == 0 and r.doc_id // 10 % 3 == k]
        assert sum(not r.kept for r in some) >= 0.85 * len(some), k
    assert sum(not r.kept for r in got if r.doc_id >= 10_000 or r.doc_id % 10) <= 2


def test_estimate_against_numpy(spark):
    """The same steps on one group in numpy, with exact quantiles to the histogram's step."""
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (2000, quality.P)) * 0.2 + [5, 0.1, 0.2, 0.2, 0.1]
    x[:300] += 3
    stats = spark.createDataFrame([("g", *map(float, r), *[0.0] * quality.P) for r in x], "grp string, " + ", ".join(f"{c}{i} double" for c in "xv" for i in range(quality.P)))
    est = quality.estimates(stats).first()
    clean = x[300:]
    assert np.abs(np.array(est.mean) - clean.mean(axis=0)).max() < 0.03
    cov = np.array(est.covariance).reshape(quality.P, quality.P) - np.diag(np.square(list(quality.STATS.values())))
    assert np.abs(cov - np.cov(clean.T)).max() < 0.01
