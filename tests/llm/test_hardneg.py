"""op12 against all pairs, and the scan's bounds against plain scores."""

from __future__ import annotations

import math

import numpy as np
import pyarrow.parquet as pq
import pytest

from cartwheel.llm import hardneg
from tests.llm.conftest import TINY


def plain(rows, anchor=lambda i: i % 100 == 0, move=lambda i, x: (x + 1) % 10 if i % 7 == 0 else x):
    ok = {}
    for i, v, x in rows:
        if i is None or x is None or v is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        row = (x, [math.floor(256 * float(c)) for c in v])
        ok[i] = min(ok.get(i, row), row)
    ok = {i: (move(i, x), v) for i, (x, v) in ok.items()}
    out = []
    for a, (label, v) in ok.items():
        if not anchor(a):
            continue
        scored = sorted((-sum(p * q for p, q in zip(v, w, strict=False)), i, x == label) for i, (x, w) in ok.items() if i != a)
        for s, p, _ in [r for r in scored if r[2]][:5]:
            near = [(t, i) for t, i, same in scored if not same and 80 * -s <= 100 * -t <= 100 * -s][:5]
            out += [(a, p, k + 1, i, -s, -t) for k, (t, i) in enumerate(near)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def test_op12(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in pq.read_table(f"{TINY}/embeddings.parquet").to_pylist()]
    want = plain(rows)
    assert want and found(hardneg.op12_hard_negatives(spark, TINY)) == want


def mined(spark, rows, tmp, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, place int").select("*")
    path = f"{tmp}/rows"
    hardneg.usable(df).write.parquet(path)
    from pyspark.sql import functions as F

    return hardneg.hard_negatives(spark.read.parquet(path), F.col("vec_id") % 10 == 0, **options)


@pytest.mark.parametrize("block,chunk", [(4096, 100_000), (16, 7)])
def test_ties_hot_labels_and_chunks(spark, tmp_path, monkeypatch, block, chunk):
    monkeypatch.setattr(hardneg, "BLOCK", block)
    monkeypatch.setattr(hardneg, "CHUNK", chunk)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 12) / 4], int(rng.integers(0, 3)) if i % 2 else 1, 0) for i in range(240)]
    rows += [(i + 500, rows[3][1], i % 4, 0) for i in range(40)]  # one vector many times, under several labels
    assert found(mined(spark, rows, tmp_path)) == plain([r[:3] for r in rows], lambda i: i % 10 == 0, lambda i, x: x)


def test_rows_that_take_no_part(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 1.0], 1, 0), (1, [1.0, 0.5], 1, 0), (2, [0.9, 0.5], 2, 0), (2, [0.9, 0.5], 2, 0), (3, [1.0], 2, 0), (4, [], 2, 0),
            (5, None, 2, 0), (6, [1.0, None], 2, 0), (7, [nan, 1.0], 2, 0), (8, [inf, 1.0], 2, 0), (9, [1.0, 0.4], None, 0), (None, [1.0, 0.4], 2, 0),
            (10, [-1.0, -1.0], 3, 0), (11, [1.0, 0.0], 3, 0), (12, [1.0, 0.49, 7.0], 4, 0), (20, [2.0, 1e6], 5, 0), (21, [2.0, 1e6], 5, 0), (22, [1.0, 1e6], 6, 0)]
    want = plain([r[:3] for r in rows], lambda i: i % 10 == 0, lambda i, x: x)
    assert found(mined(spark, rows, tmp_path)) == want and want


def test_empty(spark, tmp_path):
    assert found(mined(spark, [], tmp_path)) == []


def test_wide_numbers_stay_exact(spark, tmp_path):
    big = 2.0 ** 22
    rows = [(i, [big, float(i)], i % 2, 0) for i in range(30)]
    assert found(mined(spark, rows, tmp_path)) == plain([r[:3] for r in rows], lambda i: i % 10 == 0, lambda i, x: x)


def test_bitmap_shrinks_before_the_last_dimension():
    rng = np.random.default_rng(5)
    rows = np.floor(256 * rng.normal(size=(2000, 64)) * np.exp(-np.arange(64) / 8))
    block = hardneg.Block(np.arange(2000), np.zeros(2000, int), rows)
    read = []

    class Counted(hardneg.Wanted):
        def open(self, least, most):
            read.append(len(least))
            return super().open(least, most)

    want = Counted(5)
    hardneg.scan(block, rows[0], np.arange(1, 2000), [want])
    scores = rows @ rows[0]
    assert want.best == sorted(((int(scores[i]), i) for i in range(1, 2000)), key=lambda r: (-r[0], r[1]))[:5]
    assert read[-1] < 100 < read[0]
