"""Exact quantiles by bracket refinement against numpy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwheel.operators import quantiles as QU

PROBS = {"lowest": 0.0, "p10": 0.1, "half": 0.5, "p99": 0.99, "highest": 1.0}


def values(kind, rng):
    return {"flat": rng.random(20_000), "heavy": np.exp(rng.normal(size=20_000) * 4), "ties": rng.integers(0, 4, 20_000).astype(float),
            "hot": np.where(rng.random(20_000) < 0.7, 3.5, rng.normal(size=20_000) * 10), "few": np.array([2.0, 1.0]), "one": np.full(15_000, -7.25),
            "far": np.append(rng.random(9_999), 1e300)}[kind]


KINDS = ("flat", "heavy", "ties", "hot", "few", "one", "far")


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(9)
    data = {k: values(k, rng) for k in KINDS}
    rows = [(k if k != "hot" else None, float(x)) for k, xs in data.items() for x in xs] + [("flat", None)] * 50 + [("none", None)] * 3
    return data, spark.createDataFrame(rows, "g string, v double").repartition(6).cache()


@pytest.mark.parametrize("fits", [1_000_000, 3_000, 40])
def test_quantiles_at_every_depth(table, monkeypatch, fits):
    data, df = table
    monkeypatch.setattr(QU, "FITS", fits)
    got = {r["g"]: r for r in QU.quantile_columns(df, ["g"], "v", PROBS).collect()}
    assert set(got) == {k if k != "hot" else None for k in KINDS}
    for k, xs in data.items():
        row = got[k if k != "hot" else None]
        assert [row[n] for n in PROBS] == pytest.approx([np.quantile(xs, p) for p in PROBS.values()], rel=1e-12), k


def test_without_groups_and_empty(spark, table, monkeypatch):
    data, df = table
    every = np.concatenate(list(data.values()))
    for fits in (1_000_000, 500):
        monkeypatch.setattr(QU, "FITS", fits)
        got = {r["q"]: r["v"] for r in QU.exact_quantiles(df, [], "v", [0.25, 0.5]).collect()}
        assert got == pytest.approx({0.25: np.quantile(every, 0.25), 0.5: np.quantile(every, 0.5)})
        assert QU.exact_quantiles(df.limit(0), ["g"], "v", [0.5]).collect() == []


def test_whole_numbers(spark, monkeypatch):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), (F.col("id") * F.col("id") % 1009).alias("v"))
    want = {g: float(np.quantile([i * i % 1009 for i in range(5000) if i % 3 == g], 0.9)) for g in range(3)}
    for fits in (1_000_000, 30):
        monkeypatch.setattr(QU, "FITS", fits)
        assert {r["g"]: float(r["x"]) for r in QU.quantile_columns(df, ["g"], "v", {"x": 0.9}).collect()} == pytest.approx(want)


def test_only_bracket_rows_are_ordered(spark, monkeypatch):
    """What the last step sorts is bounded by FITS per bracket, not by the table."""
    monkeypatch.setattr(QU, "FITS", 500)
    seen = []
    picked = QU._picked
    monkeypatch.setattr(QU, "_picked", lambda v, *a: seen.append(v) or picked(v, *a))
    df = spark.range(100_000).select(F.rand(3).alias("v"))
    QU.quantile_columns(df, [], "v", {"a": 0.5, "b": 0.95})
    assert seen[0].count() <= 2 * 2 * 500
