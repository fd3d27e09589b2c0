"""M6: ordered target statistics against a plain loop."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import target_stats as TS

SCHEMA = "id long, a string, b int, y boolean"
ROWS = [(i, ["x", "y", None, f"rare{i}"][0 if i % 3 else i % 4], i % 2, i % 5 == 0) for i in range(400)]


def plain(rows, prior, strength=1.0):
    out, seen = {}, {}
    for i, a, b, y in sorted(rows, key=lambda r: hashlib.md5(f"42|{r[0]}".encode()).hexdigest()):
        for column, category in (("a", a), ("b", None if b is None else str(b))):
            s, n = seen.get((column, category), (0, 0))
            out[(i, column)] = (category, (s + strength * prior) / (n + strength))
            seen[(column, category)] = (s + y, n + 1)
    return out, seen


def encoded(df):
    return {(r["id"], r["column"]): (r["category"], r["encoded"]) for r in df.collect()}


def test_statistics_equal_a_plain_loop(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(7)
    fit = TS.fit_target_statistics(df, ["a", "b"], keys=["id"], label="y")
    assert fit.prior == 0.2
    want, totals = plain(ROWS, 0.2)
    assert encoded(TS.ordered_statistics(df, ["a", "b"], fit.prior, keys=["id"], label="y")) == want
    other = spark.createDataFrame([(1, "x", 0, None), (2, "never", None, None), (3, None, 1, None)], SCHEMA)
    rate = lambda c, v: (totals.get((c, v), (0, 0))[0] + 0.2) / (totals.get((c, v), (0, 0))[1] + 1)
    assert encoded(fit.encode(other)) == {(1, "a"): ("x", rate("a", "x")), (1, "b"): ("0", rate("b", "0")), (2, "a"): ("never", 0.2),
                                          (2, "b"): (None, 0.2), (3, "a"): (None, rate("a", None)), (3, "b"): ("1", rate("b", "1"))}
    assert fit.transform(other).orderBy("id").select("a__rate", "b__rate").first()[0] == rate("a", "x")


@pytest.mark.parametrize("turned", [3, 100, 399])
def test_no_row_sees_its_own_label(spark, turned):
    """Turning one row's label changes other rows' statistics (the prior held), never its own."""
    flipped = [(i, a, b, (not y) if i == turned else y) for i, a, b, y in ROWS]
    one, two = (encoded(TS.ordered_statistics(spark.createDataFrame(r, SCHEMA), ["a", "b"], 0.2, keys=["id"], label="y")) for r in (ROWS, flipped))
    assert all(one[(turned, c)] == two[(turned, c)] for c in ("a", "b"))
    hashed = lambda i: hashlib.md5(f"42|{i}".encode()).hexdigest()
    assert {k[0] for k in one if one[k] != two[k]} <= {i for i, *_ in ROWS if hashed(i) > hashed(turned)}


def test_rare_category_says_nothing(spark):
    df = spark.createDataFrame([(i, f"only{i}", 0, i % 2 == 0) for i in range(50)], SCHEMA)
    got = TS.ordered_statistics(df, ["a"], 0.5, keys=["id"], label="y")
    assert got.where("encoded <> 0.5").count() == 0
    assert TS.ordered_statistics(df.limit(0), ["a"], 0.5, keys=["id"], label="y").count() == 0


def test_boosting_on_statistics_scores_raw_rows(spark):
    from cartwheel.operators import train as T
    from cartwheel.plans.feature_queries import split_sessions
    from cartwheel.schema import KEY_COLUMNS
    from tests.conftest import SF_SMALL

    s = split_sessions(spark, SF_SMALL)
    train = s.filter(F.col("split") == "train")
    train, val = T.with_training_columns(train, train), T.with_training_columns(s.filter(F.col("split") == "validation"), train)
    c = next(c for c in T.experiment_candidates(["base_with_page_values"], native_rounds=3) if "ordered" in c.name)
    res = T.sweep([c], train, val)
    scores = T.score_candidate(c, res.models[c.name], val, KEY_COLUMNS)
    assert scores.count() == val.count() and scores.filter(~F.col("score").between(0, 1)).count() == 0
    assert res.records.first()["roc_auc"] > 0.6
