"""Ordinary dirty input: NULL groups, one-class groups, empty curves, huge numbers, ties, repeated ids."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import contract as C
from cartwheel.operators import evaluate as H
from cartwheel.operators import monitor as MON
from cartwheel.operators import quality as Q
from cartwheel.operators import ranking as K
from cartwheel.operators.quantiles import exact_quantiles
from cartwheel.operators.running import bucket_count, count_at_or_below
from cartwheel.sources.sessions import load_sessions
from cartwheel.streaming import scoring as S


def test_null_and_one_class_groups_stay(spark):
    rows = [(g, i / 10, bool(i % 2)) for g in ("a", None) for i in range(10)] + [("one", i / 10, True) for i in range(4)]
    df = spark.createDataFrame(rows, "run_name string, score double, label boolean")
    got = {r.run_name: r for r in H.metric_record(df, groups=["run_name"]).collect()}
    assert got.keys() == {"a", None, "one"}
    assert got["a"].roc_auc == got[None].roc_auc is not None and got["one"].roc_auc is None and got["one"].pr_auc == 1.0


def test_empty_scores_fall_back(spark):
    df = spark.createDataFrame([], "score double, label boolean")
    points = H.pr_points(df)
    assert points.count() == 0 and H.fitted_threshold(points) == 0.5
    assert H.metric_record(df).count() == 0


def test_auc_of_large_counts(spark):
    n = 5_000_000_000
    rows = [(0.9, n, 0, n, 0, n, n, 1.0), (0.1, 0, n, n, n, n, n, 0.5)]
    df = spark.createDataFrame(rows, "score double, pos long, neg long, tp long, fp long, P long, N long, precision double")
    r = H.curve_summary(df).first()
    assert r.roc_auc == 1.0 and r.pr_auc == 1.0


def test_route_latency_keeps_null_routes(spark):
    log = spark.createDataFrame([("/a", 200, 1.0), ("/a", 200, 3.0), (None, 200, 5.0), (None, 200, 5.0), ("/b", 500, None)],
                                "route string, status int, duration_ms double")
    got = {r.route: (r.requests, r.p95_ms) for r in MON.route_latency(log).collect()}
    assert got == {"/a": (2, 2.9), None: (2, 5.0), "/b": (1, None)}


def test_quantiles_of_null_groups(spark):
    df = spark.createDataFrame([(None, float(i)) for i in range(5)] + [("x", 1.0), ("x", 2.0)], "g string, v double")
    got = {(r.g, r.q): r.v for r in exact_quantiles(df, ["g"], "v", [0.25, 0.5]).collect()}
    assert got == {(None, 0.25): 1.0, (None, 0.5): 2.0, ("x", 0.25): 1.25, ("x", 0.5): 1.5}


def test_describe_keeps_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    got = {r.column: (r["count"], r.p50) for r in Q.describe_numeric(df, ["a", "b"]).collect()}
    assert got == {"a": (2, 1.5), "b": (0, None)}


def test_buckets_follow_the_shuffle_width(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "20000")
    try:
        assert bucket_count(spark.range(1)) == 40000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    cuts = [i / 7 for i in range(5000)]
    got = spark.range(3000).select((F.col("id") / 4.2 - 3).alias("x")).select("x", count_at_or_below(F.col("x"), cuts).alias("n")).collect()
    assert all(r.n == sum(c <= r.x for c in cuts) for r in got[::37])


def test_huge_numbers_are_violations(spark, sf_small="/root/testdata/sf0.001"):
    ann = C.annotate(C.dirty_sessions(load_sessions(spark, sf_small)), ["user_id", "session_date"])
    rules = {(r.column, r.rule) for r in C.violations_long(ann, ["user_id"]).collect()}
    assert {("OperatingSystems", "integer"), ("TrafficType", "integer"), ("Informational", "null")} <= rules
    assert C.split_valid(ann)[0].count() > 0
    one = C.annotate(load_sessions(spark, sf_small).select(*[F.col(c).cast("string") for c in C.EXPECTED_COLUMNS]).withColumn("Revenue", F.lit("true")))
    assert {r.rule: r.broken for r in C.dataset_rules(one).collect()} == {"empty": False, "two_classes": True}
    assert {r.rule: r.broken for r in C.dataset_rules(one.limit(0)).collect()} == {"empty": True, "two_classes": True}


def test_gate_and_champion_agree_on_ties(spark):
    runs = spark.createDataFrame([(n, "f", "m", "s", 0.7, p, 0.5, 0.5, 0.5, 0.5) for n, p in (("logistic", 0.4), ("forest", 0.4), ("zeta", None))],
                                 "run_name string, family string, model string, feature_set string, f1 double, pr_auc double, roc_auc double, precision double, recall double, threshold double")
    prev = spark.createDataFrame([(0.6,)], "previous double")
    assert K.champion(runs).first().run_name == K.promotion_gate(runs, prev).first().run_name == "forest"
    with pytest.raises(ValueError):
        K.champion(runs.limit(0))


def test_stream_verdicts_belong_to_rows(spark):
    good = next(r.body for r in C.request_bodies(load_sessions(spark, "/root/testdata/sf0.001")).collect() if "SessionId" not in r.body and r.body.startswith("{"))
    bodies = C.request_bodies(load_sessions(spark, "/root/testdata/sf0.001"))
    bad_ids = {r.request_id for r in C.request_violations(bodies).select("request_id").distinct().collect()}
    good = next(r.body for r in bodies.collect() if r.request_id not in bad_ids)
    batch = spark.createDataFrame([("r1", good), ("r1", "bad"), (None, "bad"), (None, good)], "request_id string, body string")
    accepted, rejected = S.score_batch(batch, S.closed_form_scorer, 0.5, "v")
    assert sorted(str(r.request_id) for r in accepted.collect()) == ["None", "r1"]
    assert sorted((str(r.request_id), r.body) for r in rejected.collect()) == [("None", "bad"), ("r1", "bad")]


def test_failed_training_is_logged(spark, tmp_path):
    from cartwheel.operators.champion import train_champion
    from cartwheel.sources import runlog

    sessions = load_sessions(spark, "/root/testdata/sf0.001").withColumn("Revenue", F.lit(True))
    with pytest.raises(C.ContractError):
        train_champion(sessions, str(tmp_path))
    runs = runlog.read_runs(spark, f"{tmp_path}/runs").collect()
    assert [(r.status, r.params["error"]) for r in runs] == [("FAILED", "ContractError")]
