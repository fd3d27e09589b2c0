import random

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import evaluate as H


def scored(spark, labels, scores, groups=None):
    rows = [(bool(y), float(s), (groups[i] if groups else "g")) for i, (y, s) in enumerate(zip(labels, scores))]
    return spark.createDataFrame(rows, "label boolean, score double, run_name string")


def brute(labels, scores):
    """Pure-Python reference: distinct-threshold PR curve, AP, trapezoid ROC-AUC, F1 argmax (lowest threshold)."""
    P = sum(labels)
    N = len(labels) - P
    ths = sorted(set(scores), reverse=True)
    ap, best, pts = 0.0, None, []
    prev_r = 0.0
    for t in ths:
        tp = sum(1 for y, s in zip(labels, scores) if y and s >= t)
        fp = sum(1 for y, s in zip(labels, scores) if not y and s >= t)
        p, r = tp / (tp + fp), tp / P
        ap += (r - prev_r) * p
        prev_r = r
        f1 = 0.0 if p + r == 0 else 2 * p * r / (p + r)
        pts.append((t, f1))
    best = sorted(pts, key=lambda x: (-x[1], x[0]))[0]
    auc = 0.0
    for i, (y1, s1) in enumerate(zip(labels, scores)):
        for y2, s2 in zip(labels, scores):
            if y1 and not y2:
                auc += 1.0 if s1 > s2 else 0.5 if s1 == s2 else 0.0
    return ap, auc / (P * N), best


def test_reference_threshold_case(spark):
    df = scored(spark, [0, 0, 1, 1], [0.10, 0.40, 0.45, 0.90])
    rec = H.metric_record(df).first()
    assert rec["threshold"] == pytest.approx(0.45) and rec["f1"] == 1.0
    assert rec["true_positive"] == 2 and rec["false_positive"] == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_agrees_with_brute_force_on_ties(spark, seed):
    rnd = random.Random(seed)
    n = 150
    labels = [rnd.random() < 0.4 for _ in range(n)]
    scores = [round(rnd.random() * 0.3 + (0.3 if y else 0.0), 1) for y in labels]  # heavy ties
    ap, auc, (th, f1) = brute(labels, scores)
    rec = H.metric_record(scored(spark, labels, scores)).first()
    assert rec["pr_auc"] == pytest.approx(ap, abs=1e-6)
    assert rec["roc_auc"] == pytest.approx(auc, abs=1e-6)
    assert rec["threshold"] == pytest.approx(th) and rec["f1"] == pytest.approx(f1, abs=1e-6)


def test_grouped_equals_single(spark):
    rnd = random.Random(7)
    labels = [rnd.random() < 0.3 for _ in range(200)]
    scores = [round(rnd.random(), 2) for _ in range(200)]
    groups = ["a" if i % 2 else "b" for i in range(200)]
    df = scored(spark, labels, scores, groups)
    g = {r["run_name"]: r.asDict() for r in H.metric_record(df, groups=["run_name"]).collect()}
    for name in ("a", "b"):
        one = H.metric_record(df.filter(F.col("run_name") == name)).first().asDict()
        assert {k: v for k, v in g[name].items() if k != "run_name"} == one


def test_constant_scores_predict_all_positive(spark):
    rec = H.metric_record(scored(spark, [0, 1, 0, 1, 0], [0.4] * 5)).first()
    assert rec["recall"] == 1.0 and rec["roc_auc"] == 0.5 and rec["true_negative"] == 0


def test_cost_curve_matches_product_form(spark):
    rnd = random.Random(5)
    labels = [rnd.random() < 0.4 for _ in range(120)]
    scores = [rnd.choice([0.0, 0.01, 0.29, 0.3, 0.57, 0.58, 0.99, 1.0, 0.29000000000000004,
                          round(rnd.random(), 3)]) for _ in range(120)]
    c = H.cost_curve(scored(spark, labels, scores), ratios=(3,)).collect()
    got = {r["i"]: (r["fn"], r["fp"]) for r in c}
    import numpy as np

    grid = np.linspace(0.01, 0.99, 99)
    assert [r["threshold"] for r in sorted(c, key=lambda r: r["i"])] == list(grid)
    for i in range(1, 100):
        t = float(grid[i - 1])
        fn = sum(1 for y, s in zip(labels, scores) if y and s < t)
        fp = sum(1 for y, s in zip(labels, scores) if not y and s >= t)
        assert got[i] == (fn, fp), i


def test_reliability_bins_are_quantile_right_closed(spark):
    labels = [0, 0, 1, 1, 0, 1, 1, 0, 1, 1]
    scores = [i / 10 for i in range(10)]
    bins = H.reliability_curve(scored(spark, labels, scores), n_bins=5).collect()
    assert sum(r["rows"] for r in bins) == 10 and len(bins) == 5


def test_roc_auc_equals_spark_evaluator_without_binning(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rnd = random.Random(11)
    labels = [rnd.random() < 0.35 for _ in range(300)]
    scores = [round(rnd.random() * 0.5 + (0.3 if y else 0.0), 2) for y in labels]
    df = scored(spark, labels, scores)
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="y", numBins=0)
    spark_auc = ev.evaluate(df.withColumn("y", F.col("label").cast("double")))
    assert H.metric_record(df).first()["roc_auc"] == pytest.approx(spark_auc, abs=1e-6)
