"""Evaluation queries (H, F22) on the closed-form scored table (FIXTURES §3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.functions.expr import r6
from cartwheel.operators import evaluate as H
from cartwheel.operators import split as G
from cartwheel.plans.feature_queries import SPLIT_CTE, split_sessions
from cartwheel.schema import KEY_COLUMNS
from cartwheel.sources.sessions import load_sessions, with_sessions

SPARK = {}
SQL = {}
SCORE_COLUMNS = ("score", "score_b", "score_c")
COST_RATIOS = (1, 3, 5, 10)


def scored_sessions(spark, sf, *, split: bool = True, prior: bool = True):
    """Sessions with three closed-form scores: PageValues-based, ExitRates-based and the train prior.

    ``split=False`` skips the split (queries over all rows); ``prior=False`` skips the prior
    (``score_c``), which is one number fitted on the train split.
    """
    s = split_sessions(spark, sf) if (split or prior) else load_sessions(spark, sf)
    extra = []
    if prior:
        p = s.filter(F.col("split") == "train").agg(F.avg(F.col("Revenue").cast("double")).alias("p")).first()["p"]
        extra.append(F.lit(p).alias("score_c"))
    return s.select(
        *KEY_COLUMNS, *(["split"] if (split or prior) else []), "Revenue", "VisitorType",
        F.col("Revenue").alias("label"),
        F.round(F.col("PageValues") / (F.col("PageValues") + 20.0), 4).alias("score"),
        F.round(1.0 - F.col("ExitRates") * 5.0, 4).alias("score_b"), *extra,
    )


def _score_only(spark, sf):
    return scored_sessions(spark, sf, split=False, prior=False)


def _long(spark, sf, split=None):
    s = scored_sessions(spark, sf)
    if split:
        s = s.filter(F.col("split") == split)
    return H.long_scores(s, KEY_COLUMNS, SCORE_COLUMNS, "label")


SCORED_CTE = """scored AS (
  SELECT user_id, session_date, split, Revenue AS label,
         round(PageValues / (PageValues + 20e0), 4) AS score, round(1e0 - ExitRates * 5e0, 4) AS score_b,
         (SELECT avg(CAST(Revenue AS DOUBLE)) FROM split_s WHERE split = 'train') AS score_c
  FROM split_s),
long AS (SELECT user_id, session_date, split, label, 'score' AS run_name, score FROM scored
         UNION ALL SELECT user_id, session_date, split, label, 'score_b', score_b FROM scored
         UNION ALL SELECT user_id, session_date, split, label, 'score_c', score_c FROM scored)"""


def _curve_ctes(src="long"):
    return f"""pts AS (SELECT run_name, score, sum(CAST(label AS INT)) AS pos, sum(1 - CAST(label AS INT)) AS neg
        FROM {src} GROUP BY run_name, score),
cum AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
               sum(pos) OVER (PARTITION BY run_name) AS P, sum(neg) OVER (PARTITION BY run_name) AS N
        FROM pts WINDOW w AS (PARTITION BY run_name ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
pr AS (SELECT *, CAST(tp AS DOUBLE) / (tp + fp) AS precision,
              CASE WHEN P = 0 THEN 1e0 ELSE CAST(tp AS DOUBLE) / P END AS recall FROM cum),
pf AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0e0
                      ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM pr),
best AS (SELECT run_name, score AS threshold, f1 AS best_f1 FROM (
           SELECT *, row_number() OVER (PARTITION BY run_name ORDER BY f1 DESC, score ASC) AS r FROM pf) x
         WHERE r = 1),
curve AS (SELECT run_name, sum(neg * (2 * tp - pos)) / (2e0 * max(P) * max(N)) AS roc_auc,
                 sum(pos * precision) / max(P) AS pr_auc FROM pf GROUP BY run_name),
at_t AS (SELECT l.run_name, b.threshold,
                count(*) FILTER (WHERE NOT label AND score < threshold) AS tn,
                count(*) FILTER (WHERE NOT label AND score >= threshold) AS fp,
                count(*) FILTER (WHERE label AND score < threshold) AS fn,
                count(*) FILTER (WHERE label AND score >= threshold) AS tp,
                avg(power(score - CAST(label AS DOUBLE), 2)) AS brier
         FROM {src} l JOIN best b USING (run_name) GROUP BY l.run_name, b.threshold),
rec AS (SELECT a.run_name, round(a.threshold, 6) AS threshold, round(c.roc_auc, 6) AS roc_auc,
               round(c.pr_auc, 6) AS pr_auc,
               round(CASE WHEN tp + fp = 0 THEN 0e0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END, 6) AS precision,
               round(CASE WHEN tp + fn = 0 THEN 0e0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END, 6) AS recall,
               round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0e0 ELSE 2e0 * tp / (2 * tp + fp + fn) END, 6) AS f1,
               round(brier, 6) AS brier_score, CAST(tn AS BIGINT) AS true_negative,
               CAST(fp AS BIGINT) AS false_positive, CAST(fn AS BIGINT) AS false_negative,
               CAST(tp AS BIGINT) AS true_positive
        FROM at_t a JOIN curve c USING (run_name))"""


def sql(body, *ctes):
    return with_sessions(body, SPLIT_CTE, SCORED_CTE, *ctes)


_REC_COLS = ("threshold", "roc_auc", "pr_auc", "precision", "recall", "f1", "brier_score", "true_negative",
             "false_positive", "false_negative", "true_positive")


def _pr_curve(spark, sf):
    pts = H.pr_points(_score_only(spark, sf), score="score", label="label")
    return pts.select("score", "tp", "fp", r6(F.col("precision")).alias("precision"),
                      r6(F.col("recall")).alias("recall"), r6(F.col("f1")).alias("f1"))


SPARK["pr_curve"] = _pr_curve
SQL["pr_curve"] = sql("""SELECT score, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
  round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM pf WHERE run_name = 'score'""",
                      _curve_ctes())

SPARK["f1_threshold"] = lambda spark, sf: H.f1_threshold(
    H.pr_points(_score_only(spark, sf), score="score", label="label")).select(
    "threshold", r6(F.col("best_f1")).alias("best_f1"))
SQL["f1_threshold"] = sql("SELECT threshold, round(best_f1, 6) AS best_f1 FROM best WHERE run_name = 'score'",
                          _curve_ctes())

SPARK["metric_record"] = lambda spark, sf: H.metric_record(_score_only(spark, sf), score="score", label="label")
SQL["metric_record"] = sql("SELECT " + ", ".join(_REC_COLS) + " FROM rec WHERE run_name = 'score'", _curve_ctes())

SPARK["grouped_metrics"] = lambda spark, sf: H.metric_record(_long(spark, sf), groups=["run_name"])
SQL["grouped_metrics"] = sql("SELECT run_name, " + ", ".join(_REC_COLS) + " FROM rec", _curve_ctes())

SPARK["reliability_curve"] = lambda spark, sf: H.reliability_curve(
    H.long_scores(_score_only(spark, sf), KEY_COLUMNS, ("score", "score_b"), "label"), groups=["run_name"])
SQL["reliability_curve"] = sql("""
SELECT l.run_name, (CASE WHEN score > e1 THEN 1 ELSE 0 END + CASE WHEN score > e2 THEN 1 ELSE 0 END
  + CASE WHEN score > e3 THEN 1 ELSE 0 END + CASE WHEN score > e4 THEN 1 ELSE 0 END
  + CASE WHEN score > e5 THEN 1 ELSE 0 END + CASE WHEN score > e6 THEN 1 ELSE 0 END
  + CASE WHEN score > e7 THEN 1 ELSE 0 END + CASE WHEN score > e8 THEN 1 ELSE 0 END
  + CASE WHEN score > e9 THEN 1 ELSE 0 END) AS bin,
  round(avg(score), 6) AS mean_predicted, round(avg(CAST(label AS DOUBLE)), 6) AS fraction_positive,
  count(*) AS rows
FROM long l JOIN (SELECT run_name, quantile_cont(score, 0.1) AS e1, quantile_cont(score, 0.2) AS e2,
  quantile_cont(score, 0.3) AS e3, quantile_cont(score, 0.4) AS e4, quantile_cont(score, 0.5) AS e5,
  quantile_cont(score, 0.6) AS e6, quantile_cont(score, 0.7) AS e7, quantile_cont(score, 0.8) AS e8,
  quantile_cont(score, 0.9) AS e9 FROM long GROUP BY run_name) e USING (run_name)
WHERE l.run_name <> 'score_c'
GROUP BY 1, 2""")


def _cost_curve(spark, sf):
    c = H.cost_curve(_score_only(spark, sf), score="score", label="label", ratios=COST_RATIOS)
    return c.select("threshold", "cost_ratio", "fn", "fp", "cost")


_COST_CTE = """grid AS (SELECT CASE WHEN i = 99 THEN 0.99e0 ELSE CAST(i - 1 AS DOUBLE) * 0.01e0 + 0.01e0 END AS threshold, i
             FROM range(1, 100) t(i)),
cc AS (SELECT g.threshold, g.i, CAST(r.ratio AS DOUBLE) AS cost_ratio,
              count(*) FILTER (WHERE s.label AND s.score < g.threshold) AS fn,
              count(*) FILTER (WHERE NOT s.label AND s.score >= g.threshold) AS fp,
              count(*) FILTER (WHERE s.label AND s.score >= g.threshold) AS tp
       FROM grid g, (VALUES (1), (3), (5), (10)) r(ratio), scored s
       GROUP BY 1, 2, 3)"""
SPARK["cost_curve"] = _cost_curve
SQL["cost_curve"] = sql("""SELECT threshold, cost_ratio, CAST(fn AS BIGINT) AS fn, CAST(fp AS BIGINT) AS fp,
  cost_ratio * fn + 1e0 * fp AS cost FROM cc""", _COST_CTE)

SPARK["cost_thresholds"] = lambda spark, sf: H.cost_thresholds(
    H.cost_curve(_score_only(spark, sf), score="score", label="label", ratios=COST_RATIOS))
SQL["cost_thresholds"] = sql("""
SELECT cost_ratio, round(threshold, 3) AS threshold, cost,
  round(CASE WHEN tp + fp = 0 THEN 0e0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END, 6) AS precision,
  round(CASE WHEN tp + fn = 0 THEN 0e0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END, 6) AS recall,
  round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0e0 ELSE 2e0 * tp / (2 * tp + fp + fn) END, 6) AS f1
FROM (SELECT *, cost_ratio * fn + 1e0 * fp AS cost,
             row_number() OVER (PARTITION BY cost_ratio ORDER BY cost_ratio * fn + 1e0 * fp, i) AS r FROM cc) x
WHERE r = 1""", _COST_CTE)


def _fold_f1(spark, sf):
    s = scored_sessions(spark, sf, prior=False).filter(F.col("split") == "train").drop("split")
    folded = G.fold_ids(s)
    return H.fold_f1(folded, score="score", label="label")


SPARK["fold_f1"] = _fold_f1
SQL["fold_f1"] = sql("""
SELECT round(avg(f1), 6) AS mean_f1, count(*) AS folds FROM (
  SELECT fold, CASE WHEN 2 * tp + fp + fn = 0 THEN 0e0 ELSE 2e0 * tp / (2 * tp + fp + fn) END AS f1
  FROM (SELECT fold, count(*) FILTER (WHERE label AND score >= 0.5) AS tp,
               count(*) FILTER (WHERE NOT label AND score >= 0.5) AS fp,
               count(*) FILTER (WHERE label AND score < 0.5) AS fn
        FROM (SELECT *, (row_number() OVER (PARTITION BY label ORDER BY
                md5('42|folds' || '|' || CAST(user_id AS VARCHAR) || '|' || CAST(session_date AS VARCHAR)),
                user_id, session_date) - 1) % 5 AS fold
              FROM scored WHERE split = 'train') f GROUP BY fold) c) x""")


def _blend(spark, sf):
    s = H.blend(_score_only(spark, sf), "score", "score_b", name="blend")
    return H.metric_record(s, score="blend", label="label")


SPARK["blend_metrics"] = _blend
SQL["blend_metrics"] = sql("SELECT " + ", ".join(_REC_COLS) + " FROM rec",
                           "bl AS (SELECT 'blend' AS run_name, label, 0.5e0 * score + 0.5e0 * score_b AS score "
                           "FROM scored)", _curve_ctes("bl"))


def _check_half(spark, sf):
    s = scored_sessions(spark, sf).filter(F.col("split") == "validation").drop("split")
    return G.halves(s).filter(F.col("half") == "check")


_CHECK_CTE = """chk AS (SELECT * FROM (
   SELECT *, row_number() OVER (PARTITION BY label ORDER BY
     md5('42|calibration' || '|' || CAST(user_id AS VARCHAR) || '|' || CAST(session_date AS VARCHAR)),
     user_id, session_date) AS rn, count(*) OVER (PARTITION BY label) AS n_class
   FROM scored WHERE split = 'validation') x WHERE rn > floor(0.5e0 * n_class + 0.5)),
clong AS (SELECT label, 'score' AS run_name, score FROM chk UNION ALL SELECT label, 'score_b', score_b FROM chk
          UNION ALL SELECT label, 'score_c', score_c FROM chk)"""


def _calibration_report(spark, sf):
    long = H.long_scores(_check_half(spark, sf), KEY_COLUMNS, SCORE_COLUMNS, "label")
    rec = H.metric_record(long, groups=["run_name"])
    return rec.select("run_name", "f1", "brier_score", "roc_auc", "precision", "recall")


SPARK["calibration_report"] = _calibration_report
SQL["calibration_report"] = sql("SELECT run_name, f1, brier_score, roc_auc, precision, recall FROM rec",
                                _CHECK_CTE, _curve_ctes("clong"))


def _calibration_gate(spark, sf):
    long = H.long_scores(_check_half(spark, sf), KEY_COLUMNS, SCORE_COLUMNS, "label")
    rec = H.metric_record(long, groups=["run_name"])
    return H.calibration_gate(rec, "score_c", ["score", "score_b"])


SPARK["calibration_gate"] = _calibration_gate
SQL["calibration_gate"] = sql("""
SELECT c.run_name AS method, c.brier_score, b.brier_score AS base_brier
FROM (SELECT run_name, brier_score FROM rec WHERE run_name IN ('score', 'score_b')
      ORDER BY brier_score, run_name LIMIT 1) c, (SELECT brier_score FROM rec WHERE run_name = 'score_c') b
WHERE c.brier_score < b.brier_score""", _CHECK_CTE, _curve_ctes("clong"))


def _lift(spark, sf):
    s = _score_only(spark, sf)
    base = s.agg(F.avg(F.col("label").cast("double")).alias("base_rate"))
    return H.lift(s, base).select(*KEY_COLUMNS, "score", r6(F.col("base_rate")).alias("base_rate"), "lift")


SPARK["lift_vs_base_rate"] = _lift
SQL["lift_vs_base_rate"] = sql("""
SELECT user_id, session_date, score, round(b, 6) AS base_rate, round(score / b, 6) AS lift
FROM scored, (SELECT avg(CAST(label AS DOUBLE)) AS b FROM scored) t""")
