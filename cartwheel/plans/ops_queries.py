"""Ranking (K), run log (A7), scoring (N1), monitoring (A8, N5, N6) and digest (A6) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.functions.digest import content_address, row_fingerprint
from cartwheel.operators import evaluate as H
from cartwheel.operators import monitor as MON
from cartwheel.operators import ranking as K
from cartwheel.operators import scoring as N
from cartwheel.plans.eval_queries import SCORE_COLUMNS, SCORED_CTE, _curve_ctes, scored_sessions
from cartwheel.plans.feature_queries import SPLIT_CTE
from cartwheel.schema import EXPECTED_COLUMNS, KEY_COLUMNS, SESSION_SCHEMA
from cartwheel.sources import runlog
from cartwheel.sources.sessions import load_sessions, with_sessions
from cartwheel.sources.tables import read_table

SPARK = {}
SQL = {}
MODEL_VERSION = "closed-form-1"


def runs_table(spark, sf):
    """FIXTURES §4: one run per (score column × VisitorType), plus copies of one family (exact ties)."""
    s = scored_sessions(spark, sf)
    long = H.long_scores(s, [*KEY_COLUMNS, "VisitorType"], SCORE_COLUMNS, "label", name="score_name")
    long = long.withColumn("run_name", F.concat_ws("__", "score_name", "VisitorType"))
    rec = H.metric_record(long, groups=["run_name"])
    runs = rec.select(
        "run_name", F.split("run_name", "__")[0].alias("family"), F.lit("closed_form").alias("model"),
        F.split("run_name", "__")[1].alias("feature_set"), "f1", "pr_auc", "roc_auc", "precision", "recall",
        "threshold")
    copies = runs.filter(F.col("family") == "score").select(
        F.concat(F.lit("copy_"), F.col("run_name")).alias("run_name"), F.lit("copy").alias("family"),
        *[c for c in runs.columns if c not in ("run_name", "family")])
    return runs.unionByName(copies)


_RUNS_SRC = """vl AS (SELECT label, s.run_name || '__' || sc.VisitorType AS run_name, score FROM long s
  JOIN (SELECT user_id, session_date, VisitorType FROM sessions) sc USING (user_id, session_date))"""
_RUNS = """runs0 AS (SELECT run_name, split_part(run_name, '__', 1) AS family, 'closed_form' AS model,
  split_part(run_name, '__', 2) AS feature_set, f1, pr_auc, roc_auc, precision, recall, threshold FROM rec),
runs AS (SELECT * FROM runs0 UNION ALL SELECT 'copy_' || run_name, 'copy', model, feature_set, f1, pr_auc,
  roc_auc, precision, recall, threshold FROM runs0 WHERE family = 'score')"""


def rsql(body, *extra):
    return with_sessions(body, SPLIT_CTE, SCORED_CTE, _RUNS_SRC, _curve_ctes("vl"), _RUNS, *extra)


SPARK["leaderboard"] = lambda spark, sf: K.leaderboard(runs_table(spark, sf))
SQL["leaderboard"] = rsql("SELECT * FROM runs ORDER BY f1 DESC, run_name")

SPARK["champion_run"] = lambda spark, sf: K.champion(runs_table(spark, sf)).select("run_name", "f1", "pr_auc")
SQL["champion_run"] = rsql("SELECT run_name, f1, pr_auc FROM runs ORDER BY f1 DESC, coalesce(pr_auc, 0) DESC, "
                           "run_name LIMIT 1")

SPARK["top5_runs"] = lambda spark, sf: K.top_k(runs_table(spark, sf), 5).select("run_name", "f1")
SQL["top5_runs"] = rsql("SELECT run_name, f1 FROM runs ORDER BY f1 DESC, run_name LIMIT 5")

SPARK["best_per_family"] = lambda spark, sf: K.best_per_family(
    runs_table(spark, sf), exclude_families=("copy",)).select("family", "run_name", "f1")
SQL["best_per_family"] = rsql("""SELECT family, run_name, f1 FROM (
  SELECT *, row_number() OVER (PARTITION BY family ORDER BY f1 DESC, run_name) AS r FROM runs
  WHERE family <> 'copy') x WHERE r = 1""")


def _gate(spark, sf):
    runs = runs_table(spark, sf)
    prev = runs.filter(F.col("family") == "score_c").agg(F.max("f1").alias("previous"))
    return K.promotion_gate(runs.filter(F.col("family") != "score_c"), prev)


SPARK["promotion_gate"] = _gate
SQL["promotion_gate"] = rsql("""SELECT b.run_name, b.f1 AS best, p.previous, b.f1 > p.previous AS promote
FROM (SELECT run_name, f1 FROM runs WHERE family <> 'score_c' ORDER BY f1 DESC, coalesce(pr_auc, 0) DESC, run_name LIMIT 1) b,
     (SELECT max(f1) AS previous FROM runs WHERE family = 'score_c') p""")


def _run_metrics(spark, sf):
    runs = runs_table(spark, sf)
    log = runlog.run_records(runs, "closed_form_runs", metric_columns=("f1", "pr_auc", "roc_auc", "precision",
                                                                        "recall", "threshold"),
                             param_columns=("family", "model", "feature_set"))
    return runlog.metrics_long(log, prefix="validation_")


SPARK["run_metrics_long"] = _run_metrics
SQL["run_metrics_long"] = rsql(" UNION ALL ".join(
    f"SELECT run_name, 'validation_{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM runs"
    for m in ("f1", "pr_auc", "roc_auc", "precision", "recall", "threshold")))


def _predictions(spark, sf):
    s = scored_sessions(spark, sf)
    val = s.filter(F.col("split") == "validation")
    # The threshold is one fitted number (F1-optimal on validation): a model parameter.
    th = H.f1_threshold(H.pr_points(val, score="score", label="label")).first()["threshold"]
    test = s.filter(F.col("split") == "test")
    return N.decide(test, F.col("score"), th, MODEL_VERSION, keep=KEY_COLUMNS)


SPARK["scored_predictions"] = _predictions
SQL["scored_predictions"] = with_sessions(f"""
SELECT user_id, session_date, score >= b.threshold AS will_purchase, score AS purchase_probability,
       b.threshold, '{MODEL_VERSION}' AS model_version
FROM scored s, best b WHERE s.split = 'test' AND b.run_name = 'score'""",
                                          SPLIT_CTE, SCORED_CTE,
                                          "vlong AS (SELECT label, 'score' AS run_name, score FROM scored "
                                          "WHERE split = 'validation')", _curve_ctes("vlong"))

_LOG = """alog AS (SELECT CAST(event_id AS VARCHAR) AS request_id, ts,
  CASE WHEN event_type = 'view' THEN '/health' WHEN event_type = 'signup' THEN '/v1/model/metadata'
       ELSE '/v1/predict' END AS route,
  CASE WHEN event_type IN ('view', 'signup') THEN 'GET' ELSE 'POST' END AS method,
  CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status, value AS duration_ms,
  'unknown' AS model_version FROM events)"""


def _log(spark, sf):
    return MON.access_log_from_events(read_table(spark, sf, "events"))


SPARK["error_alarm"] = lambda spark, sf: MON.error_alarm(_log(spark, sf))
SQL["error_alarm"] = f"""WITH {_LOG}
SELECT strftime(time_bucket(INTERVAL 300 SECOND, ts), '%Y-%m-%d %H:%M:%S') AS period_start,
       strftime(time_bucket(INTERVAL 300 SECOND, ts) + INTERVAL 300 SECOND, '%Y-%m-%d %H:%M:%S') AS period_end,
       count(*) AS errors
FROM alog WHERE status >= 500 GROUP BY time_bucket(INTERVAL 300 SECOND, ts) HAVING count(*) >= 1"""

SPARK["route_latency"] = lambda spark, sf: MON.route_latency(_log(spark, sf))
SQL["route_latency"] = f"""WITH {_LOG}
SELECT route, status, count(*) AS requests, round(avg(duration_ms), 6) AS mean_ms,
       round(quantile_cont(duration_ms, 0.95), 6) AS p95_ms FROM alog GROUP BY route, status"""

SPARK["route_latency_null_route"] = lambda spark, sf: MON.route_latency(
    _log(spark, sf).withColumn("route", F.when(F.col("route") != "/health", F.col("route"))))
SQL["route_latency_null_route"] = f"""WITH {_LOG}
SELECT nullif(route, '/health') AS route, status, count(*) AS requests, round(avg(duration_ms), 6) AS mean_ms,
       round(quantile_cont(duration_ms, 0.95), 6) AS p95_ms FROM alog GROUP BY nullif(route, '/health'), status"""

SPARK["request_log_lines"] = lambda spark, sf: MON.log_lines(_log(spark, sf))
SQL["request_log_lines"] = f"""WITH {_LOG}
SELECT request_id, CAST(to_json({{'duration_ms': round(duration_ms, 3), 'method': method,
  'model_version': model_version, 'request_id': coalesce(request_id, 'unknown'), 'route': route,
  'status': status}}) AS VARCHAR) AS line FROM alog"""

_FP_COLS = (*KEY_COLUMNS, *EXPECTED_COLUMNS)
_FP_DOUBLES = tuple(c for c in EXPECTED_COLUMNS if SESSION_SCHEMA[c].dataType.simpleString() == "double")


def _digests(spark, sf):
    s = load_sessions(spark, sf)
    fp = row_fingerprint(_FP_COLS, doubles=_FP_DOUBLES)
    return s.select(*KEY_COLUMNS, F.sha2(fp, 256).alias("sha256"), F.md5(fp).alias("md5"),
                    content_address(F.md5(fp)).alias("content_key"))


SPARK["row_digests"] = _digests
_FP_SQL = " || '|' || ".join(
    f"CAST(CAST({c} AS DECIMAL(38, 12)) AS VARCHAR)" if c in _FP_DOUBLES else f"CAST({c} AS VARCHAR)" for c in _FP_COLS)
SQL["row_digests"] = with_sessions(f"""
SELECT user_id, session_date, sha256({_FP_SQL}) AS sha256, md5({_FP_SQL}) AS md5,
       'files/md5/' || substr(md5({_FP_SQL}), 1, 2) || '/' || substr(md5({_FP_SQL}), 3, 30) AS content_key
FROM sessions""")



# ---- model status (N4), reduced bundle (N3), alarm transitions


def _model_status(spark, sf):
    """Each run's manifest row with its gates; a gate without a value fails."""
    runs = runs_table(spark, sf)
    manifest = runs.select("run_name", F.concat(F.col("run_name"), F.lit("-1")).alias("model_version"), F.col("threshold").between(0, 1).alias("gate_threshold"),
                           (F.col("pr_auc") >= F.lit(0.3)).alias("gate_quality"), (F.col("family") != "copy").alias("gate_family"))
    return N.health(manifest, ["run_name"])


SPARK["model_status"] = _model_status
SQL["model_status"] = rsql("""
SELECT run_name, CASE WHEN ok THEN 'ok' ELSE 'degraded' END AS status, CASE WHEN ok THEN run_name || '-1' END AS model_version
FROM (SELECT run_name, coalesce(threshold BETWEEN 0 AND 1, false) AND coalesce(pr_auc >= 0.3, false) AND family <> 'copy' AS ok FROM runs) x""")

SPARK["reduced_bundle_predictions"] = lambda spark, sf: N.score_with_model(
    load_sessions(spark, sf), lambda rows: F.round(1.0 - F.col("ExitRates") * 5.0, 4), ("ExitRates", "BounceRates", "VisitorType"), 0.5,
    "reduced-1", keep=KEY_COLUMNS)
SQL["reduced_bundle_predictions"] = with_sessions("""
SELECT user_id, session_date, p >= 0.5 AS will_purchase, p AS purchase_probability, 0.5e0 AS threshold, 'reduced-1' AS model_version
FROM (SELECT user_id, session_date, round(1e0 - ExitRates * 5e0, 4) AS p FROM sessions) x""")

SPARK["alarm_transitions"] = lambda spark, sf: MON.alarm_transitions(_log(spark, sf))
SQL["alarm_transitions"] = f"""WITH {_LOG},
bad AS (SELECT route, time_bucket(INTERVAL 300 SECOND, ts) AS p, count(*) AS errors FROM alog WHERE status >= 500 GROUP BY 1, 2),
edge AS (SELECT *, lag(p) OVER w AS before, lead(p) OVER w AS after FROM bad WINDOW w AS (PARTITION BY route ORDER BY p)),
now_ AS (SELECT max(ts) AS ts FROM alog)
SELECT route, strftime(p, '%Y-%m-%d %H:%M:%S') AS period_start, 'ALARM' AS state, errors FROM edge, now_
WHERE (before IS NULL OR before <> p - INTERVAL 300 SECOND) AND p + INTERVAL 300 SECOND <= now_.ts
UNION ALL
SELECT route, strftime(p + INTERVAL 300 SECOND, '%Y-%m-%d %H:%M:%S'), 'OK', 0 FROM edge, now_
WHERE (after IS NULL OR after <> p + INTERVAL 300 SECOND) AND p + INTERVAL 600 SECOND <= now_.ts"""
