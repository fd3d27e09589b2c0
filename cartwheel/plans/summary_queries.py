"""Composite report queries: full EDA summary (F2), aligned reports (E9), unknown categories
(E6 / L2), split bag-union (L5) and the output contract check (B16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.operators import contract as C
from cartwheel.operators.contract import snake_name
from cartwheel.operators import evaluate as H
from cartwheel.operators import quality as Q
from cartwheel.operators.joins import align_reports
from cartwheel.plans import contract_queries as CQ
from cartwheel.plans import ops_queries as OQ
from cartwheel.plans import quality_queries as QQ
from cartwheel.plans.eval_queries import SCORED_CTE, _curve_ctes, scored_sessions
from cartwheel.plans.feature_queries import SPLIT_CTE, split_sessions
from cartwheel.schema import EXPECTED_COLUMNS, MONTH_ORDER, SESSION_SCHEMA, VISITOR_TYPES
from cartwheel.sources.sessions import load_sessions, with_sessions

SPARK = {}
SQL = {}


def _eda(spark, sf):
    """the summary sections in one long table (section, key, stat, value)."""
    s = load_sessions(spark, sf).drop("user_id", "session_date")
    summ = Q.dataset_summary(s)
    parts = [
        summ.select(F.lit("summary").alias("section"), F.lit("").alias("key"),
                    F.explode(F.create_map(*[x for c in summ.columns
                                             for x in (F.lit(c), F.col(c).cast("double"))])).alias("stat", "value")),
        Q.missing_counts(s).select(F.lit("missing_values").alias("section"), F.col("column").alias("key"),
                                   F.lit("missing").alias("stat"), F.col("missing").cast("double").alias("value")),
        Q.conversion_by_context(s).select(
            F.concat(F.lit("conversion_by_"),
                     F.try_element_at(F.create_map(*[x for k in Q.CONVERSION_KEYS
                                                     for x in (F.lit(k), F.lit(snake_name(k)))]),
                                      F.col("section"))).alias("section"),
                                          "key", F.lit("rate").alias("stat"),
                                          F.col("conversion_rate").alias("value")),
        Q.signal_means_by_label(s).select(F.lit("relationship_by_revenue").alias("section"),
                                          F.concat_ws(".", "column", "label").alias("key"),
                                          F.lit("mean").alias("stat"), F.col("mean").alias("value")),
    ]
    parts.append(Q.column_types(s).select(
        F.concat(F.lit("dtypes."), "type").alias("section"), F.col("column").alias("key"), F.lit("columns").alias("stat"),
        F.lit(1.0).alias("value")))
    d = Q.describe_numeric(s)
    stats = ("count", "mean", "std", "min", "p25", "p50", "p75", "max")
    parts.append(d.select(F.lit("numeric_distributions").alias("section"), F.col("column").alias("key"),
                          F.explode(F.create_map(*[x for c in stats for x in (F.lit(c), F.col(c).cast("double"))]))
                          .alias("stat", "value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_SUMMARY_STATS = ("rows", "columns", "duplicate_rows", "positive_count", "positive_rate")


def _eda_sql():
    def inner(name):
        text = QQ.SQL[name]
        marker = "sessions AS ("
        i = text.index(marker)
        # keep everything after the shared sessions CTE: either ",\n<more ctes>\nSELECT..." or "\nSELECT ..."
        depth, j = 0, i + len(marker) - 1
        while True:
            ch = text[j]
            depth += ch == "("
            depth -= ch == ")"
            j += 1
            if depth == 0:
                break
        return text[j:]

    def sub(name, alias):
        rest = inner(name)
        if rest.lstrip().startswith(","):
            ctes, _, final = rest.lstrip()[1:].rpartition("\nSELECT")
            ctes = ctes.strip()
            return (ctes.replace("long AS (", f"{alias}_long AS (").replace("FROM long", f"FROM {alias}_long"),
                    ("SELECT" + final).replace("FROM long", f"FROM {alias}_long"))
        return None, rest.strip()

    summary_ctes, summary_sel = sub("dataset_summary", "s1")
    miss = sub("missing_values", "m")[1]
    conv = sub("conversion_by_context", "c")[1]
    sig_ctes, sig_sel = sub("signal_means_by_label", "sig")
    desc_ctes, desc_sel = sub("numeric_describe", "d")
    ctes = [x for x in (sig_ctes, desc_ctes) if x]
    summ = " UNION ALL ".join(f"SELECT '{st}' AS stat, CAST({st} AS DOUBLE) AS value FROM s1x" for st in _SUMMARY_STATS)
    ctes.append(f"s1x AS ({summary_sel.strip()})")
    body = f"""
SELECT 'summary' AS section, '' AS key, stat, value FROM ({summ}) u
UNION ALL SELECT 'missing_values', "column", 'missing', CAST(missing AS DOUBLE) FROM ({miss}) m
UNION ALL SELECT 'conversion_by_' || CASE section {" ".join(f"WHEN '{k}' THEN '{snake_name(k)}'" for k in Q.CONVERSION_KEYS)} END,
  key, 'rate', conversion_rate FROM ({conv}) c
UNION ALL SELECT 'relationship_by_revenue', "column" || '.' || label, 'mean', mean FROM ({sig_sel}) s
UNION ALL SELECT 'numeric_distributions', "column", stat, value FROM (
  SELECT "column", CAST(count AS DOUBLE) AS count, mean, std, min, p25, p50, p75, max FROM ({desc_sel}) d0
) d UNPIVOT (value FOR stat IN (count, mean, std, min, p25, p50, p75, max))
""" + "\n".join(f"UNION ALL SELECT 'dtypes.{SESSION_SCHEMA[c].dataType.simpleString()}', '{c}', 'columns', 1.0" for c in EXPECTED_COLUMNS)
    return with_sessions(body, *ctes)


SPARK["eda_summary_long"] = _eda
SQL["eda_summary_long"] = _eda_sql()

SPARK["unknown_category_values"] = lambda spark, sf: C.unknown_categories(
    C.dirty_sessions(load_sessions(spark, sf)))
SQL["unknown_category_values"] = with_sessions(f"""
SELECT DISTINCT 'Month' AS "column", Month AS value FROM dirty
WHERE Month IS NOT NULL AND Month NOT IN ({", ".join(f"'{m}'" for m in MONTH_ORDER)})
UNION ALL SELECT DISTINCT 'VisitorType', VisitorType FROM dirty
WHERE VisitorType IS NOT NULL AND VisitorType NOT IN ({", ".join(f"'{v}'" for v in VISITOR_TYPES)})""",
                                               CQ._dirty_cte())


def _split_union(spark, sf):
    s = split_sessions(spark, sf)
    parts = [s.filter(F.col("split") == x).drop("split") for x in ("train", "validation", "test")]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return u.groupBy(F.lower(F.col("Revenue").cast("string")).alias("label")).agg(
        F.count(F.lit(1)).alias("sessions"))


SPARK["split_union_sizes"] = _split_union
SQL["split_union_sizes"] = with_sessions("""
SELECT lower(CAST(Revenue AS VARCHAR)) AS label, count(*) AS sessions FROM (
  SELECT * FROM train UNION ALL SELECT * FROM validation UNION ALL SELECT * FROM test) u GROUP BY 1""", SPLIT_CTE)


def _output_contract(spark, sf):
    p = C.prediction_contract(OQ._predictions(spark, sf))
    return p.groupBy("output_valid").agg(F.count(F.lit(1)).alias("rows"))


SPARK["prediction_contract_check"] = _output_contract
SQL["prediction_contract_check"] = "SELECT output_valid, count(*) AS rows FROM (" + \
    OQ.SQL["scored_predictions"].replace(
        "SELECT user_id, session_date, score >= b.threshold AS will_purchase,",
        "SELECT (score BETWEEN 0 AND 1) AND (b.threshold BETWEEN 0 AND 1) AND length(trim('"
        + OQ.MODEL_VERSION + "')) > 0 AS output_valid, score >= b.threshold AS will_purchase,") + \
    ") p GROUP BY output_valid"


def _aligned(spark, sf):
    """Validation record, test record and a check-half record with fewer columns, stacked."""
    s = scored_sessions(spark, sf)
    val = H.metric_record(s.filter(F.col("split") == "validation"))
    th = val.select("threshold")
    test = H.metric_record(s.filter(F.col("split") == "test"), threshold=th)
    cost = H.cost_thresholds(H.cost_curve(s.filter(F.col("split") == "test"), ratios=(5,))).select(
        "threshold", "precision", "recall", "f1")
    return align_reports([val.withColumn("report", F.lit("validation")),
                          test.withColumn("report", F.lit("test")),
                          cost.withColumn("report", F.lit("cost_5_to_1"))])


SPARK["aligned_reports"] = _aligned
_REC = ("threshold", "roc_auc", "pr_auc", "precision", "recall", "f1", "brier_score", "true_negative",
        "false_positive", "false_negative", "true_positive")


def _aligned_sql():
    val_long = "vl AS (SELECT label, 'score' AS run_name, score FROM scored WHERE split = 'validation')"
    v = _curve_ctes("vl")
    # test record at the validation threshold
    test = f"""tst AS (SELECT count(*) FILTER (WHERE NOT label AND score < t) AS tn,
        count(*) FILTER (WHERE NOT label AND score >= t) AS fp, count(*) FILTER (WHERE label AND score < t) AS fn,
        count(*) FILTER (WHERE label AND score >= t) AS tp, avg(power(score - CAST(label AS DOUBLE), 2)) AS brier, t
      FROM scored, (SELECT threshold AS t FROM best) b WHERE split = 'test' GROUP BY t),
    tpts AS (SELECT score, sum(CAST(label AS INT)) AS pos, sum(1 - CAST(label AS INT)) AS neg FROM scored
             WHERE split = 'test' GROUP BY score),
    tcum AS (SELECT *, sum(pos) OVER w AS ctp, sum(neg) OVER w AS cfp, sum(pos) OVER () AS P, sum(neg) OVER () AS N
             FROM tpts WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
    tcurve AS (SELECT sum(neg * (2 * ctp - pos)) / (2e0 * max(P) * max(N)) AS roc_auc,
                      sum(pos * CAST(ctp AS DOUBLE) / (ctp + cfp)) / max(P) AS pr_auc FROM tcum),
    grid AS (SELECT CASE WHEN i = 99 THEN 0.99e0 ELSE CAST(i - 1 AS DOUBLE) * 0.01e0 + 0.01e0 END AS t, i
             FROM range(1, 100) g(i)),
    cst AS (SELECT i, t, fn, fp, P - fn AS tp, 5e0 * fn + fp AS cost FROM (
        SELECT g.i, g.t, count(*) FILTER (WHERE s.label AND s.score < g.t) AS fn,
               count(*) FILTER (WHERE NOT s.label AND s.score >= g.t) AS fp,
               count(*) FILTER (WHERE s.label) AS P
        FROM grid g, scored s WHERE s.split = 'test' GROUP BY g.i, g.t) x)"""
    r = lambda e: f"round({e}, 6)"
    body = f"""
SELECT 'validation' AS report, {", ".join(_REC)} FROM rec
UNION ALL SELECT 'test', {r('t')}, {r('roc_auc')}, {r('pr_auc')},
  {r('CASE WHEN tp + fp = 0 THEN 0e0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END')},
  {r('CASE WHEN tp + fn = 0 THEN 0e0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END')},
  {r('CASE WHEN 2 * tp + fp + fn = 0 THEN 0e0 ELSE 2e0 * tp / (2 * tp + fp + fn) END')}, {r('brier')},
  CAST(tn AS BIGINT), CAST(fp AS BIGINT), CAST(fn AS BIGINT), CAST(tp AS BIGINT) FROM tst, tcurve
UNION ALL SELECT 'cost_5_to_1', round(t, 3), NULL, NULL,
  {r('CASE WHEN tp + fp = 0 THEN 0e0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END')},
  {r('CASE WHEN tp + fn = 0 THEN 0e0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END')},
  {r('CASE WHEN 2 * tp + fp + fn = 0 THEN 0e0 ELSE 2e0 * tp / (2 * tp + fp + fn) END')}, NULL, NULL, NULL, NULL, NULL
FROM (SELECT * FROM cst ORDER BY cost, i LIMIT 1) c"""
    return with_sessions(body, SPLIT_CTE, SCORED_CTE, val_long, v, test)


SQL["aligned_reports"] = _aligned_sql()
