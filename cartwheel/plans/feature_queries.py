"""Feature, split and preprocessing queries (C, G, D, L) with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.operators import features as FE
from cartwheel.operators import preprocess as P
from cartwheel.operators import split as G
from cartwheel.operators.target_stats import fit_target_statistics, ordered_statistics
from cartwheel.schema import CATEGORICAL_COLUMNS, KEY_COLUMNS
from cartwheel.sources.sessions import load_sessions, with_sessions

SPARK = {}
SQL = {}
SEED = 42
FREQUENT_MIN = 200
BASE_NUMERIC = FE.BASE_NUMERIC


def split_sessions(spark, sf):
    return G.stratified_split(load_sessions(spark, sf), seed=SEED)


def _train(spark, sf):
    return split_sessions(spark, sf).filter(F.col("split") == "train")


def _val(spark, sf):
    return split_sessions(spark, sf).filter(F.col("split") == "validation")


def _h(seed):
    return f"md5('{seed}' || '|' || CAST(user_id AS VARCHAR) || '|' || CAST(session_date AS VARCHAR))"


SPLIT_CTE = f"""split_s AS (
  SELECT *, CASE WHEN rn <= floor(0.6e0 * n_class + 0.5) THEN 'train'
                 WHEN rn <= floor((0.6e0 + 0.2e0) * n_class + 0.5) THEN 'validation' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY Revenue ORDER BY {_h(SEED)}, user_id, session_date) AS rn,
               count(*) OVER (PARTITION BY Revenue) AS n_class FROM sessions) r),
train AS (SELECT * EXCLUDE (rn, n_class, split) FROM split_s WHERE split = 'train'),
validation AS (SELECT * EXCLUDE (rn, n_class, split) FROM split_s WHERE split = 'validation'),
test AS (SELECT * EXCLUDE (rn, n_class, split) FROM split_s WHERE split = 'test')"""


def sql(body, *ctes):
    return with_sessions(body, SPLIT_CTE, *ctes)


SPARK["split_assignment"] = lambda spark, sf: split_sessions(spark, sf).select(*KEY_COLUMNS, "split")
SQL["split_assignment"] = sql("SELECT user_id, session_date, split FROM split_s")

SPARK["split_sizes"] = lambda spark, sf: (
    split_sessions(spark, sf).groupBy("split", F.lower(F.col("Revenue").cast("string")).alias("label"))
    .agg(F.count(F.lit(1)).alias("sessions")))
SQL["split_sizes"] = sql("SELECT split, lower(CAST(Revenue AS VARCHAR)) AS label, count(*) AS sessions "
                         "FROM split_s GROUP BY 1, 2")

SPARK["calibration_halves"] = lambda spark, sf: G.halves(_val(spark, sf).drop("split")).select(*KEY_COLUMNS, "half")
SQL["calibration_halves"] = sql(f"""
SELECT user_id, session_date, CASE WHEN rn <= floor(0.5e0 * n_class + 0.5) THEN 'calibrate' ELSE 'check' END AS half
FROM (SELECT *, row_number() OVER (PARTITION BY Revenue ORDER BY {_h('42|calibration')}, user_id, session_date) AS rn,
             count(*) OVER (PARTITION BY Revenue) AS n_class FROM validation) r""")

SPARK["fold_assignment"] = lambda spark, sf: G.fold_ids(_train(spark, sf).drop("split")).select(*KEY_COLUMNS, "fold")
SQL["fold_assignment"] = sql(f"""
SELECT user_id, session_date, CAST((rn - 1) % 5 AS INT) AS fold
FROM (SELECT *, row_number() OVER (PARTITION BY Revenue ORDER BY {_h('42|folds')}, user_id, session_date) AS rn
      FROM train) r""")


def _overlap(spark, sf):
    fr = G.split_frames(split_sessions(spark, sf).select(*KEY_COLUMNS, "split"))
    pairs = [("train", "validation"), ("train", "test"), ("validation", "test")]
    out = None
    for a, b in pairs:
        n = fr[a].intersect(fr[b]).agg(F.count(F.lit(1)).alias("overlap")).select(
            F.lit(f"{a}&{b}").alias("pair"), "overlap")
        out = n if out is None else out.unionByName(n)
    return out


SPARK["split_overlap"] = _overlap
SQL["split_overlap"] = sql(" UNION ALL ".join(
    f"SELECT '{a}&{b}' AS pair, count(*) AS overlap FROM (SELECT user_id, session_date FROM {a} "
    f"INTERSECT SELECT user_id, session_date FROM {b}) x"
    for a, b in [("train", "validation"), ("train", "test"), ("validation", "test")]))

SPARK["frequent_traffic_types"] = lambda spark, sf: FE.frequent_codes(_train(spark, sf), "TrafficType", FREQUENT_MIN)
SQL["frequent_traffic_types"] = sql(
    f"SELECT TrafficType FROM train GROUP BY TrafficType HAVING count(*) >= {FREQUENT_MIN}")


def _engineered(spark, sf):
    s = split_sessions(spark, sf)
    freq = FE.frequent_codes(s.filter(F.col("split") == "train"), "TrafficType", FREQUENT_MIN)
    return FE.rounded_features(FE.engineer(s, freq), KEY_COLUMNS)


def _sr(num, den):
    return f"CASE WHEN ({den}) = 0 THEN 0e0 ELSE CAST({num} AS DOUBLE) / ({den}) END"


SPARK["engineered_features"] = _engineered
SQL["engineered_features"] = sql(f"""
SELECT user_id, session_date,
  td AS total_duration, tp AS total_pageviews,
  {_sr('td', 'tp')} AS avg_duration_per_page,
  {_sr('Administrative_Duration', 'td')} AS admin_duration_share,
  {_sr('ProductRelated_Duration', 'td')} AS product_duration_share,
  ExitRates - BounceRates AS bounce_exit_gap,
  ProductRelated_Duration * (1 - ExitRates) AS engagement_score,
  round(ln(1 + PageValues), 6) AS page_values_log,
  round(ln(1 + ProductRelated_Duration), 6) AS product_related_duration_log,
  CAST(SpecialDay > 0 AS INT) AS has_special_day,
  CASE WHEN Month IN ('Nov', 'Dec') THEN 'holiday_peak' ELSE 'regular' END AS month_quarter,
  CASE WHEN TrafficType IN (SELECT TrafficType FROM train GROUP BY 1 HAVING count(*) >= {FREQUENT_MIN})
       THEN CAST(TrafficType AS VARCHAR) ELSE '-1' END AS traffic_type_grouped,
  CASE WHEN Weekend AND VisitorType = 'Returning_Visitor' THEN 'True' ELSE 'False' END AS is_weekend_returning
FROM (SELECT *, Administrative_Duration + Informational_Duration + ProductRelated_Duration AS td,
             Administrative + Informational + ProductRelated AS tp FROM split_s) x""")


def _dictionary(spark, sf):
    fr = G.split_frames(split_sessions(spark, sf))
    return FE.category_dictionary([fr["train"], fr["validation"], fr["test"]], CATEGORICAL_COLUMNS)


def _cat_long(table):
    return " UNION ".join(
        f"SELECT DISTINCT '{c}' AS \"column\", lower(CAST({c} AS VARCHAR)) AS value FROM {table}"
        if c == "Weekend" else f"SELECT DISTINCT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM {table}"
        for c in CATEGORICAL_COLUMNS)


SPARK["category_dictionary"] = _dictionary
SQL["category_dictionary"] = sql(f"""
SELECT "column", value, CAST(row_number() OVER (PARTITION BY "column" ORDER BY value) - 1 AS INT) AS idx
FROM ({_cat_long('train')} UNION {_cat_long('validation')} UNION {_cat_long('test')}) u""")

SPARK["scaler_stats"] = lambda spark, sf: P.scaler_stats(_train(spark, sf), BASE_NUMERIC).select(
    "column", F.round("mean", 6).alias("mean"), F.round("sd", 6).alias("sd"))
_NUM_LONG = "tl AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM train" for c in BASE_NUMERIC) + ")"
SQL["scaler_stats"] = sql("""
SELECT "column", round(avg(value), 6) AS mean,
       round(CASE WHEN stddev_pop(value) = 0 THEN 1e0 ELSE stddev_pop(value) END, 6) AS sd
FROM tl GROUP BY 1""", _NUM_LONG)


def _standardized(spark, sf):
    s = split_sessions(spark, sf)
    stats = P.scaler_stats(s.filter(F.col("split") == "train"), BASE_NUMERIC)
    z = P.standardize(s.filter(F.col("split") == "validation"), stats, BASE_NUMERIC, KEY_COLUMNS)
    return z.select(*KEY_COLUMNS, *[F.round(c, 6).alias(c) for c in BASE_NUMERIC])


SPARK["standardized_validation"] = _standardized
SQL["standardized_validation"] = sql(
    "SELECT user_id, session_date, " + ", ".join(
        f"round((v.{c} - st_{c}.m) / st_{c}.sd, 6) AS {c}" for c in BASE_NUMERIC)
    + " FROM validation v, " + ", ".join(
        f"(SELECT avg(value) AS m, CASE WHEN stddev_pop(value) = 0 THEN 1e0 ELSE stddev_pop(value) END AS sd "
        f"FROM tl WHERE \"column\" = '{c}') st_{c}" for c in BASE_NUMERIC), _NUM_LONG)


def _one_hot(spark, sf):
    s = split_sessions(spark, sf)
    d = P.one_hot_dictionary(s.filter(F.col("split") == "train"), CATEGORICAL_COLUMNS)
    return P.one_hot_long(s.filter(F.col("split") == "validation"), d, CATEGORICAL_COLUMNS, KEY_COLUMNS)


SPARK["one_hot_validation"] = _one_hot
SQL["one_hot_validation"] = sql(f"""
SELECT v.user_id, v.session_date, v."column", v.category, d.slot
FROM ({" UNION ALL ".join(
    f"SELECT user_id, session_date, '{c}' AS \"column\", "
    + (f"lower(CAST({c} AS VARCHAR))" if c == "Weekend" else f"CAST({c} AS VARCHAR)")
    + " AS category FROM validation" for c in CATEGORICAL_COLUMNS)}) v
JOIN (SELECT "column", value AS category,
             CAST(row_number() OVER (PARTITION BY "column" ORDER BY value) - 1 AS INT) AS slot
      FROM ({_cat_long('train')}) t) d ON d."column" = v."column" AND d.category = v.category""")

SPARK["class_weights"] = lambda spark, sf: P.class_weights(_train(spark, sf))
SQL["class_weights"] = sql("""
SELECT label, sessions, round(n / (2e0 * sessions), 6) AS balanced_weight,
       round(CAST(n - pos AS DOUBLE) / pos, 6) AS scale_pos_weight
FROM (SELECT lower(CAST(Revenue AS VARCHAR)) AS label, count(*) AS sessions,
             sum(count(*)) OVER () AS n, sum(CASE WHEN Revenue THEN count(*) ELSE 0 END) OVER () AS pos
      FROM train GROUP BY Revenue) c""")


def _model_inputs(spark, sf):
    """C1 + C2: model inputs without PageValues in canonical order, keys kept; the label split off."""
    s = load_sessions(spark, sf)
    x, _y = FE.split_features_target(s, keys=KEY_COLUMNS, include_page_values=False)
    return x


SPARK["model_inputs_without_page_values"] = _model_inputs
SQL["model_inputs_without_page_values"] = with_sessions(
    "SELECT user_id, session_date, " + ", ".join(FE.columns_without("PageValues"))
    + " FROM sessions")

_CAT_TEXT = ("Month", "OperatingSystems", "Browser", "Region", "TrafficType", "VisitorType", "Weekend")
SPARK["categorical_as_text"] = lambda spark, sf: FE.as_strings(
    load_sessions(spark, sf).select(*KEY_COLUMNS, *_CAT_TEXT), _CAT_TEXT)
SQL["categorical_as_text"] = with_sessions(
    "SELECT user_id, session_date, " + ", ".join(
        f"CASE WHEN {c} THEN 'true' ELSE 'false' END AS {c}" if c == "Weekend" else f"CAST({c} AS VARCHAR) AS {c}"
        for c in _CAT_TEXT) + " FROM sessions")


def _ordered_statistics(spark, sf):
    """M6: every training row's categories as the positive rate of the rows before it."""
    train = _train(spark, sf)
    return ordered_statistics(train, CATEGORICAL_COLUMNS, fit_target_statistics(train, CATEGORICAL_COLUMNS).prior)


def _statistics_validation(spark, sf):
    """M6: the validation split's categories as the training split's positive rates."""
    s = split_sessions(spark, sf)
    fitted = fit_target_statistics(s.filter(F.col("split") == "train"), CATEGORICAL_COLUMNS)
    return fitted.encode(s.filter(F.col("split") == "validation"))


def _categories(table):
    return " UNION ALL ".join(
        f"SELECT user_id, session_date, Revenue, '{c}' AS \"column\", "
        + (f"lower(CAST({c} AS VARCHAR))" if c == "Weekend" else f"CAST({c} AS VARCHAR)") + f" AS category FROM {table}"
        for c in CATEGORICAL_COLUMNS)


_STATS_CTE = f"""tc AS ({_categories("train")}), vc AS ({_categories("validation")}),
prior AS (SELECT avg(CAST(Revenue AS DOUBLE)) AS p FROM train)"""
SPARK["ordered_target_statistics"] = _ordered_statistics
SQL["ordered_target_statistics"] = sql(f"""
SELECT user_id, session_date, "column", category,
       (coalesce(sum(CAST(Revenue AS INT)) OVER w, 0) + 1e0 * p) / (count(*) OVER w + 1e0) AS encoded
FROM tc, prior
WINDOW w AS (PARTITION BY "column", category ORDER BY {_h(SEED)}, user_id, session_date
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""", _STATS_CTE)
SPARK["target_statistics_validation"] = _statistics_validation
SQL["target_statistics_validation"] = sql("""
SELECT user_id, session_date, v."column", v.category, coalesce(encoded, p) AS encoded
FROM vc v CROSS JOIN prior LEFT JOIN (
  SELECT "column", category, (sum(CAST(Revenue AS INT)) + 1e0 * any_value(p)) / (count(*) + 1e0) AS encoded
  FROM tc, prior GROUP BY 1, 2) t ON t."column" = v."column" AND t.category = v.category""", _STATS_CTE)


def _one_hot_dense(spark, sf):
    """The validation split's dense one-hot rows, as text of digits (slots in column, then alphabetical order)."""
    s = split_sessions(spark, sf)
    d = P.one_hot_dictionary(s.filter(F.col("split") == "train"), CATEGORICAL_COLUMNS)
    rows = P.one_hot_dense(s.filter(F.col("split") == "validation"), d, CATEGORICAL_COLUMNS, KEY_COLUMNS)
    return rows.select(*KEY_COLUMNS, F.size("slots").alias("width"), F.array_join(F.transform("slots", lambda x: x.cast("int").cast("string")), "").alias("slots"))


SPARK["one_hot_dense_validation"] = _one_hot_dense
_dense = " || ".join(
    "(SELECT coalesce(string_agg(CASE WHEN d.value = " + (f"lower(CAST(v.{c} AS VARCHAR))" if c == "Weekend" else f"CAST(v.{c} AS VARCHAR)")
    + f" THEN '1' ELSE '0' END, '' ORDER BY d.value), '') FROM dict d WHERE d.\"column\" = '{c}')" for c in CATEGORICAL_COLUMNS)
SQL["one_hot_dense_validation"] = sql(f"""
SELECT user_id, session_date, CAST(length(slots) AS INT) AS width, slots
FROM (SELECT user_id, session_date, {_dense} AS slots FROM validation v) x""", f"dict AS ({_cat_long('train')})")

SPARK["labels_canonical"] = lambda spark, sf: FE.split_features_target(load_sessions(spark, sf), keys=KEY_COLUMNS)[1]
SQL["labels_canonical"] = with_sessions("SELECT user_id, session_date, Revenue FROM sessions")

SPARK["context_grid_draws"] = lambda spark, sf: G.random_grid_sample(
    load_sessions(spark, sf).select("Month", "VisitorType", "Region").distinct(), 12, SEED)
SQL["context_grid_draws"] = with_sessions(f"""
SELECT Month, VisitorType, Region FROM (SELECT DISTINCT Month, VisitorType, Region FROM sessions) g
ORDER BY md5('{SEED}|' || Month || '|' || VisitorType || '|' || CAST(Region AS VARCHAR)), Month, VisitorType, Region LIMIT 12""")
