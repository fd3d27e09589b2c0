"""Quality / EDA queries (F, E) over the sessions table, with their oracles."""

from __future__ import annotations

from cartwheel.operators import quality as Q
from cartwheel.schema import EXPECTED_COLUMNS, MONTH_ORDER
from cartwheel.sources.sessions import load_sessions, with_sessions

# Parameters of the registered queries.
DURATION_COLUMNS = ("Administrative_Duration", "Informational_Duration", "ProductRelated_Duration")
EXTREME_SECONDS = 150.0  # the fixture's durations never reach 3 h (10,800 s)

SPARK = {}
SQL = {}


def _register(name, fn, sql=None):
    SPARK[name] = fn
    if sql is not None:
        SQL[name] = sql


_DUP7 = "Administrative, Informational, ProductRelated, Month, VisitorType, Weekend, Revenue"
_ALL18 = ("Administrative, Administrative_Duration, Informational, Informational_Duration, ProductRelated, "
          "ProductRelated_Duration, BounceRates, ExitRates, PageValues, SpecialDay, Month, OperatingSystems, "
          "Browser, Region, TrafficType, VisitorType, Weekend, Revenue")

_register(
    "dataset_summary",
    lambda spark, sf: Q.dataset_summary(load_sessions(spark, sf)),
    with_sessions(f"""
SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(18 AS BIGINT) AS columns,
       CAST(sum(n - 1) AS BIGINT) AS duplicate_rows, CAST(sum(n * pos) AS BIGINT) AS positive_count,
       round(CAST(sum(n * pos) AS DOUBLE) / sum(n), 6) AS positive_rate
FROM (SELECT count(*) AS n, max(CAST(Revenue AS INT)) AS pos FROM sessions GROUP BY {_ALL18}) g"""),
)

_register(
    "conversion_by_month",
    lambda spark, sf: Q.conversion_by_month(load_sessions(spark, sf), MONTH_ORDER),
    with_sessions("""
SELECT d.month_order, d.Month, a.sessions, a.conversion_rate
FROM (VALUES (1,'Feb'),(2,'Mar'),(3,'May'),(4,'June'),(5,'Jul'),(6,'Aug'),(7,'Sep'),(8,'Oct'),(9,'Nov'),(10,'Dec'))
     AS d(month_order, Month)
LEFT JOIN (SELECT Month, count(*) AS sessions, round(avg(CAST(Revenue AS DOUBLE)), 6) AS conversion_rate
           FROM sessions GROUP BY Month) a ON a.Month = d.Month"""),
)

_conv_parts = []
for _k in Q.CONVERSION_KEYS:
    _conv_parts.append(
        f"SELECT '{_k}' AS section, "
        + (f"lower(CAST({_k} AS VARCHAR))" if _k == "Weekend" else f"CAST({_k} AS VARCHAR)")
        + " AS key, count(*) AS sessions, "
        f"round(avg(CAST(Revenue AS DOUBLE)), 6) AS conversion_rate FROM sessions GROUP BY 1, 2"
    )
_register(
    "conversion_by_context",
    lambda spark, sf: Q.conversion_by_context(load_sessions(spark, sf)),
    with_sessions("\nUNION ALL\n".join(_conv_parts)),
)


def _long_union(columns, select_fmt, table="sessions"):
    return "\nUNION ALL\n".join(select_fmt.format(c=c) + f" FROM {table}" for c in columns)


_NUM14 = ("Administrative", "Informational", "ProductRelated", "Administrative_Duration", "Informational_Duration",
          "ProductRelated_Duration", "BounceRates", "ExitRates", "SpecialDay", "PageValues", "OperatingSystems",
          "Browser", "Region", "TrafficType")
_register(
    "numeric_describe",
    lambda spark, sf: Q.describe_numeric(load_sessions(spark, sf)),
    with_sessions(
        """
SELECT "column", count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
       min(value) AS min, round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50,
       round(quantile_cont(value, 0.75), 6) AS p75, max(value) AS max
FROM long GROUP BY "column\"""",
        "long AS (" + _long_union(_NUM14, "SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value") + ")",
    ),
)

_register(
    "signal_means_by_label",
    lambda spark, sf: Q.signal_means_by_label(load_sessions(spark, sf)),
    with_sessions(
        """SELECT "column", label, round(avg(value), 6) AS mean FROM long GROUP BY 1, 2""",
        "long AS (" + _long_union(Q.SIGNAL_COLUMNS,
                                  "SELECT '{c}' AS \"column\", lower(CAST(Revenue AS VARCHAR)) AS label, "
                                  "CAST({c} AS DOUBLE) AS value") + ")",
    ),
)

_DOUBLE_COLUMNS = ("Administrative_Duration", "Informational_Duration", "ProductRelated_Duration", "BounceRates",
                   "ExitRates", "SpecialDay", "PageValues")
_register(
    "missing_values",
    lambda spark, sf: Q.missing_counts(load_sessions(spark, sf).drop("user_id", "session_date")),
    with_sessions("\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", CAST(count(*) FILTER (WHERE {c} IS NULL"
        + (f" OR isnan({c})" if c in _DOUBLE_COLUMNS else "")
        + ") AS BIGINT) AS missing FROM sessions" for c in _ALL18.split(", ")
    )),
)

_register(
    "duplicate_report",
    lambda spark, sf: Q.duplicate_report(load_sessions(spark, sf), Q.DUPLICATE_COLUMNS),
    with_sessions(f"""
SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n - 1) AS BIGINT) AS extra_copies,
       CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS rows_in_groups,
       CAST(count(*) AS BIGINT) AS rows_deduplicated
FROM (SELECT count(*) AS n FROM sessions GROUP BY {_DUP7}) g"""),
)

_register(
    "duplicate_report_full_row",
    lambda spark, sf: Q.duplicate_report(load_sessions(spark, sf)),
    with_sessions(f"""
SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n - 1) AS BIGINT) AS extra_copies,
       CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS rows_in_groups,
       CAST(count(*) AS BIGINT) AS rows_deduplicated
FROM (SELECT count(*) AS n FROM sessions GROUP BY {_ALL18}) g"""),
)

_register(
    "deduplicated_rows",
    lambda spark, sf: Q.drop_duplicate_rows(load_sessions(spark, sf).select(*EXPECTED_COLUMNS)),
    with_sessions(f"SELECT DISTINCT {_ALL18} FROM sessions"),
)

_GROUPS = f"g AS (SELECT {_DUP7}, count(*) AS n, " + ", ".join(
    f"sum(CAST({m} AS DOUBLE)) AS sum_{m}" for m in Q.ACTIVITY_COLUMNS) + f" FROM sessions GROUP BY {_DUP7})"


def _share_sql(key, wl, wr, left, right, lower=False):
    k = f"lower(CAST(a.{key} AS VARCHAR))" if lower else f"a.{key}"
    return with_sessions(
        f"""
SELECT {k} AS {key}, a.share_{left}, b.share_{right}
FROM (SELECT {key}, round(w / sum(w) OVER (), 6) AS share_{left}
      FROM (SELECT {key}, sum({wl}) AS w FROM g GROUP BY {key}) t WHERE w > 0) a
LEFT JOIN (SELECT {key}, round(w / sum(w) OVER (), 6) AS share_{right}
      FROM (SELECT {key}, sum({wr}) AS w FROM g GROUP BY {key}) t WHERE w > 0) b ON a.{key} = b.{key}""",
        _GROUPS,
    )


_W = {"all": "n", "dup": "CASE WHEN n > 1 THEN n ELSE 0 END", "dedup": "1"}
for _name, _key, _l, _r in (
    ("duplicate_class_shares", "Revenue", "all", "dup"),
    ("dedup_class_shares", "Revenue", "all", "dedup"),
    ("duplicate_visitor_shares", "VisitorType", "dup", "all"),
):
    _register(
        _name,
        (lambda key, l, r: lambda spark, sf: Q.share_comparison(load_sessions(spark, sf), key, l, r, Q.DUPLICATE_COLUMNS))(_key, _l, _r),
        _share_sql(_key, _W[_l], _W[_r], _l, _r, lower=(_key == "Revenue")),
    )

_register(
    "duplicate_activity_means",
    lambda spark, sf: Q.duplicate_activity_means(load_sessions(spark, sf), Q.DUPLICATE_COLUMNS),
    with_sessions(
        """
SELECT d.metric, round(d.v, 6) AS mean_duplicates, round(r.v, 6) AS mean_rest
FROM (""" + " UNION ALL ".join(
            f"SELECT '{m}' AS metric, sum(CASE WHEN n > 1 THEN sum_{m} END) / sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS v FROM g"
            for m in Q.ACTIVITY_COLUMNS) + """) d
LEFT JOIN (""" + " UNION ALL ".join(
            f"SELECT '{m}' AS metric, sum(CASE WHEN n = 1 THEN sum_{m} END) / sum(CASE WHEN n = 1 THEN n ELSE 0 END) AS v FROM g"
            for m in Q.ACTIVITY_COLUMNS) + """) r USING (metric)""",
        _GROUPS,
    ),
)

_register(
    "traffic_type_counts",
    lambda spark, sf: Q.value_counts(load_sessions(spark, sf), "TrafficType"),
    with_sessions("""
SELECT value, count, round(count / sum(count) OVER (), 6) AS share
FROM (SELECT TrafficType AS value, count(*) AS count FROM sessions GROUP BY 1) t"""),
)

_register(
    "context_distinct_counts",
    lambda spark, sf: Q.distinct_counts(load_sessions(spark, sf)),
    with_sessions("\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct FROM sessions"
        for c in Q.CONTEXT_COLUMNS)),
)

_CTX_LONG = "long AS (" + _long_union(
    Q.CONTEXT_COLUMNS, "SELECT '{c}' AS \"column\", CAST({c} AS BIGINT) AS value, CAST(Revenue AS DOUBLE) AS y") + ")"
_register(
    "context_rates_min50",
    lambda spark, sf: Q.context_rates(load_sessions(spark, sf), min_sessions=50),
    with_sessions("""
SELECT "column", value, round(avg(y), 6) AS conversion_rate, count(*) AS sessions
FROM long GROUP BY 1, 2 HAVING count(*) >= 50""", _CTX_LONG),
)
_register(
    "context_spread_min50",
    lambda spark, sf: Q.context_spread(load_sessions(spark, sf), min_sessions=50),
    with_sessions("""
SELECT "column", round(min(rate), 6) AS min_rate, round(max(rate), 6) AS max_rate,
       round(max(rate) - min(rate), 6) AS rate_range
FROM (SELECT "column", value, avg(y) AS rate FROM long GROUP BY 1, 2 HAVING count(*) >= 50) t
GROUP BY 1""", _CTX_LONG),
)

_DUR_LONG = "long AS (" + _long_union(DURATION_COLUMNS, "SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value") + ")"
_register(
    "duration_tail_quantiles",
    lambda spark, sf: Q.tail_quantiles(load_sessions(spark, sf), DURATION_COLUMNS),
    with_sessions("""
SELECT q."column", round(q.p99, 6) AS p99, round(q.p999, 6) AS p999, q.max,
       CAST((SELECT count(*) FROM long l WHERE l."column" = q."column" AND l.value > q.p99) AS BIGINT) AS above_p99
FROM (SELECT "column", quantile_cont(value, 0.99) AS p99, quantile_cont(value, 0.999) AS p999, max(value) AS max
      FROM long GROUP BY 1) q""", _DUR_LONG),
)

_register(
    "extreme_duration_segments",
    lambda spark, sf: Q.threshold_segments(load_sessions(spark, sf), "ProductRelated_Duration", EXTREME_SECONDS),
    with_sessions(f"""
SELECT CASE WHEN ProductRelated_Duration > {EXTREME_SECONDS} THEN 'extreme' ELSE 'typical' END AS segment,
       count(*) AS sessions, round(avg(CAST(Revenue AS DOUBLE)), 6) AS conversion_rate
FROM sessions GROUP BY 1"""),
)

_HIST_LONG = "long AS (" + _long_union(Q.HISTOGRAM_COLUMNS,
                                       "SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value") + ")"
def _edge(k):
    return f"(CASE WHEN {k} >= 30 THEN hi ELSE CAST({k} AS DOUBLE) * ((hi - lo) / 30) + lo END)"


_register(
    "histogram_30_bins",
    lambda spark, sf: Q.equal_width_histogram(load_sessions(spark, sf)),
    with_sessions(f"""
SELECT "column", bin, round({_edge('bin')}, 6) AS bin_start, round({_edge('bin + 1')}, 6) AS bin_end,
       count(*) AS count
FROM (SELECT *, CASE WHEN hi <> lo AND b1 <> 29 AND value >= {_edge('b1 + 1')} THEN b1 + 1 ELSE b1 END AS bin
      FROM (SELECT *, CASE WHEN hi <> lo AND value < {_edge('b0')} THEN b0 - 1 ELSE b0 END AS b1
            FROM (SELECT l."column", l.value, r.lo, r.hi,
                         CAST(CASE WHEN r.hi = r.lo THEN 0
                                   ELSE least(floor((l.value - r.lo) / (r.hi - r.lo) * 30), 29) END AS INT) AS b0
                  FROM long l JOIN (SELECT "column", min(value) AS lo, max(value) AS hi FROM long GROUP BY 1) r
                  USING ("column")) t0) t1) t2
GROUP BY "column", bin, lo, hi""", _HIST_LONG),
)

_BOX_COLS = ("BounceRates", "ExitRates", "PageValues")
_BOX_LONG = "long AS (" + _long_union(_BOX_COLS, "SELECT '{c}' AS \"column\", lower(CAST(Revenue AS VARCHAR)) AS label, "
                                                 "CAST({c} AS DOUBLE) AS value") + ")"
_register(
    "box_by_label",
    lambda spark, sf: Q.box_summary(load_sessions(spark, sf), _BOX_COLS),
    with_sessions("""
SELECT f."column", f.label, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       min(CASE WHEN l.value BETWEEN lo_f AND hi_f THEN l.value END) AS whisker_low,
       max(CASE WHEN l.value BETWEEN lo_f AND hi_f THEN l.value END) AS whisker_high
FROM (SELECT "column", label, q1, median, q3, q1 - 1.5e0 * (q3 - q1) AS lo_f, q3 + 1.5e0 * (q3 - q1) AS hi_f
      FROM (SELECT "column", label, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                   quantile_cont(value, 0.75) AS q3 FROM long GROUP BY 1, 2) q) f
JOIN long l ON l."column" = f."column" AND l.label = f.label
GROUP BY f."column", f.label, q1, median, q3""", _BOX_LONG),
)

_register(
    "class_balance",
    lambda spark, sf: Q.class_balance(load_sessions(spark, sf)),
    with_sessions("""
SELECT CASE WHEN Revenue THEN 'purchase' ELSE 'no_purchase' END AS class, count(*) AS sessions
FROM sessions GROUP BY 1"""),
)


_TYPES = "CASE t WHEN 'VARCHAR' THEN 'string' ELSE lower(t) END"
_register(
    "column_types",
    lambda spark, sf: Q.column_types(load_sessions(spark, sf).select(*EXPECTED_COLUMNS)),
    with_sessions(f'SELECT "column", {_TYPES} AS type FROM (' + " UNION ALL ".join(
        f"(SELECT '{c}' AS \"column\", typeof({c}) AS t FROM sessions LIMIT 1)" for c in EXPECTED_COLUMNS) + ") x"),
)
