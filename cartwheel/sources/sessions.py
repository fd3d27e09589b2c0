"""The ``sessions`` table: one row per (user_id, day) derived from ``events``.

The raw session CSV of the original product is not available, so the
session rows are derived from the driver's ``events`` table by a fixed
mapping (FIXTURES.md §2).  Only the schema and the contract rules carry
meaning; the mapping itself is synthetic.

Plan shape: one scan of ``events`` (5 columns pruned to what is used), one
hash aggregation on (user_id, day) with map-side partial aggregation, then a
window ``min(day) OVER (PARTITION BY user_id)`` for the visitor type.  The
window partition holds at most one row per calendar day of a user, so a hot
user cannot blow up one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.schema import EXPECTED_COLUMNS, KEY_COLUMNS
from cartwheel.sources.tables import read_table

# Fixed mapping values (must match the oracle text below):
#   Administrative <- 'signup' events, Informational <- 'error' events,
#   ProductRelated <- 'view' and 'click' events, PageValues <- 'purchase' and 'click' values,
#   Revenue <- any 'purchase' event; month labels by 3-day blocks:
#   Feb, Mar, May, June, Jul, Aug, Sep, Oct, Nov, Dec
_MONTH_BY_BLOCK = ("Feb", "Mar", "May", "June", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def _count_of(cond):
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def _value_of(cond):
    return F.round(F.sum(F.when(cond, F.col("value")).otherwise(F.lit(0))), 2)


def sessions_from_events(events: DataFrame) -> DataFrame:
    """Map an events DataFrame to session rows (user_id, session_date, 18 columns)."""
    et = F.col("event_type")
    e = events.select(
        "user_id",
        F.to_date("ts").alias("d"),
        "event_type",
        "value",
        F.get_json_object("props", "$.k").try_cast("int").alias("k"),  # malformed props → NULL, not a failed job
    )
    s = e.groupBy("user_id", "d").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("k").alias("mk"),
        _count_of(et == "signup").alias("adm"),
        _value_of(et == "signup").alias("adm_d"),
        _count_of(et == "error").alias("inf"),
        _value_of(et == "error").alias("inf_d"),
        _count_of(et.isin("view", "click")).alias("prd"),
        _value_of(et.isin("view", "click")).alias("prd_d"),
        _value_of(et.isin("purchase", "click")).alias("pv"),
        F.bool_or(et == "purchase").alias("rev"),
    )
    first_day = F.min("d").over(Window.partitionBy("user_id"))
    day = F.dayofmonth("d")
    month = F.element_at(
        F.array(*[F.lit(m) for m in _MONTH_BY_BLOCK]),
        (F.floor((day - 1) / 3).cast("int") % 10) + 1,
    )
    uid = F.col("user_id")
    out = s.select(
        "user_id",
        F.col("d").alias("session_date"),
        F.col("adm").cast("bigint").alias("Administrative"),
        F.col("adm_d").cast("double").alias("Administrative_Duration"),
        F.col("inf").cast("bigint").alias("Informational"),
        F.col("inf_d").cast("double").alias("Informational_Duration"),
        F.col("prd").cast("bigint").alias("ProductRelated"),
        F.col("prd_d").cast("double").alias("ProductRelated_Duration"),
        F.round(F.col("inf").cast("double") * 0.2 / F.col("n"), 6).alias("BounceRates"),
        F.round((F.col("inf") + F.col("adm")).cast("double") * 0.2 / F.col("n"), 6).alias("ExitRates"),
        F.round(F.col("pv").cast("double") / F.col("n"), 6).alias("PageValues"),
        (F.greatest(F.lit(0), 5 - F.abs(day - 15)).cast("double") / 5).alias("SpecialDay"),
        month.alias("Month"),
        (1 + uid % 8).cast("bigint").alias("OperatingSystems"),
        (1 + uid % 13).cast("bigint").alias("Browser"),
        (1 + uid % 9).cast("bigint").alias("Region"),
        (1 + F.floor(F.col("mk") * F.col("mk") / 500)).cast("bigint").alias("TrafficType"),
        F.when(uid % 50 == 0, "Other")
        .when(F.col("d") == first_day, "New_Visitor")
        .otherwise("Returning_Visitor")
        .alias("VisitorType"),
        (day % 7).isin(6, 0).alias("Weekend"),
        F.col("rev").alias("Revenue"),
    )
    return out.select(*KEY_COLUMNS, *EXPECTED_COLUMNS)


def load_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions for the given scale-factor folder (lazy)."""
    return sessions_from_events(read_table(spark, sf_dir, "events"))


# Same mapping as SQL text, used as a CTE by the DuckDB oracles (FIXTURES.md §2).
SESSIONS_CTE = """
se AS (
  SELECT user_id, CAST(ts AS DATE) AS d, event_type, value,
         CAST(replace(replace(props, '{"k": ', ''), '}', '') AS INT) AS k
  FROM events),
sf AS (SELECT user_id, min(d) AS fd FROM se GROUP BY user_id),
ss AS (
  SELECT user_id, d, count(*) AS n, min(k) AS mk,
    sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS adm,
    round(sum(CASE WHEN event_type = 'signup' THEN value ELSE 0 END), 2) AS adm_d,
    sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS inf,
    round(sum(CASE WHEN event_type = 'error' THEN value ELSE 0 END), 2) AS inf_d,
    sum(CASE WHEN event_type IN ('view', 'click') THEN 1 ELSE 0 END) AS prd,
    round(sum(CASE WHEN event_type IN ('view', 'click') THEN value ELSE 0 END), 2) AS prd_d,
    round(sum(CASE WHEN event_type IN ('purchase', 'click') THEN value ELSE 0 END), 2) AS pv,
    bool_or(event_type = 'purchase') AS rev
  FROM se GROUP BY user_id, d),
sessions AS (
SELECT ss.user_id, ss.d AS session_date,
  CAST(adm AS BIGINT) AS Administrative, CAST(adm_d AS DOUBLE) AS Administrative_Duration,
  CAST(inf AS BIGINT) AS Informational, CAST(inf_d AS DOUBLE) AS Informational_Duration,
  CAST(prd AS BIGINT) AS ProductRelated, CAST(prd_d AS DOUBLE) AS ProductRelated_Duration,
  round(CAST(inf AS DOUBLE) * 0.2e0 / n, 6) AS BounceRates,
  round(CAST(inf + adm AS DOUBLE) * 0.2e0 / n, 6) AS ExitRates,
  round(CAST(pv AS DOUBLE) / n, 6) AS PageValues,
  CAST(greatest(0, 5 - abs(day(ss.d) - 15)) AS DOUBLE) / 5 AS SpecialDay,
  CASE CAST(floor((day(ss.d) - 1) / 3) AS INT) % 10
    WHEN 0 THEN 'Feb' WHEN 1 THEN 'Mar' WHEN 2 THEN 'May' WHEN 3 THEN 'June' WHEN 4 THEN 'Jul'
    WHEN 5 THEN 'Aug' WHEN 6 THEN 'Sep' WHEN 7 THEN 'Oct' WHEN 8 THEN 'Nov' ELSE 'Dec' END AS Month,
  CAST(1 + ss.user_id % 8 AS BIGINT) AS OperatingSystems,
  CAST(1 + ss.user_id % 13 AS BIGINT) AS Browser,
  CAST(1 + ss.user_id % 9 AS BIGINT) AS Region,
  CAST(1 + floor(mk * mk / 500) AS BIGINT) AS TrafficType,
  CASE WHEN ss.user_id % 50 = 0 THEN 'Other' WHEN ss.d = fd THEN 'New_Visitor'
       ELSE 'Returning_Visitor' END AS VisitorType,
  day(ss.d) % 7 IN (6, 0) AS Weekend, rev AS Revenue
FROM ss JOIN sf ON ss.user_id = sf.user_id)"""


def with_sessions(sql_body: str, *extra_ctes: str) -> str:
    """Prefix an oracle query with the sessions CTE (and optional extra CTEs)."""
    ctes = ",\n".join((SESSIONS_CTE.strip(), *[c.strip() for c in extra_ctes]))
    return f"WITH {ctes}\n{sql_body}"
