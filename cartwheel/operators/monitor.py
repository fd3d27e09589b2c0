"""Access-log derived monitoring (A8, N5, N6) — batch forms.

The streaming form of the alarm lives in ``cartwheel.streaming.monitor``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.expr import r6
from cartwheel.operators.joins import join_on

ALARM_PERIOD = "300 seconds"


def access_log_from_events(events: DataFrame, model_version: str = "unknown") -> DataFrame:
    """FIXTURES §6: request log rows derived from ``events`` (route by event type, 500 on error)."""
    et = F.col("event_type")
    return events.select(
        F.col("event_id").cast("string").alias("request_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(et == "view", "/health").when(et == "signup", "/v1/model/metadata").otherwise("/v1/predict").alias(
            "route"),
        F.when(et == "view", "GET").when(et == "signup", "GET").otherwise("POST").alias("method"),
        F.when(et == "error", 500).otherwise(200).alias("status"),
        F.col("value").alias("duration_ms"),
        F.lit(model_version).alias("model_version"),
    )


def log_lines(log: DataFrame) -> DataFrame:
    """One JSON line per request (keys sorted; duration rounded to 3 dp; missing id → 'unknown')."""
    return log.select(
        "request_id",
        F.to_json(F.struct(
            F.round("duration_ms", 3).alias("duration_ms"), F.col("method"), F.col("model_version"),
            F.coalesce(F.col("request_id"), F.lit("unknown")).alias("request_id"), F.col("route"), F.col("status"),
        )).alias("line"),
    )


def error_alarm(log: DataFrame, period: str = ALARM_PERIOD, min_errors: int = 1) -> DataFrame:
    """Tumbling periods with at least ``min_errors`` 5xx responses (periods without data do not breach)."""
    w = F.window("ts", period)
    return (
        log.filter(F.col("status") >= 500)
        .groupBy(w.alias("w"))
        .agg(F.count(F.lit(1)).alias("errors"))
        .filter(F.col("errors") >= min_errors)
        .select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("period_start"),
                F.date_format("w.end", "yyyy-MM-dd HH:mm:ss").alias("period_end"), "errors")
    )


def alarm_transitions(log: DataFrame, period: str = ALARM_PERIOD, min_errors: int = 1) -> DataFrame:
    """Per route, the periods at which the alarm changes — (route, period_start, state, errors).

    A period with at least ``min_errors`` 5xx responses is in ALARM, every other one OK, silent ones too; before the
    first record the state is OK.  A change is told once its period has ended, that is, by the latest record's time.
    """
    w = F.window("ts", period)
    bad = (log.where(F.col("status") >= 500).groupBy("route", w.alias("w")).agg(F.count(F.lit(1)).alias("errors"))
           .where(F.col("errors") >= min_errors).select("route", "errors", F.col("w.start").alias("s"), F.col("w.end").alias("e")))
    # a window row is a period with errors: at most one per 300 seconds and route
    along = Window.partitionBy("route").orderBy("s")
    bad = bad.select("*", F.lag("e").over(along).alias("before"), F.lead("s").over(along).alias("after"))
    begins = F.when(F.col("before").isNull() | (F.col("before") < F.col("s")), F.struct(F.col("s").alias("at"), F.lit("ALARM").alias("state"), "errors"))
    ends = F.when(F.col("after").isNull() | (F.col("after") > F.col("e")), F.struct(F.col("e").alias("at"), F.lit("OK").alias("state"), F.lit(0).cast("long").alias("errors")))
    changes = bad.select("route", (F.col("e").cast("long") - F.col("s").cast("long")).alias("length"), F.explode(F.array(begins, ends)).alias("c")).where("c is not null")
    now = log.agg(F.max("ts").alias("ts")).first()["ts"]
    told = F.timestamp_add("SECOND", F.col("length"), F.col("c.at")) <= F.lit(now)
    return changes.where(told).select("route", F.date_format("c.at", "yyyy-MM-dd HH:mm:ss").alias("period_start"), "c.state", "c.errors")


def route_latency(log: DataFrame, *, exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """Requests, mean and p95 latency per (route, status)."""
    base = log.groupBy("route", "status").agg(
        F.count(F.lit(1)).alias("requests"), r6(F.avg("duration_ms")).alias("mean_ms"),
        *([] if exact else [r6(F.percentile_approx("duration_ms", 0.95, accuracy)).alias("p95_ms")]))
    if not exact:
        return base
    from cartwheel.operators.quantiles import exact_quantiles

    q = exact_quantiles(log.select("route", "status", "duration_ms"), ["route", "status"], "duration_ms", [0.95])
    # one row per (route, status), NULL routes among them; p95 is NULL where no duration is known
    return join_on(base, q.select("route", "status", r6(F.col("duration_ms")).alias("p95_ms")), ["route", "status"])
