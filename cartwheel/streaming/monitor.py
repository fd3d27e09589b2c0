"""Error alarm on a stream of access-log records.

Tumbling 300-second periods over event time, a watermark bounds the state,
and only periods with at least one 5xx response are emitted (append mode:
each period is written once, after the watermark passes its end).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = ("request_id string, ts timestamp, route string, method string, status int, "
              "duration_ms double, model_version string")


def alarm_frame(logs: DataFrame, period: str = "300 seconds", watermark: str = "10 minutes",
                min_errors: int = 1) -> DataFrame:
    w = F.window("ts", period)
    # Errors are counted inside the aggregation (not filtered first): a filter would be pushed
    # below the watermark and the watermark would then advance only with error rows, so quiet
    # periods would never close.  State is one row per open 300-second window.
    return (
        logs.withWatermark("ts", watermark)
        .groupBy(w.alias("w"))
        .agg(F.count_if(F.col("status") >= 500).alias("errors"))
        .filter(F.col("errors") >= min_errors)
        .select(F.col("w.start").alias("period_start"), F.col("w.end").alias("period_end"), "errors")
    )


def start_alarm_stream(spark: SparkSession, log_dir: str, out_dir: str, checkpoint_dir: str, *,
                       period: str = "300 seconds", watermark: str = "10 minutes", available_now: bool = True):
    logs = spark.readStream.schema(LOG_SCHEMA).json(log_dir)
    q = (alarm_frame(logs, period, watermark).writeStream.format("parquet").outputMode("append")
         .option("path", out_dir).option("checkpointLocation", checkpoint_dir))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="30 seconds")
    return q.start()


# ---- alarm transitions with state and timers

_CHANGE = "route string, period_start timestamp, state string, errors long"
_STATE = "periods array<long>, errors array<long>, closed long, alarm boolean"


def _alarm_changes(period_s: int, min_errors: int):
    """A function (sent to the tasks by value) for one route: open periods with errors are kept until the watermark has
    passed their end, then each change between OK and ALARM becomes a row.  A timer at the next period that can
    change the state ends an alarm even when the route stays silent."""
    import pandas as pd

    def step(key, batches, state):
        periods, errors, closed, alarm = state.get if state.exists else ([], [], None, False)
        counts = dict(zip(periods, errors, strict=True))
        for rows in batches:
            bad = rows[(rows["status"] >= 500) & (rows["at"] * 1000 >= state.getCurrentWatermarkMs())]  # late rows do not count
            for p, n in bad.groupby(bad["at"] // period_s).size().items():
                if closed is None or p > closed:  # a period told already stays as told
                    counts[int(p)] = counts.get(int(p), 0) + int(n)
        done = state.getCurrentWatermarkMs() // 1000 // period_s - 1  # the last period that has ended
        out = []
        for p in sorted(p for p in counts if p <= done):
            if alarm and p > closed + 1:  # silence in between
                out.append((closed + 1, "OK", 0))
                alarm = False
            if counts[p] >= min_errors and not alarm:
                out.append((p, "ALARM", counts[p]))
                alarm = True
            elif counts[p] < min_errors and alarm:
                out.append((p, "OK", counts[p]))
                alarm = False
            closed = p
        counts = {p: n for p, n in counts.items() if p > done}
        if alarm and done > closed:
            out.append((closed + 1, "OK", 0))
            alarm = False
            closed = closed + 1
        if counts or alarm:
            state.update((list(counts), list(counts.values()), closed, alarm))
            first = min([*counts, *([closed + 1] if alarm else [])])
            state.setTimeoutTimestamp(max((first + 1) * period_s * 1000, state.getCurrentWatermarkMs() + 1))
        elif closed is not None:
            state.update(([], [], closed, False))
        yield pd.DataFrame({"route": [key[0]] * len(out), "period_start": pd.to_datetime([p * period_s for p, _, _ in out], unit="s"),
                            "state": [s for _, s, _ in out], "errors": [n for _, _, n in out]})

    return step


def transitions_frame(logs: DataFrame, period_s: int = 300, watermark: str = "10 minutes", min_errors: int = 1) -> DataFrame:
    """N5 on a stream: the rows of ``monitor.alarm_transitions``, each once the watermark has passed its period's end.

    State per route: the open periods that have errors (as many as the watermark's delay covers), the last period
    told and whether the alarm is on.  Rows behind the watermark are dropped.
    """
    rows = logs.withWatermark("ts", watermark).select("route", "status", "ts", F.unix_seconds("ts").alias("at"))
    return rows.groupBy("route").applyInPandasWithState(_alarm_changes(period_s, min_errors), _CHANGE, _STATE, "append", "EventTimeTimeout")


def start_transition_stream(spark: SparkSession, log_dir: str, out_dir: str, checkpoint_dir: str, *, period_s: int = 300,
                            watermark: str = "10 minutes", max_files_per_trigger: int | None = None, available_now: bool = True):
    reader = spark.readStream.schema(LOG_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    q = (transitions_frame(reader.json(log_dir), period_s, watermark).writeStream.format("parquet").outputMode("append")
         .option("path", out_dir).option("checkpointLocation", checkpoint_dir))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="30 seconds")
    return q.start()


# ---- latency per route and window

#: Size parameter of the quantile sketch: ranks are off by at most some 1.7 % of a window's requests (99 % confidence).
SKETCH_K = 200


def latency_frame(logs: DataFrame, period: str = "300 seconds", watermark: str = "10 minutes") -> DataFrame:
    """N6 on a stream: requests, mean and p95 latency per (window, route, status), written once the watermark has passed
    the window.  State is a quantile sketch per group, some kilobytes whatever the traffic; it comes along as
    ``sketch``, so that windows can be merged to longer ones (``merged_latency``)."""
    w = F.window("ts", period)
    sketch = F.kll_sketch_agg_double("duration_ms", SKETCH_K)
    return logs.withWatermark("ts", watermark).groupBy(w.alias("w"), "route", "status").agg(
        F.count(F.lit(1)).alias("requests"), F.count("duration_ms").alias("timed"), F.sum("duration_ms").alias("total_ms"), sketch.alias("sketch")).select(
        F.col("w.start").alias("period_start"), "route", "status", "requests", "timed", "total_ms", _p95(F.col("timed"), F.col("sketch")).alias("p95_ms"), "sketch")


def _p95(n, sketch):
    return F.when(n > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(0.95)))


def merged_latency(windows: DataFrame, *keys: str) -> DataFrame:
    """Latency over several windows from their sketches, per ``keys``; no request is read again."""
    merged = windows.where(F.col("timed") > 0).groupBy(*keys).agg(
        F.sum("requests").alias("requests"), F.sum("timed").alias("timed"), F.sum("total_ms").alias("total_ms"), F.kll_merge_agg_double("sketch").alias("sketch"))
    return merged.select(*keys, "requests", (F.col("total_ms") / F.col("timed")).alias("mean_ms"), _p95(F.col("timed"), F.col("sketch")).alias("p95_ms"))


def start_latency_stream(spark: SparkSession, log_dir: str, out_dir: str, checkpoint_dir: str, *, period: str = "300 seconds",
                         watermark: str = "10 minutes", max_files_per_trigger: int | None = None, available_now: bool = True):
    reader = spark.readStream.schema(LOG_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    q = (latency_frame(reader.json(log_dir), period, watermark).writeStream.format("parquet").outputMode("append")
         .option("path", out_dir).option("checkpointLocation", checkpoint_dir))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="30 seconds")
    return q.start()
