"""N5 and N6 on a stream against their batch forms."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwheel.operators import monitor as MON
from cartwheel.sources.tables import read_table
from cartwheel.streaming import monitor as SM
from tests.conftest import SF_SMALL

START = dt.datetime(2024, 1, 1)


def logs(spark, rows):
    """rows: (seconds after START, route, status, duration)."""
    return spark.createDataFrame([(str(i), START + dt.timedelta(seconds=s), r, "GET", st, float(d), "v") for i, (s, r, st, d) in enumerate(rows)], SM.LOG_SCHEMA)


def feed(spark, folder, batches):
    """One JSON file per batch, in order of arrival."""
    import os
    import time

    os.makedirs(folder)
    for i, rows in enumerate(batches):
        lines = [r[0] for r in logs(spark, rows).select(F.to_json(F.struct("*"))).collect()]
        with open(f"{folder}/{i:03d}.json", "w") as out:
            out.write("\n".join(lines) + "\n")
        stamp = time.time() - 1000 + i
        os.utime(f"{folder}/{i:03d}.json", (stamp, stamp))


def changes(df):
    return sorted((r["route"], str(r["period_start"]), r["state"], r["errors"]) for r in df.collect())


def test_batch_transitions(spark):
    rows = [(10, "a", 500, 1), (20, "a", 200, 1), (310, "a", 503, 1), (650, "a", 200, 1), (1900, "a", 500, 1), (5, "b", 200, 1), (3000, "b", 200, 1),
            (2990, "c", 500, 1)]
    at = lambda s: (START + dt.timedelta(seconds=s)).strftime("%Y-%m-%d %H:%M:%S")
    assert changes(MON.alarm_transitions(logs(spark, rows))) == [("a", at(0), "ALARM", 1), ("a", at(600), "OK", 0), ("a", at(1800), "ALARM", 1),
                                                               ("a", at(2100), "OK", 0), ("c", at(2700), "ALARM", 1)]


@pytest.mark.parametrize("per_trigger", [1, None])
def test_stream_equals_batch_up_to_the_watermark(spark, tmpdir_path, per_trigger):
    rng = np.random.default_rng(4)
    rows = sorted((float(s), f"r{k}", int(st), 1.0) for s, k, st in zip(rng.uniform(0, 40_000, 600), rng.integers(0, 3, 600), rng.choice([200, 200, 200, 500], 600), strict=True))
    rows.append((90_000.0, "r9", 200, 1.0))  # another route's record moves the watermark past everything else
    batches = [rows[i:i + 61] for i in range(0, len(rows), 61)] + [[(90_001.0, "r9", 200, 1.0)]]
    feed(spark, f"{tmpdir_path}/in", batches)
    q = SM.start_transition_stream(spark, f"{tmpdir_path}/in", f"{tmpdir_path}/out", f"{tmpdir_path}/ck", max_files_per_trigger=per_trigger)
    q.awaitTermination(300)
    got = changes(spark.read.parquet(f"{tmpdir_path}/out").select("route", F.date_format("period_start", "yyyy-MM-dd HH:mm:ss").alias("period_start"), "state", "errors"))
    want = changes(MON.alarm_transitions(logs(spark, [r for b in batches for r in b])))
    assert got == want and len(want) > 20


def test_silence_ends_an_alarm_and_late_rows_are_dropped(spark, tmpdir_path):
    feed(spark, f"{tmpdir_path}/in", [[(10, "a", 500, 1)], [(5000, "b", 200, 1)], [(20, "a", 500, 1), (5001, "b", 200, 1)], [(9000, "b", 200, 1)]])
    q = SM.start_transition_stream(spark, f"{tmpdir_path}/in", f"{tmpdir_path}/out", f"{tmpdir_path}/ck", max_files_per_trigger=1)
    q.awaitTermination(300)
    got = changes(spark.read.parquet(f"{tmpdir_path}/out"))
    assert got == [("a", str(START), "ALARM", 1), ("a", str(START + dt.timedelta(seconds=300)), "OK", 0)]


def test_streamed_latency_lies_within_the_sketch_bound(spark, tmpdir_path):
    log = MON.access_log_from_events(read_table(spark, SF_SMALL, "events"))
    log.write.json(f"{tmpdir_path}/in")
    q = SM.start_latency_stream(spark, f"{tmpdir_path}/in", f"{tmpdir_path}/out", f"{tmpdir_path}/ck", period="1 day", watermark="1 minute")
    q.awaitTermination(300)
    got = spark.read.parquet(f"{tmpdir_path}/out")
    rows = {}
    for r in log.select(F.window("ts", "1 day")["start"].alias("p"), "route", "status", "duration_ms").collect():
        rows.setdefault((r["p"], r["route"], r["status"]), []).append(r["duration_ms"])
    streamed = got.collect()
    assert 0 < len(streamed) <= len(rows) and len(rows) - len(streamed) <= 8  # the last windows are still open
    for r in streamed:
        xs = np.array(rows[(r["period_start"], r["route"], r["status"])])
        assert r["requests"] == len(xs) and r["total_ms"] == pytest.approx(xs.sum())
        low, high = (xs < r["p95_ms"]).mean(), (xs <= r["p95_ms"]).mean()
        assert low <= 0.95 + 0.02 and high >= 0.95 - 0.02 - 1 / len(xs)
    # sketches of windows add up
    merged = {(r["route"], r["status"]): r for r in SM.merged_latency(got, "route", "status").collect()}
    for (route, status), r in merged.items():
        xs = np.concatenate([rows[(s["period_start"], route, status)] for s in streamed if (s["route"], s["status"]) == (route, status)])
        assert r["requests"] == len(xs) and r["mean_ms"] == pytest.approx(xs.mean())
        assert abs((xs <= r["p95_ms"]).mean() - 0.95) <= 0.025


def test_late_rows_do_not_reopen_a_latency_window(spark, tmpdir_path):
    feed(spark, f"{tmpdir_path}/in", [[(10, "a", 200, 5)], [(5000, "a", 200, 7)], [(5005, "a", 200, 8)], [(20, "a", 200, 500), (5010, "a", 200, 9)], [(9000, "a", 200, 1)], [(9001, "a", 200, 1)]])
    q = SM.start_latency_stream(spark, f"{tmpdir_path}/in", f"{tmpdir_path}/out", f"{tmpdir_path}/ck", max_files_per_trigger=1)
    q.awaitTermination(300)
    got = {str(r["period_start"]): (r["requests"], r["p95_ms"]) for r in spark.read.parquet(f"{tmpdir_path}/out").collect()}
    assert got[str(START)] == (1, 5.0)
    assert got[str(START + dt.timedelta(seconds=4800))][0] == 3
