import os

from pyspark.sql import functions as F

from cartwheel.operators import contract as C
from cartwheel.operators import monitor as MON
from cartwheel.sources.sessions import load_sessions
from cartwheel.sources.tables import read_table
from cartwheel.streaming import monitor as SM
from cartwheel.streaming import scoring as SS
from tests.conftest import SF_SMALL


def test_scoring_stream_routes_valid_and_invalid(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    reqs = C.request_bodies(load_sessions(spark, SF_SMALL))
    reqs.repartition(3).write.json(src)
    q = SS.start_scoring_stream(spark, src, f"{tmpdir_path}/ok", f"{tmpdir_path}/bad", f"{tmpdir_path}/ck",
                                SS.closed_form_scorer, 0.3, "test-v1", max_files_per_trigger=1)
    q.awaitTermination(300)
    ok = spark.read.parquet(f"{tmpdir_path}/ok")
    bad = spark.read.parquet(f"{tmpdir_path}/bad")
    n = reqs.count()
    assert ok.count() + bad.count() == n
    expected_bad = C.request_violations(reqs).select("request_id").distinct().count()
    assert bad.count() == expected_bad
    assert ok.filter(~F.col("purchase_probability").between(0, 1)).count() == 0
    assert ok.filter(F.col("will_purchase") != (F.col("purchase_probability") >= 0.3)).count() == 0
    assert {r["model_version"] for r in ok.select("model_version").distinct().collect()} == {"test-v1"}


def test_scoring_stream_without_model_rejects_everything(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    reqs = C.request_bodies(load_sessions(spark, SF_SMALL))
    reqs.write.json(src)
    q = SS.start_scoring_stream(spark, src, f"{tmpdir_path}/ok", f"{tmpdir_path}/bad", f"{tmpdir_path}/ck",
                                None, 0.5, "none")
    q.awaitTermination(300)
    bad = spark.read.parquet(f"{tmpdir_path}/bad")
    assert bad.count() == reqs.count()
    assert bad.filter(F.array_contains("reasons", SS.UNAVAILABLE)).count() == reqs.count()


def test_alarm_stream_matches_batch(spark, tmpdir_path):
    log = MON.access_log_from_events(read_table(spark, SF_SMALL, "events"))
    log.write.json(f"{tmpdir_path}/logs")
    q = SM.start_alarm_stream(spark, f"{tmpdir_path}/logs", f"{tmpdir_path}/alarm", f"{tmpdir_path}/ck")
    q.awaitTermination(300)
    streamed = spark.read.parquet(f"{tmpdir_path}/alarm")
    batch = MON.error_alarm(log)
    # append mode emits a period once the watermark (max event time - 10 min) passes its end;
    # every emitted period must equal the batch answer, and only the last periods may be pending
    s = {(r["period_start"].strftime("%Y-%m-%d %H:%M:%S"), r["errors"]) for r in streamed.collect()}
    b = {(r["period_start"], r["errors"]) for r in batch.collect()}
    assert s <= b
    assert len(b) - len(s) <= 3


def test_micro_batch_scoring_with_pipeline_model(spark):
    from pyspark.sql import functions as F

    from cartwheel.operators import train as T
    from cartwheel.plans.feature_queries import split_sessions
    from cartwheel.schema import FEATURE_COLUMNS

    s = split_sessions(spark, SF_SMALL)
    train = T.with_training_columns(s.filter(F.col("split") == "train"), s.filter(F.col("split") == "train"))
    cand = T.production_candidates(forest_trees=5, forest_depth=3)[2]
    model = T.fit_candidate(cand, train)
    reqs = C.request_bodies(load_sessions(spark, SF_SMALL))
    ok, bad = SS.score_batch_with_model(reqs, model, FEATURE_COLUMNS, 0.5, "rf-v1")
    assert ok.count() + bad.count() == reqs.count()
    assert ok.filter(~F.col("purchase_probability").between(0, 1)).count() == 0


def test_alarm_stream_drops_data_behind_the_watermark(spark, tmpdir_path):
    import datetime as dt

    from pyspark.sql import Row

    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)

    def rows(specs):
        return spark.createDataFrame(
            [Row(request_id=str(i), ts=t0 + dt.timedelta(seconds=sec), route="/v1/predict", method="POST",
                 status=status, duration_ms=1.0, model_version="v") for i, (sec, status) in enumerate(specs)],
            SM.LOG_SCHEMA)

    logs, out, ck = f"{tmpdir_path}/logs", f"{tmpdir_path}/alarm", f"{tmpdir_path}/ck"
    # batch 1: errors at 0:01 and 0:07, then traffic up to 1:00 (watermark moves to 0:50)
    rows([(60, 500), (420, 500), (3600, 200)]).write.mode("append").json(logs)
    SM.start_alarm_stream(spark, logs, out, ck).awaitTermination(300)
    # a second trigger lets the advanced watermark evict the closed periods
    rows([(3700, 200)]).write.mode("append").json(logs)
    SM.start_alarm_stream(spark, logs, out, ck).awaitTermination(300)
    first = sorted((r["period_start"], r["errors"]) for r in spark.read.parquet(out).collect())
    assert first == [(t0, 1), (t0 + dt.timedelta(seconds=300), 1)]
    # batch 3: a late error inside the first period, far behind the watermark, is dropped
    rows([(30, 500), (7300, 200)]).write.mode("append").json(logs)
    SM.start_alarm_stream(spark, logs, out, ck).awaitTermination(300)
    again = sorted((r["period_start"], r["errors"]) for r in spark.read.parquet(out).collect())
    assert again == first


def test_scoring_stream_with_pipeline_model(spark, tmpdir_path):
    from pyspark.sql import functions as F

    from cartwheel.operators import train as T
    from cartwheel.plans.feature_queries import split_sessions

    s = split_sessions(spark, SF_SMALL)
    train = T.with_training_columns(s.filter(F.col("split") == "train"), s.filter(F.col("split") == "train"))
    model = T.fit_candidate(T.production_candidates(forest_trees=5, forest_depth=3)[2], train)
    reqs = C.request_bodies(load_sessions(spark, SF_SMALL))
    reqs.write.json(f"{tmpdir_path}/in")
    q = SS.start_scoring_stream(spark, f"{tmpdir_path}/in", f"{tmpdir_path}/ok", f"{tmpdir_path}/bad",
                                f"{tmpdir_path}/ck", model, 0.5, "rf-v1")
    q.awaitTermination(300)
    ok, bad = spark.read.parquet(f"{tmpdir_path}/ok"), spark.read.parquet(f"{tmpdir_path}/bad")
    assert ok.count() + bad.count() == reqs.count() and ok.count() > 0


def test_request_log_line_fields(spark):
    import json

    log = MON.access_log_from_events(read_table(spark, SF_SMALL, "events"))
    lines = [json.loads(r["line"]) for r in MON.log_lines(log).limit(50).collect()]
    assert lines and all(set(x) == {"duration_ms", "method", "model_version", "request_id", "route", "status"}
                         for x in lines)
    assert all(x["duration_ms"] >= 0 and x["status"] in (200, 500) for x in lines)
    assert {x["route"] for x in lines} <= {"/health", "/v1/model/metadata", "/v1/predict"}
