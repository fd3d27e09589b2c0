"""Repeated ids across batches, and a model that changes while the stream runs."""

from __future__ import annotations

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import contract as C
from cartwheel.operators import train as T
from cartwheel.plans.feature_queries import split_sessions
from cartwheel.schema import FEATURE_COLUMNS
from cartwheel.sources import artifacts
from cartwheel.sources.sessions import load_sessions
from cartwheel.streaming import scoring as SS
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def bodies(spark):
    good = C.request_bodies(load_sessions(spark, SF_SMALL).where("(user_id * 31 + day(session_date)) % 20 > 12"))
    return [r["body"] for r in good.limit(6).collect()]


def put(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as out:
        out.write("".join(json.dumps({"request_id": i, "body": b, "ts": f"2024-01-01T00:{m:02d}:00"}) + "\n" for i, b, m in rows))
    stamp = time.time() - 1000 + int(name)
    os.utime(f"{folder}/{name}.json", (stamp, stamp))


def test_repeated_ids_are_scored_once_within_the_watermark(spark, tmpdir_path, bodies):
    put(f"{tmpdir_path}/in", "0", [("a", bodies[0], 1), ("a", bodies[0], 1), ("b", bodies[1], 2), (None, bodies[2], 2), (None, bodies[3], 2)])
    put(f"{tmpdir_path}/in", "1", [("a", bodies[0], 3), ("c", bodies[4], 3), (None, bodies[2], 2), ("bad", "not json", 3)])
    put(f"{tmpdir_path}/in", "2", [("d", bodies[5], 59), ("bad", "not json", 4)])
    q = SS.start_scoring_stream(spark, f"{tmpdir_path}/in", f"{tmpdir_path}/ok", f"{tmpdir_path}/bad", f"{tmpdir_path}/ck", SS.closed_form_scorer, 0.3,
                                "v", max_files_per_trigger=1, watermark="20 minutes")
    q.awaitTermination(300)
    ids = sorted((r[0] or "") for r in spark.read.parquet(f"{tmpdir_path}/ok").select("request_id").collect())
    assert ids == ["", "", "a", "b", "c", "d"]
    assert spark.read.parquet(f"{tmpdir_path}/bad").count() == 1


def test_model_changes_between_batches(spark, tmpdir_path, bodies):
    s = split_sessions(spark, SF_SMALL)
    train = s.filter(F.col("split") == "train")
    model = T.fit_candidate(T.production_candidates(forest_trees=3, forest_depth=2)[2], T.with_training_columns(train, train))
    for v, threshold in (("one", 0.25), ("two", 0.75)):
        artifacts.write_artifact(model, f"{tmpdir_path}/{v}", feature_names=list(FEATURE_COLUMNS), threshold=threshold, model_version=v, champion="rf", metrics={})
    slot = SS.ModelSlot(spark, f"{tmpdir_path}/models", list(FEATURE_COLUMNS))

    def run(name):
        put(f"{tmpdir_path}/in", name, [(f"r{name}{i}", b, 1) for i, b in enumerate(bodies[:2])])
        q = SS.start_scoring_stream(spark, f"{tmpdir_path}/in", f"{tmpdir_path}/ok", f"{tmpdir_path}/bad", f"{tmpdir_path}/ck", slot)
        q.awaitTermination(300)

    run("0")  # nothing published yet
    assert slot.problem and spark.read.parquet(f"{tmpdir_path}/bad").where(F.array_contains("reasons", SS.UNAVAILABLE)).count() == 2
    SS.publish_model(spark, f"{tmpdir_path}/models", f"{tmpdir_path}/one")
    run("1")
    SS.publish_model(spark, f"{tmpdir_path}/models", f"{tmpdir_path}/two")
    run("2")
    SS.publish_model(spark, f"{tmpdir_path}/models", f"{tmpdir_path}/nowhere")
    run("3")
    assert slot.problem  # the model in use stays
    got = {r["request_id"]: (r["model_version"], r["threshold"]) for r in spark.read.parquet(f"{tmpdir_path}/ok").collect()}
    assert got == {**{f"r1{i}": ("one", 0.25) for i in range(2)}, **{f"r{n}{i}": ("two", 0.75) for n in (2, 3) for i in range(2)}}


def test_swap_in_the_middle_of_one_run(spark, tmpdir_path, bodies):
    """Files of one run: the manifest changes after the first batch."""
    class Turning:
        def __init__(self):
            self.calls = 0

    turn = Turning()

    class Slot(SS.ModelSlot):
        def current(self):
            turn.calls += 1
            return SS.closed_form_scorer, 0.1 * turn.calls, f"v{turn.calls}"

    for n in range(3):
        put(f"{tmpdir_path}/in", str(n), [(f"{n}", bodies[n], n)])
    q = SS.start_scoring_stream(spark, f"{tmpdir_path}/in", f"{tmpdir_path}/ok", f"{tmpdir_path}/bad", f"{tmpdir_path}/ck", Slot(spark, ""),
                                max_files_per_trigger=1, watermark="1 hour")
    q.awaitTermination(300)
    assert {r["request_id"]: r["model_version"] for r in spark.read.parquet(f"{tmpdir_path}/ok").collect()} == {"0": "v1", "1": "v2", "2": "v3"}
