import glob
import os

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from cartwheel.operators import scoring as N
from cartwheel.sources import artifacts, runlog


@pytest.fixture()
def tiny_model(spark):
    df = spark.createDataFrame([(0.0, 1.0, 0.0), (1.0, 0.0, 1.0), (0.1, 0.9, 0.0), (0.9, 0.2, 1.0)],
                               "a double, b double, label double")
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"),
                            LogisticRegression(featuresCol="features", labelCol="label")])
    return pipe.fit(df), df


def test_artifact_round_trip_and_tamper(spark, tmpdir_path, tiny_model):
    model, df = tiny_model
    path = f"{tmpdir_path}/art"
    artifacts.write_artifact(model, path, feature_names=["a", "b"], threshold=0.42, model_version="test-v1")
    m, man = artifacts.load_artifact(spark, path, ["a", "b"])
    assert man["threshold"] == 0.42 and man["model_version"] == "test-v1"
    assert m.transform(df).count() == 4
    with pytest.raises(artifacts.ArtifactError, match="feature gate"):
        artifacts.load_artifact(spark, path, ["b", "a"])
    target = sorted(glob.glob(f"{path}/model-*/**/part-*", recursive=True))[0]
    with open(target, "ab") as fh:
        fh.write(b"tampered")
    with pytest.raises(artifacts.ArtifactError, match="checksum gate"):
        artifacts.load_artifact(spark, path, ["a", "b"])


def test_schema_version_gate(spark, tmpdir_path, tiny_model):
    model, _ = tiny_model
    path = f"{tmpdir_path}/art"
    artifacts.write_artifact(model, path, feature_names=["a", "b"], threshold=0.5, model_version="v")
    man = spark.read.json(f"{path}/manifest").withColumn("schema_version", F.lit("999"))
    man.write.mode("overwrite").json(f"{path}/manifest2")
    os.rename(f"{path}/manifest", f"{path}/manifest_old")
    os.rename(f"{path}/manifest2", f"{path}/manifest")
    with pytest.raises(artifacts.ArtifactError, match="schema gate"):
        artifacts.load_artifact(spark, path)
    assert N.health(artifacts.health_record(spark, path)).first()["status"] == "degraded"


def test_scoring_is_inclusive_and_projects_features(spark, tiny_model):
    model, df = tiny_model
    wide = df.withColumn("extra", F.lit("ignored"))
    out = N.score_with_model(wide, model, ["a", "b"], 0.5, "v1")
    assert out.columns == ["will_purchase", "purchase_probability", "threshold", "model_version"]
    d = spark.createDataFrame([(0.73,), (0.2,), (0.5,)], "p double")
    got = [r["will_purchase"] for r in N.decide(d, F.col("p"), 0.5, "v").collect()]
    assert got == [True, False, True]


def test_run_log_status_and_params_as_text(spark, tmpdir_path):
    runs = spark.createDataFrame([("r1", "forest", 300, 0.8)], "run_name string, family string, trees int, f1 double")
    rec = runlog.run_records(runs, "exp", metric_columns=["f1"], param_columns=["family", "trees"])
    runlog.append_runs(rec, f"{tmpdir_path}/runs")
    runlog.append_runs(runlog.run_records(runs, "exp", metric_columns=["f1"], param_columns=["family"],
                                          status="FAILED"), f"{tmpdir_path}/runs")
    back = runlog.read_runs(spark, f"{tmpdir_path}/runs")
    assert sorted(r["status"] for r in back.collect()) == ["FAILED", "FINISHED"]
    row = back.filter(F.col("status") == "FINISHED").first()
    assert row["params"]["trees"] == "300" and row["metrics"]["f1"] == 0.8
    long = runlog.metrics_long(rec, prefix="validation_").first()
    assert long["metric"] == "validation_f1"
    with pytest.raises(ValueError):
        runlog.run_records(runs, "exp", metric_columns=["f1"], param_columns=[], status="RUNNING")
