from pyspark.sql import functions as F

from cartwheel.operators.champion import train_champion
from cartwheel.sources import artifacts
from cartwheel.sources.sessions import load_sessions
from tests.conftest import SF_SMALL


def test_champion_on_separable_sessions(spark, tmpdir_path):
    """Separable signals by label (as in the reference's integration test): champion is not the
    prior baseline, test F1 ≥ 0.8, runs are logged and the artifact loads through its gates."""
    s = load_sessions(spark, SF_SMALL)
    y = F.col("Revenue")
    sep = (s.withColumn("BounceRates", F.when(y, 0.01).otherwise(0.15))
            .withColumn("ExitRates", F.when(y, 0.02).otherwise(0.18))
            .withColumn("PageValues", F.when(y, 30.0).otherwise(0.0)))
    out = train_champion(sep, tmpdir_path, forest_trees=10, forest_depth=4)
    assert not out.champion.startswith("dummy")
    assert out.test_metrics["f1"] >= 0.8
    runs = spark.read.parquet(f"{tmpdir_path}/runs")
    assert runs.count() == 7  # six candidates + the champion run
    champ = runs.filter("run_name = 'champion'").first()
    assert champ["params"]["model"] == out.champion and "test_f1" in champ["metrics"]
    model, manifest = artifacts.load_artifact(spark, f"{tmpdir_path}/artifact", manifest_features(out))
    assert manifest["champion"] == out.champion
    assert manifest["dataset"]["rows"] == s.count() and 0 < manifest["dataset"]["positive_rate"] < 1


def manifest_features(out):
    return out.manifest["feature_names"]


def test_promotion_gate_keeps_test_untouched(spark, tmpdir_path):
    s = load_sessions(spark, SF_SMALL)
    first = train_champion(s, f"{tmpdir_path}/a", forest_trees=5, forest_depth=3)
    again = train_champion(s, f"{tmpdir_path}/b", forest_trees=5, forest_depth=3,
                           previous_artifact=f"{tmpdir_path}/a/artifact")
    # same data, same seed: the new champion does not beat the previous one
    assert first.promoted and not again.promoted and again.test_metrics == {}
    import os
    assert not os.path.exists(f"{tmpdir_path}/b/artifact")
    assert spark.read.parquet(f"{tmpdir_path}/b/runs").count() == 6  # candidates logged, no champion run
