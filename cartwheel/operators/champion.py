"""Champion training orchestration (M15) and experiment summary.

validate → split → fit candidates ({with, without} PageValues × {prior,
logistic, forest}) → F1 thresholds on validation → champion (K2 rule) →
**test evaluated once** → artifact + metrics report + run log.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.operators import contract as C
from cartwheel.operators import evaluate as H
from cartwheel.operators import ranking as K
from cartwheel.operators import split as G
from cartwheel.operators import train as T
from cartwheel.operators.features import columns_without
from cartwheel.schema import EXPECTED_COLUMNS, KEY_COLUMNS, LABEL
from cartwheel.session import materialize
from cartwheel.sources import artifacts, reports, runlog


@dataclass
class TrainingOutcome:
    champion: str
    threshold: float
    validation: DataFrame
    test_metrics: dict
    manifest: dict
    promoted: bool = True


def train_champion(sessions: DataFrame, out_dir: str, *, seed: int = 42, forest_trees: int = T.FOREST_TREES,
                   forest_depth: int = T.FOREST_DEPTH, model_version: str = "local", experiment: str = "champion",
                   previous_artifact: str | None = None, git_revision: str | None = None,
                   log=lambda msg: None) -> TrainingOutcome:
    """``_train`` with the run log told about a failure: a FAILED record names the error, which is raised again."""
    try:
        return _train(sessions, out_dir, seed=seed, forest_trees=forest_trees, forest_depth=forest_depth, model_version=model_version,
                      experiment=experiment, previous_artifact=previous_artifact, git_revision=git_revision, log=log)
    except Exception as error:
        failed = sessions.sparkSession.createDataFrame([("champion", type(error).__name__)], "run_name string, error string")
        runlog.append_runs(runlog.run_records(failed, experiment, metric_columns=(), param_columns=("error",), status="FAILED"), f"{out_dir}/runs")
        raise


def _train(sessions: DataFrame, out_dir: str, *, seed: int, forest_trees: int, forest_depth: int, model_version: str, experiment: str,
           previous_artifact: str | None, git_revision: str | None, log) -> TrainingOutcome:
    """Train, select and publish a champion.

    With ``previous_artifact`` the new champion must beat the previous champion's validation F1
    (K7); otherwise the test split stays untouched and nothing is published.
    """
    raw = sessions.select(*KEY_COLUMNS, *[F.col(c).cast("string").alias(c) for c in EXPECTED_COLUMNS])
    # The validated table feeds the split and every fit: it is written once as Parquet under
    # the shared checkpoint folder (cuts lineage, survives executor loss, keeps plans small).
    valid = C.validate(raw, strict=True, key_columns=KEY_COLUMNS, materialize=True).valid
    log("validated")
    split = G.stratified_split(valid, seed=seed)  # a comparison of hashes per row, nothing to keep
    facts = split.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col(LABEL).cast("int")).alias("positives")).first()
    dataset = {"rows": facts["rows"], "positives": facts["positives"],
               "positive_rate": facts["positives"] / facts["rows"]}
    train = split.filter(F.col("split") == "train")
    n_train = train.count()
    train = T.with_training_columns(train, train)
    validation = T.with_training_columns(split.filter(F.col("split") == "validation"), train)
    test = T.with_training_columns(split.filter(F.col("split") == "test"), train)
    cands = [*T.production_candidates(include_page_values=True, seed=seed, forest_trees=forest_trees,
                                      forest_depth=forest_depth, train_rows=n_train),
             *T.production_candidates(include_page_values=False, seed=seed, forest_trees=forest_trees,
                                      forest_depth=forest_depth, train_rows=n_train)]
    log("split")
    res = T.sweep(cands, train, validation)
    log("sweep")
    runs = materialize(T.runs_from_records(res.records, cands), "champion-runs")
    best = K.champion(runs).first()
    name, threshold = best["run_name"], float(best["threshold"])
    # every candidate run is logged (validation metrics), promoted or not
    records = runlog.run_records(runs, experiment, metric_columns=("f1", "pr_auc", "roc_auc", "precision", "recall",
                                                                   "threshold", "brier_score"),
                                 param_columns=("family", "model", "feature_set"))
    runlog.append_runs(runlog.prefixed(records, "validation_"), f"{out_dir}/runs")
    if previous_artifact is not None:
        prev = artifacts.read_manifest(runs.sparkSession, previous_artifact)
        previous_f1 = (prev.get("validation_metrics") or {}).get("f1")
        if previous_f1 is not None and not best["f1"] > previous_f1:
            return TrainingOutcome(name, threshold, runs, {}, prev, promoted=False)
    cand = next(c for c in cands if c.name == name)
    test_scores = T.score_candidate(cand, res.models[name], test)
    # the test split is scored once: everything below reads this one-row record
    record = H.metric_record(test_scores, score="score", label="label", threshold=threshold)
    row = record.first()
    test_rec = row.asDict()
    record = split.sparkSession.createDataFrame([row], record.schema)
    log("test")
    # reports and run log
    val_long = reports.record_to_long(runs.filter(F.col("run_name") == name).drop("run_name", "family", "model",
                                                                                    "feature_set"), "validation")
    test_long = reports.record_to_long(record, "test")
    reports.write_report(val_long.unionByName(test_long), f"{out_dir}/metrics.json")
    # the champion run: test metrics of the selected candidate (the seventh run)
    champ = record.select(
        F.lit("champion").alias("run_name"), F.lit("champion").alias("family"), F.lit(name).alias("model"),
        F.lit(cand.feature_set).alias("feature_set"), *[F.col(c) for c in ("f1", "pr_auc", "roc_auc", "precision",
                                                                              "recall", "threshold", "brier_score")])
    champ_rec = runlog.run_records(champ, experiment, metric_columns=("f1", "pr_auc", "roc_auc", "precision",
                                                                      "recall", "threshold", "brier_score"),
                                   param_columns=("family", "model", "feature_set"))
    runlog.append_runs(runlog.prefixed(champ_rec, "test_"), f"{out_dir}/runs")
    log("reports")
    manifest = {}
    model = res.models[name]
    if not isinstance(model, float):
        features = columns_without(*(("PageValues",) if "without" in name else ()))
        manifest = artifacts.write_artifact(model, f"{out_dir}/artifact", feature_names=features,
                                            threshold=threshold, model_version=model_version, champion=name,
                                            metrics={k: best[k] for k in ("f1", "pr_auc", "roc_auc")},
                                            test_metrics={k: v for k, v in test_rec.items() if isinstance(v, (int, float))},
                                            include_page_values="without" not in name, git_revision=git_revision,
                                            dataset=dataset)
    log("artifact")
    return TrainingOutcome(name, threshold, runs, test_rec, manifest)


def experiment_summary(runs: DataFrame) -> DataFrame:
    """Leaderboard rows as records (sorted by F1, then name)."""
    return K.leaderboard(runs)
