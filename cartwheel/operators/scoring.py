"""Table scoring (N1, N3, N7) — a narrow map stage, no shuffle.

A scorer is either a fitted ``PipelineModel`` (probability vector → positive
class probability) or a closed-form Column expression.  Decision rule is
inclusive: ``p >= threshold``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def positive_probability(scored: DataFrame, probability_col: str = "probability") -> Column:
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(F.col(probability_col))[1]


def decide(df: DataFrame, probability: Column, threshold: float, version: str,
           keep: Sequence[str] = ()) -> DataFrame:
    """Append will_purchase / purchase_probability / threshold / model_version."""
    p = probability
    return df.select(
        *keep,
        (p >= F.lit(float(threshold))).alias("will_purchase"),
        p.alias("purchase_probability"),
        F.lit(float(threshold)).alias("threshold"),
        F.lit(version).alias("model_version"),
    )


def score_with_model(df: DataFrame, model, feature_names: Sequence[str], threshold: float, version: str,
                     keep: Sequence[str] = ()) -> DataFrame:
    """N1 + N3: project the bundle's feature list (a reduced list still serves a full row), score, decide.

    ``model`` is a fitted ``PipelineModel`` or a function from the projected rows to a probability Column."""
    inputs = df.select(*keep, *feature_names)
    if not hasattr(model, "transform"):
        return decide(inputs, model(inputs), threshold, version, keep)
    out = model.transform(inputs)
    return decide(out, positive_probability(out), threshold, version, keep)


def health(manifest: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Model status record per manifest row — 'ok' when every gate passes, else 'degraded'."""
    gates = [c for c in manifest.columns if c.startswith("gate_")]
    ok = F.lit(True)
    for g in gates:
        ok = ok & F.coalesce(F.col(g), F.lit(False))
    return manifest.select(
        *keep, F.when(ok, "ok").otherwise("degraded").alias("status"),
        F.when(ok, F.col("model_version")).alias("model_version"),
    )


def predict_for_run(registry: dict, run_name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Scores (keys…, score) of any registered run by name.

    Registry entries: {"kind": "model", "model": PipelineModel}, {"kind": "blend", "members": (a, b),
    "weights": (wa, wb)} composed from member scores joined on the row keys, or {"kind": "calibrated",
    "base": name, "calibrator": isotonic.IsotonicMap}.  Unknown kinds are an error.
    """
    from pyspark.ml.functions import vector_to_array

    if run_name not in registry:
        raise KeyError(f"unknown run {run_name!r}")
    entry = registry[run_name]
    kind = entry.get("kind")
    if kind == "model":
        out = entry["model"].transform(df)
        return out.select(*keys, vector_to_array("probability")[1].alias("score"))
    if kind == "blend":
        (a, b), (wa, wb) = entry["members"], entry["weights"]
        sa = predict_for_run(registry, a, df, keys).withColumnRenamed("score", "_a")
        sb = predict_for_run(registry, b, df, keys).withColumnRenamed("score", "_b")
        return sa.join(sb, list(keys)).select(*keys, (F.lit(wa) * F.col("_a") + F.lit(wb) * F.col("_b")).alias("score"))
    if kind == "calibrated":
        base = predict_for_run(registry, entry["base"], df, keys)
        cal = entry["calibrator"].transform(base)
        return cal.select(*keys, F.col("calibrated").alias("score"))
    raise ValueError(f"unknown model kind for run {run_name!r}")
