"""Leaderboards and champion selection (K1–K8) over a ``runs`` table.

``runs``: run_name, family, model, feature_set, f1, pr_auc, roc_auc,
precision, recall, threshold — one row per candidate, so these tables are
small; orderings always end in ``run_name`` so ties are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LEADERBOARD_COLUMNS = ("run_name", "family", "model", "feature_set", "f1", "pr_auc", "roc_auc", "precision",
                       "recall", "threshold")


def leaderboard(runs: DataFrame, metric: str = "f1") -> DataFrame:
    """K1 / K8: the 10 leaderboard columns, best metric first, name breaks ties."""
    return runs.select(*LEADERBOARD_COLUMNS).orderBy(F.desc(metric), "run_name")


def champion_order(metric: str = "f1"):
    return [F.desc(metric), F.desc(F.coalesce(F.col("pr_auc"), F.lit(0.0))), F.asc("run_name")]


def champion(runs: DataFrame, metric: str = "f1") -> DataFrame:
    """K2: first run by (−metric, −pr_auc (default 0), name).  Raises on an empty table / missing metric."""
    if metric not in runs.columns:
        raise ValueError(f"metric {metric!r} is missing")
    if runs.isEmpty():
        raise ValueError("no candidate runs")
    return runs.orderBy(*champion_order(metric)).limit(1)


def top_k(runs: DataFrame, k: int, metric: str = "f1") -> DataFrame:
    """K3: the k best runs (TakeOrderedAndProject; the limit is the feature)."""
    return runs.orderBy(F.desc(metric), "run_name").limit(k)


def best_per_family(runs: DataFrame, metric: str = "f1", exclude_families: tuple[str, ...] = ()) -> DataFrame:
    """K4 / K6: best run of each family (optionally dropping families first)."""
    r = runs.filter(~F.col("family").isin(*exclude_families)) if exclude_families else runs
    w = Window.partitionBy("family").orderBy(F.desc(metric), "run_name")
    return r.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1).drop("_r")


def promotion_gate(runs: DataFrame, previous_f1: DataFrame, metric: str = "f1") -> DataFrame:
    """K7: best current run (by K2's order) vs. the previous champion's validation metric (one-row table
    ``previous_f1`` with column ``previous``); ``promote`` is true only when strictly better."""
    # stack current runs and the previous value, then one aggregation — no join needed
    rank = F.struct((-F.col(metric)).alias("m"), (-F.coalesce(F.col("pr_auc"), F.lit(0.0))).alias("p"), F.col("run_name"))
    both = runs.select("run_name", F.col(metric).alias("_m"), rank.alias("_rank"), F.lit(False).alias("_prev")).unionByName(
        previous_f1.select(F.lit(None).cast("string").alias("run_name"), F.col("previous").alias("_m"),
                           F.lit(True).alias("_prev")), allowMissingColumns=True)
    g = both.agg(F.min_by(F.struct("_m", "run_name"), F.when(~F.col("_prev"), F.col("_rank"))).alias("_b"),
                 F.max(F.when(F.col("_prev"), F.col("_m"))).alias("previous"))
    return g.select(F.col("_b.run_name").alias("run_name"), F.col("_b._m").alias("best"), "previous",
                    (F.col("_b._m") > F.col("previous")).alias("promote"))
