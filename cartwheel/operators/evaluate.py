"""Exact evaluation of scored tables (F22, H1–H15), single or grouped.

Input: rows with a score (double), a boolean label and optional group
columns (e.g. ``run_name``).  Prediction rule: score >= threshold.

Plan shape: rows collapse to distinct (group, score) points with positive /
negative counts (partial aggregation), cumulative counts along descending
score come from ``running.running_sums`` (bucketed, no single-task window),
and every curve metric is a sum over points:

* average precision  = Σ pos_i · precision_i / P
* ROC-AUC (trapezoid) = Σ neg_i · (2·tp_i − pos_i) / (2·P·N)

so no ``lag`` over a global order is needed.  Threshold-grid metrics (cost
curve) bucket scores to the grid index first and work on ≤ 100 rows per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.expr import r6
from cartwheel.operators.joins import join_on
from cartwheel.operators.running import bucket_count, quantile_bucket, running_sums
from cartwheel.session import materialize

N_BUCKETS = 16
_G = "_all"


def _grouped(df: DataFrame, groups: Sequence[str]) -> tuple[DataFrame, list[str], bool]:
    """Ungrouped input gets a constant group column so every join below is a keyed
    (broadcast-hash) join against a table with one row per group."""
    if groups:
        return df, list(groups), False
    return df.withColumn(_G, F.lit(0)), [_G], True


def _ungroup(df: DataFrame, added: bool) -> DataFrame:
    return df.drop(_G) if added else df


def _attach(df: DataFrame, small: DataFrame, groups: Sequence[str], added: bool) -> DataFrame:
    """Attach a table with one row per group.  Grouped: a NULL-safe join on the group keys (AQE broadcasts the
    group table by its measured size).  Ungrouped: the single row is a handful of numbers — pulled once and
    attached as literals, NULL where the input is empty, so no join at all."""
    if added:
        row = small.first()
        return df.select("*", *[F.lit(row[f.name] if row else None).cast(f.dataType).alias(f.name)
                                for f in small.schema if f.name not in groups])
    return join_on(df, small, groups, "inner")


def _counts(scored: DataFrame, groups: Sequence[str], score: str, label: str) -> DataFrame:
    y = F.col(label).cast("int")
    return scored.groupBy(*groups, F.col(score).alias("score")).agg(
        F.sum(y).cast("bigint").alias("pos"), F.sum(1 - y).cast("bigint").alias("neg"))


def pr_points(scored: DataFrame, *, groups: Sequence[str] = (), score: str = "score", label: str = "label",
              n_buckets: int | None = None) -> DataFrame:
    """H1: one row per (group, distinct score): pos, neg, tp, fp, P, N, precision, recall, f1."""
    scored, groups, added = _grouped(scored, groups)
    # the points feed the cut points, the running sums and the totals: the rows are read once for all three
    pts = materialize(_counts(scored, groups, score, label), "score-points")
    # bucket count grows with the cluster's shuffle width (cut points: one approxQuantile pass)
    nb = n_buckets or bucket_count(scored, N_BUCKETS)
    cum = running_sums(pts, bucket=quantile_bucket(pts, "score", nb, descending=True, rel_error=1.0 / (4 * nb)),
                       order=[F.desc("score")], sums=["pos", "neg"], partition_by=groups)
    cum = cum.withColumnRenamed("pos_cum", "tp").withColumnRenamed("neg_cum", "fp")
    totals = pts.groupBy(*groups).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    j = _attach(cum, totals, groups, added)
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    recall = F.when(F.col("P") == 0, F.lit(1.0)).otherwise(F.col("tp") / F.col("P"))
    out = j.select("*", precision.alias("precision"), recall.alias("recall"))
    f1 = F.when(F.col("precision") + F.col("recall") == 0, F.lit(0.0)).otherwise(
        2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
    return _ungroup(out.withColumn("f1", f1), added)


def f1_threshold(points: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """H2: per group the F1-optimal threshold; ties go to the lowest threshold.

    A struct ordering avoids a window: pick max (f1, -score).  An empty curve has no row here;
    ``fitted_threshold`` gives its fallback.
    """
    best = points.groupBy(*groups).agg(
        F.max(F.struct(F.col("f1"), (-F.col("score")).alias("neg_score"))).alias("_b"))
    return best.select(*groups, (-F.col("_b.neg_score")).alias("threshold"), F.col("_b.f1").alias("best_f1"))


def fitted_threshold(points: DataFrame) -> float:
    """H2 of one curve as a number; 0.5 for an empty one."""
    best = f1_threshold(points).first()
    return 0.5 if best is None or best["threshold"] is None else float(best["threshold"])


def _curve_fields() -> list[Column]:
    """ROC-AUC and average precision as sums over points; NULL where a group lacks the class that the metric divides
    by.  Products of counts are doubles: P · N leaves BIGINT at 5e9 rows."""
    d = lambda c: F.col(c).cast("double")
    auc = F.try_divide(F.sum(d("neg") * (2 * d("tp") - d("pos"))), 2.0 * F.first(d("P")) * F.first(d("N")))
    return [auc.alias("roc_auc"), F.try_divide(F.sum(d("pos") * F.col("precision")), F.first(d("P"))).alias("pr_auc")]


def curve_summary(points: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """H3 + H4: ROC-AUC and average precision per group from the point table."""
    return points.groupBy(*groups).agg(*_curve_fields())


def at_threshold(scored: DataFrame, thresholds: DataFrame | float, *, groups: Sequence[str] = (),
                 score: str = "score", label: str = "label") -> DataFrame:
    """F22 + H5 + H6: confusion counts, precision, recall, F1 (zero_division=0) and Brier per group.

    ``thresholds`` is a float or a table (groups…, threshold) with one row per group.
    """
    if isinstance(thresholds, (int, float)):
        base = scored.withColumn("threshold", F.lit(float(thresholds)))
    elif not groups or groups == [_G]:
        row = thresholds.first()
        base = scored.withColumn("threshold", F.lit(float(row["threshold"]) if row else 0.5))
    else:
        base = join_on(scored, thresholds.select(*groups, "threshold"), groups, "inner")
    pred = F.col(score) >= F.col("threshold")
    y = F.col(label)
    agg = base.groupBy(*groups, "threshold").agg(
        F.count_if(~y & ~pred).alias("true_negative"), F.count_if(~y & pred).alias("false_positive"),
        F.count_if(y & ~pred).alias("false_negative"), F.count_if(y & pred).alias("true_positive"),
        F.avg(F.pow(F.col(score) - y.cast("double"), 2)).alias("brier_score"),
    )
    tp, fp, fn = F.col("true_positive"), F.col("false_positive"), F.col("false_negative")
    precision = F.when(tp + fp == 0, 0.0).otherwise(tp / (tp + fp))
    recall = F.when(tp + fn == 0, 0.0).otherwise(tp / (tp + fn))
    f1 = F.when(2 * tp + fp + fn == 0, 0.0).otherwise(2 * tp / (2 * tp + fp + fn))
    return agg.select("*", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"))


def _record_at_best(points: DataFrame, groups: Sequence[str]) -> DataFrame:
    """All fields at each group's F1-optimal threshold from one aggregate of the points: the best point carries its
    counts, and the Brier score is a sum over points weighted by their rows."""
    d = lambda c: F.col(c).cast("double")
    brier = F.sum(d("pos") * F.pow(F.col("score") - 1.0, 2) + d("neg") * F.pow(F.col("score"), 2)) / F.sum(d("pos") + d("neg"))
    best = F.max(F.struct("f1", (-F.col("score")).alias("neg_score"), "tp", "fp", "P", "N"))
    r = points.groupBy(*groups).agg(best.alias("b"), brier.alias("brier_score"), *_curve_fields())
    tp, fp, fn = F.col("b.tp"), F.col("b.fp"), F.col("b.P") - F.col("b.tp")
    return r.select(*groups, (-F.col("b.neg_score")).alias("threshold"), "roc_auc", "pr_auc", "brier_score",
                    F.when(tp + fp == 0, 0.0).otherwise(tp / (tp + fp)).alias("precision"), F.when(tp + fn == 0, 0.0).otherwise(tp / (tp + fn)).alias("recall"),
                    F.when(2 * tp + fp + fn == 0, 0.0).otherwise(2 * tp / (2 * tp + fp + fn)).alias("f1"),
                    (F.col("b.N") - fp).alias("true_negative"), fp.alias("false_positive"), fn.alias("false_negative"), tp.alias("true_positive"))


def metric_record(scored: DataFrame, *, groups: Sequence[str] = (), score: str = "score", label: str = "label",
                  threshold: float | DataFrame | None = None) -> DataFrame:
    """H7: the 10-field metric record per group (+ threshold).  Threshold defaults to H2's."""
    scored, groups, added = _grouped(scored, groups)
    pts = pr_points(scored.where(F.col(score).isNotNull()), groups=groups, score=score, label=label)
    if threshold is None:
        j = _record_at_best(pts, groups)
    else:
        j = _attach(at_threshold(scored, threshold, groups=groups, score=score, label=label), curve_summary(pts, groups), groups, added)
    out = j.select(
        *groups, r6(F.col("threshold")).alias("threshold"),
        r6(F.col("roc_auc")).alias("roc_auc"), r6(F.col("pr_auc")).alias("pr_auc"),
        r6(F.col("precision")).alias("precision"), r6(F.col("recall")).alias("recall"), r6(F.col("f1")).alias("f1"),
        r6(F.col("brier_score")).alias("brier_score"),
        *[F.col(c).cast("bigint").alias(c) for c in
          ("true_negative", "false_positive", "false_negative", "true_positive")],
    )
    return _ungroup(out, added)


def reliability_curve(scored: DataFrame, *, groups: Sequence[str] = (), score: str = "score",
                      label: str = "label", n_bins: int = 10) -> DataFrame:
    """H8: quantile-binned reliability curve; bin = number of inner edges < score; empty bins dropped."""
    scored, groups, added = _grouped(scored, groups)
    from cartwheel.operators.quantiles import quantile_columns

    qs = {f"e{i}": i / n_bins for i in range(1, n_bins)}
    wide = quantile_columns(scored.select(*groups, score), groups, score, qs)
    edges = wide.select(*groups, F.array(*[F.col(k) for k in qs]).alias("_e"))
    j = _attach(scored, edges, groups, added)  # one row of edges per group
    s = F.col(score)
    # bin = number of inner edges strictly below the score (plain comparisons, no lambda)
    b = sum((F.col("_e")[k] < s).cast("int") for k in range(n_bins - 1)).alias("bin")
    return _ungroup(j.groupBy(*groups, b).agg(
        r6(F.avg(s)).alias("mean_predicted"), r6(F.avg(F.col(label).cast("double"))).alias("fraction_positive"),
        F.count(F.lit(1)).alias("rows"),
    ), added)


# The cost threshold grid is linspace(0.01, 0.99, 99) — t_m = m·step + 0.01 with
# step = (0.99 − 0.01) / 98, last point exactly 0.99 (25 of these doubles differ from m/100).
GRID_START, GRID_STOP, GRID_NUM = 0.01, 0.99, 99


def grid_threshold(m: Column, start: float = GRID_START, stop: float = GRID_STOP, num: int = GRID_NUM) -> Column:
    """The m-th grid threshold (0-based), computed with the same double operations as linspace."""
    step = (stop - start) / (num - 1)
    return F.when(m >= num - 1, F.lit(stop)).otherwise(m.cast("double") * F.lit(step) + F.lit(start))


def with_grid_index(df: DataFrame, score: str, name: str = "idx", start: float = GRID_START,
                    stop: float = GRID_STOP, num: int = GRID_NUM) -> DataFrame:
    """Add ``name`` = number of grid thresholds ≤ score (0…num), exact at the boundaries: an
    arithmetic guess, then corrections against the thresholds themselves.  Each correction is
    its own projection so the guess is computed once (no nested copies of the expression)."""
    step = (stop - start) / (num - 1)
    x = F.col(score)
    out = df.withColumn(name, F.least(F.greatest(F.floor((x - F.lit(start)) / F.lit(step)), F.lit(-1)),
                                      F.lit(num - 1)).cast("int"))
    j = F.col(name)
    for _ in range(2):
        out = out.withColumn(name, F.when((j < num - 1) & (grid_threshold(j + 1, start, stop, num) <= x), j + 1)
                             .otherwise(j))
    for _ in range(2):
        out = out.withColumn(name, F.when((j >= 0) & (grid_threshold(j, start, stop, num) > x), j - 1).otherwise(j))
    return out.withColumn(name, j + 1)


def cost_curve(scored: DataFrame, *, groups: Sequence[str] = (), score: str = "score", label: str = "label",
               ratios: Sequence[float] = (1, 3, 5, 10), cost_fp: float = 1.0) -> DataFrame:
    """H9: cost_fn·FN + cost_fp·FP at each grid threshold for each cost ratio.

    Scores are bucketed to the grid index (≤ 100 rows per group), then
    cumulative sums run over that dense table — never a rows × thresholds product.
    Output: i (1-based grid position), threshold, fn, fp, tp, cost_ratio, cost.
    """
    scored, groups, added = _grouped(scored, groups)
    y = F.col(label).cast("int")
    b = with_grid_index(scored, score, "idx").groupBy(*groups, "idx").agg(
        F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))
    tot = b.groupBy(*groups).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    dense = tot.select(*groups, "P", "N", F.explode(F.sequence(F.lit(0), F.lit(GRID_NUM - 1))).alias("idx"))
    d = dense.join(b, [*groups, "idx"], "left").fillna(0, ["pos", "neg"])
    w = Window.partitionBy(*groups).orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    # threshold m: FN = positives with fewer than m+1 thresholds ≤ score; FP = the other negatives
    c = d.select(*groups, "P", "N", (F.col("idx") + 1).alias("i"), grid_threshold(F.col("idx")).alias("threshold"),
                 F.sum("pos").over(w).alias("fn"), F.sum("neg").over(w).alias("neg_below"))
    c = c.select(*groups, "i", "threshold", "fn",
                 (F.col("N") - F.col("neg_below")).alias("fp"), (F.col("P") - F.col("fn")).alias("tp"))
    r = c.select("*", F.explode(F.array(*[F.lit(float(x)) for x in ratios])).alias("cost_ratio"))
    return _ungroup(r.withColumn("cost", F.col("cost_ratio") * F.col("fn") + F.lit(cost_fp) * F.col("fp")), added)


def cost_thresholds(curve: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Per (group, ratio) the first cost-minimising threshold, with precision / recall / F1 there."""
    best = curve.groupBy(*groups, "cost_ratio").agg(
        F.min(F.struct("cost", "i", "tp", "fp", "fn")).alias("_b"))
    tp, fp, fn = F.col("_b.tp"), F.col("_b.fp"), F.col("_b.fn")
    return best.select(
        *groups, "cost_ratio", F.round(grid_threshold(F.col("_b.i") - 1), 3).alias("threshold"),
        F.col("_b.cost").alias("cost"),
        r6(F.when(tp + fp == 0, 0.0).otherwise(tp / (tp + fp))).alias("precision"),
        r6(F.when(tp + fn == 0, 0.0).otherwise(tp / (tp + fn))).alias("recall"),
        r6(F.when(2 * tp + fp + fn == 0, 0.0).otherwise(2 * tp / (2 * tp + fp + fn))).alias("f1"),
    )


def fold_f1(scored: DataFrame, *, fold: str = "fold", groups: Sequence[str] = (), score: str = "score",
            label: str = "label", threshold: float = 0.5) -> DataFrame:
    """Mean over folds of F1 at a fixed threshold."""
    per = at_threshold(scored, threshold, groups=[*groups, fold], score=score, label=label)
    return per.groupBy(*groups).agg(r6(F.avg("f1")).alias("mean_f1"), F.count(F.lit(1)).alias("folds"))


def blend(df: DataFrame, a: str, b: str, wa: float = 0.5, wb: float = 0.5, name: str = "score") -> DataFrame:
    """Weighted blend of two score columns on the same rows."""
    return df.withColumn(name, F.lit(wa) * F.col(a) + F.lit(wb) * F.col(b))


def long_scores(df: DataFrame, keys: Sequence[str], score_columns: Sequence[str], label: str,
                name: str = "run_name") -> DataFrame:
    """Unpivot several score columns into (keys, run_name, label, score) for grouped evaluation."""
    return df.select(*keys, F.col(label).alias("label"), *score_columns).unpivot(
        [*keys, "label"], list(score_columns), name, "score")


def calibration_gate(records: DataFrame, base: str, candidates: Sequence[str], name: str = "run_name") -> DataFrame:
    """The lower-Brier candidate, kept only if it beats ``base`` (empty result otherwise)."""
    # one aggregation over the (small) records table: best candidate and the base side by side
    j = records.agg(
        F.min(F.when(F.col(name).isin(*candidates), F.struct("brier_score", name))).alias("_b"),
        F.max(F.when(F.col(name) == base, F.col("brier_score"))).alias("base_brier"))
    return j.filter(F.col("_b.brier_score") < F.col("base_brier")).select(
        F.col(f"_b.{name}").alias("method"), F.col("_b.brier_score").alias("brier_score"), "base_brier")


def lift(scored: DataFrame, base_rate: DataFrame, score: str = "score") -> DataFrame:
    """Base rate (from data, one row) and lift = score / base_rate per row."""
    rate = float(base_rate.first()["base_rate"])  # one number computed by Spark from the data
    return scored.withColumn("base_rate", F.lit(rate)).withColumn("lift", r6(F.try_divide(F.col(score), F.col("base_rate"))))
