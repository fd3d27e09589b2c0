"""Data quality and descriptive aggregates over the session table.

Everything is a hash aggregation with map-side partial aggregation; wide
statistics are computed in one scan by unpivoting (``stack``) instead of one
job per column.  Duplicate analysis never windows over a duplicate group: it
groups on the compared columns once and aggregates the group table again, so
a group holding a third of all rows is just one partially-aggregated key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.expr import bool_key, is_missing, r6, unpivot
from cartwheel.operators.quantiles import quantile_columns
from cartwheel.schema import EXPECTED_COLUMNS, LABEL, NUMERIC_DESCRIBE_COLUMNS

# The seven columns of the duplicate fixture (FIXTURES.md §2); by default all columns are compared.
DUPLICATE_COLUMNS = (
    "Administrative", "Informational", "ProductRelated", "Month", "VisitorType", "Weekend", "Revenue",
)
# Activity metrics compared between duplicate and other rows.
ACTIVITY_COLUMNS = ("ProductRelated", "ProductRelated_Duration", "BounceRates", "ExitRates", "PageValues")
# Context columns of the conversion-spread analysis, and the signals by label.
CONTEXT_COLUMNS = ("OperatingSystems", "Browser", "Region", "TrafficType")
SIGNAL_COLUMNS = ("BounceRates", "ExitRates", "PageValues")
CONVERSION_KEYS = ("Month", "VisitorType", "Weekend", "TrafficType")
HISTOGRAM_COLUMNS = (
    "Administrative_Duration", "Informational_Duration", "ProductRelated_Duration",
    "BounceRates", "ExitRates", "PageValues",
)


def _label_double(label: str = LABEL):
    return F.col(label).cast("double")


def dataset_summary(df: DataFrame, columns: Sequence[str] = EXPECTED_COLUMNS, label: str = LABEL) -> DataFrame:
    """rows, columns, duplicate rows (over ``columns``), positives, positive rate — one row."""
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"), F.max(F.col(label).cast("int")).alias("pos"))
    return groups.agg(
        F.sum("n").cast("bigint").alias("rows"),
        F.lit(len(columns)).cast("bigint").alias("columns"),
        F.sum(F.col("n") - 1).cast("bigint").alias("duplicate_rows"),
        F.sum(F.col("n") * F.col("pos")).cast("bigint").alias("positive_count"),
        r6(F.sum(F.col("n") * F.col("pos")) / F.sum("n")).alias("positive_rate"),
    )


def _key_text(df: DataFrame, key: str):
    return bool_key(F.col(key), dict(df.dtypes)[key] == "boolean")


def conversion_by(df: DataFrame, key: str, label: str = LABEL) -> DataFrame:
    """F3 for one key: key (text, booleans lower-case), sessions, conversion rate; sorted by key."""
    return (
        df.groupBy(_key_text(df, key).alias("key"))
        .agg(F.count(F.lit(1)).alias("sessions"), r6(F.avg(_label_double(label))).alias("conversion_rate"))
        .orderBy("key")
    )


def conversion_by_context(df: DataFrame, keys: Sequence[str] = CONVERSION_KEYS, label: str = LABEL) -> DataFrame:
    """F3 for several keys in one pass (GROUPING SETS): section, key, sessions, conversion_rate."""
    proj = df.select(*[_key_text(df, k).alias(k) for k in keys], _label_double(label).alias("_y"))
    n = len(keys)
    gid = F.grouping_id(*keys)
    agg = proj.groupingSets([[F.col(k)] for k in keys], *keys).agg(
        F.count(F.lit(1)).alias("sessions"), r6(F.avg("_y")).alias("conversion_rate"), gid.alias("_gid"))
    # grouping_id() must be evaluated inside the aggregation; derive the section from it afterwards
    sec = F.lit(None).cast("string")
    for i, k in enumerate(keys):
        sec = F.when(F.col("_gid") == (((1 << n) - 1) ^ (1 << (n - 1 - i))), F.lit(k)).otherwise(sec)
    return agg.select(sec.alias("section"), F.coalesce(*keys).alias("key"), "sessions", "conversion_rate")


def conversion_by_month(df: DataFrame, months: Sequence[str], label: str = LABEL) -> DataFrame:
    """E8 + F3: conversion per Month reindexed on the calendar (missing months kept as NULL)."""
    spark = df.sparkSession
    dim = spark.createDataFrame([(i + 1, m) for i, m in enumerate(months)], "month_order int, Month string")
    agg = df.groupBy("Month").agg(
        F.count(F.lit(1)).alias("sessions"), r6(F.avg(_label_double(label))).alias("conversion_rate")
    )
    # dim has a fixed, tiny size (one row per calendar month): broadcasting it is bounded.
    return F.broadcast(dim).join(agg, "Month", "left").select("month_order", "Month", "sessions", "conversion_rate")


def describe_numeric(df: DataFrame, columns: Sequence[str] = NUMERIC_DESCRIBE_COLUMNS, *, exact: bool = True,
                     accuracy: int = 10000) -> DataFrame:
    """count, mean, std (n-1), min, quartiles (linear interpolation), max for each column.

    Exact quartiles come from ``quantiles.exact_quantiles`` (distributed, no
    per-column value map); ``exact=False`` uses ``percentile_approx``.
    """
    long = unpivot(df, [], columns, "column", "value")
    base = long.groupBy("column").agg(
        F.count("value").alias("count"), r6(F.avg("value")).alias("mean"),
        r6(F.stddev_samp("value")).alias("std"), F.min("value").alias("min"), F.max("value").alias("max"),
        *([] if exact else [F.percentile_approx("value", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)),
                                                accuracy).alias("_q")]))
    if exact:
        q = quantile_columns(long, ["column"], "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75})
        base = base.join(q, "column", "left")  # one row per described column; an all-NULL one has no quantiles
    else:
        base = base.select("*", *[F.col("_q")[i].alias(n) for i, n in enumerate(("p25", "p50", "p75"))])
    return base.select("column", "count", "mean", "std", "min", r6(F.col("p25")).alias("p25"),
                       r6(F.col("p50")).alias("p50"), r6(F.col("p75")).alias("p75"), "max")


def signal_means_by_label(df: DataFrame, columns: Sequence[str] = SIGNAL_COLUMNS, label: str = LABEL) -> DataFrame:
    """mean of each signal by label value (absent columns skipped)."""
    present = [c for c in columns if c in df.columns]
    long = unpivot(df.withColumn("_label", bool_key(F.col(label))), ["_label"], present, "column", "value")
    return long.groupBy("column", F.col("_label").alias("label")).agg(r6(F.avg("value")).alias("mean"))


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing (NULL or NaN) count per column, one aggregation pass then unpivot."""
    dtypes = dict(df.dtypes)
    cols = list(columns or df.columns)
    wide = df.agg(*[F.count_if(is_missing(c, dtypes[c])).alias(c) for c in cols])
    return unpivot(wide, [], cols, "column", "missing", cast="bigint")


def column_types(df: DataFrame) -> DataFrame:
    """column name and Spark type (schema metadata, no job)."""
    return df.sparkSession.createDataFrame(df.dtypes, "column string, type string")


def duplicate_groups(df: DataFrame, columns: Sequence[str] = EXPECTED_COLUMNS,
                     metrics: Sequence[str] = ()) -> DataFrame:
    """One row per distinct combination of ``columns``: n and per-metric sums.

    This is the only shuffle of the duplicate analysis; everything else
    aggregates this (much smaller) table.
    """
    return df.groupBy(*columns).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col(m).cast("double")).alias(f"sum_{m}") for m in metrics]
    )


def duplicate_report(df: DataFrame, columns: Sequence[str] = EXPECTED_COLUMNS) -> DataFrame:
    """Rows, extra copies, rows in duplicate groups, rows after de-duplication."""
    g = duplicate_groups(df, columns)
    return g.agg(
        F.sum("n").cast("bigint").alias("rows"),
        F.sum(F.col("n") - 1).cast("bigint").alias("extra_copies"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("bigint").alias("rows_in_groups"),
        F.count(F.lit(1)).cast("bigint").alias("rows_deduplicated"),
    )


def drop_duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """keep one copy per distinct row (full-row copies are interchangeable)."""
    return df.dropDuplicates(list(columns) if columns else None)


def with_total(df: DataFrame, column: str, name: str = "_total") -> DataFrame:
    """Attach the column total to every row: a distributed sum pulled as one number and
    attached as a literal (no global window, no join)."""
    total = df.agg(F.sum(column).alias(name)).first()[name]
    return df.withColumn(name, F.lit(total))


def _shares(g: DataFrame, key: str, weight, name: str) -> DataFrame:
    t = g.groupBy(key).agg(F.sum(weight).alias("_w")).filter(F.col("_w") > 0)
    return with_total(t, "_w").select(F.col(key), r6(F.col("_w") / F.col("_total")).alias(name))


def share_comparison(df: DataFrame, key: str, left: str, right: str,
                     columns: Sequence[str] = EXPECTED_COLUMNS) -> DataFrame:
    """Value shares of ``key`` in two row sets joined left on the key.

    Row sets: 'all' (every row), 'dup' (rows in duplicate groups), 'dedup'
    (one copy per group).  The window for the share runs over the small
    per-key table only.
    """
    g = duplicate_groups(df, columns)
    weights = {
        "all": F.col("n"),
        "dup": F.when(F.col("n") > 1, F.col("n")).otherwise(F.lit(0)),
        "dedup": F.lit(1),
    }
    a = _shares(g, key, weights[left], f"share_{left}")
    b = _shares(g, key, weights[right], f"share_{right}")
    out = a.join(b, key, "left")
    if dict(df.dtypes)[key] == "boolean":
        out = out.withColumn(key, bool_key(F.col(key)))
    return out


def duplicate_activity_means(df: DataFrame, columns: Sequence[str] = EXPECTED_COLUMNS,
                             metrics: Sequence[str] = ACTIVITY_COLUMNS) -> DataFrame:
    """Mean of each metric over duplicate rows and over the rest, joined on metric."""
    g = duplicate_groups(df, columns, metrics)
    dup = F.col("n") > 1
    sums = g.agg(
        F.sum(F.when(dup, F.col("n")).otherwise(0)).alias("n_dup"),
        F.sum(F.when(~dup, F.col("n")).otherwise(0)).alias("n_rest"),
        *[F.sum(F.when(dup, F.col(f"sum_{m}"))).alias(f"d_{m}") for m in metrics],
        *[F.sum(F.when(~dup, F.col(f"sum_{m}"))).alias(f"r_{m}") for m in metrics],
    )
    dup_t = unpivot(sums.select(*[(F.col(f"d_{m}") / F.col("n_dup")).alias(m) for m in metrics]), [], metrics,
                    "metric", "mean_duplicates")
    rest_t = unpivot(sums.select(*[(F.col(f"r_{m}") / F.col("n_rest")).alias(m) for m in metrics]), [], metrics,
                     "metric", "mean_rest")
    return dup_t.join(rest_t, "metric", "left").select(
        "metric", r6(F.col("mean_duplicates")).alias("mean_duplicates"), r6(F.col("mean_rest")).alias("mean_rest")
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Count and share per value, most frequent first (value breaks ties)."""
    c = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    return with_total(c, "count").select(
        "value", "count", r6(F.col("count") / F.col("_total")).alias("share")
    ).orderBy(F.desc("count"), "value")


def distinct_counts(df: DataFrame, columns: Sequence[str] = CONTEXT_COLUMNS, *, exact: bool = True) -> DataFrame:
    """distinct values per column (``exact=False`` → HyperLogLog++)."""
    long = unpivot(df, [], columns, "column", "value", cast="string")
    fn = F.countDistinct if exact else F.approx_count_distinct
    return long.groupBy("column").agg(fn("value").cast("bigint").alias("n_distinct"))


def context_rates(df: DataFrame, columns: Sequence[str] = CONTEXT_COLUMNS, min_sessions: int = 50,
                  label: str = LABEL) -> DataFrame:
    """conversion and count per value of each context column, groups with n ≥ min_sessions."""
    long = unpivot(df.withColumn("_y", _label_double(label)), ["_y"], columns, "column", "value", cast="bigint")
    return (
        long.groupBy("column", "value")
        .agg(r6(F.avg("_y")).alias("conversion_rate"), F.count(F.lit(1)).alias("sessions"))
        .filter(F.col("sessions") >= min_sessions)
        .orderBy("column", F.desc("conversion_rate"), "value")
    )


def context_spread(df: DataFrame, columns: Sequence[str] = CONTEXT_COLUMNS, min_sessions: int = 50,
                   label: str = LABEL) -> DataFrame:
    """F16: min, max and range of group conversion per context column, widest range first."""
    long = unpivot(df.withColumn("_y", _label_double(label)), ["_y"], columns, "column", "value", cast="bigint")
    rates = (
        long.groupBy("column", "value")
        .agg(F.avg("_y").alias("rate"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min_sessions)
    )
    return (
        rates.groupBy("column")
        .agg(F.min("rate").alias("min_rate"), F.max("rate").alias("max_rate"))
        .select("column", r6(F.col("min_rate")).alias("min_rate"), r6(F.col("max_rate")).alias("max_rate"),
                r6(F.col("max_rate") - F.col("min_rate")).alias("rate_range"))
        .orderBy(F.desc("rate_range"), "column")
    )


def tail_quantiles(df: DataFrame, columns: Sequence[str], *, exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """p99, p99.9, max and number of rows above p99 for each column.

    Two passes: quantiles per column (distributed exact form, or approximate),
    then a count against those per-column scalars joined on the column name
    (a table with one row per column, broadcast).
    """
    long = unpivot(df, [], columns, "column", "value")
    if exact:
        q = quantile_columns(long, ["column"], "value", {"p99": 0.99, "p999": 0.999})
    else:
        q = long.groupBy("column").agg(F.percentile_approx("value", F.array(F.lit(0.99), F.lit(0.999)),
                                                           accuracy).alias("_q")).select(
            "column", F.col("_q")[0].alias("p99"), F.col("_q")[1].alias("p999"))
    stats = long.join(F.broadcast(q.select("column", "p99")), "column").groupBy("column").agg(
        F.max("value").alias("max"), F.count_if(F.col("value") > F.col("p99")).alias("above_p99"))
    return q.join(F.broadcast(stats), "column").select(
        "column", r6(F.col("p99")).alias("p99"), r6(F.col("p999")).alias("p999"), "max",
        F.col("above_p99").cast("bigint").alias("above_p99"),
    )


def threshold_segments(df: DataFrame, column: str, threshold: float, label: str = LABEL) -> DataFrame:
    """Sessions and conversion above vs. at-or-below a threshold."""
    seg = F.when(F.col(column) > F.lit(threshold), "extreme").otherwise("typical")
    return df.groupBy(seg.alias("segment")).agg(
        F.count(F.lit(1)).alias("sessions"), r6(F.avg(_label_double(label))).alias("conversion_rate")
    )


def equal_width_histogram(df: DataFrame, columns: Sequence[str] = HISTOGRAM_COLUMNS, bins: int = 30) -> DataFrame:
    """equal-width bins between min and max per column (last bin closed), assigned like
    numpy's uniform-bin histogram: arithmetic index, then corrected against the edges
    ``linspace(min, max, bins + 1)`` (edge k = k·step + min, last edge = max).

    Min/max per column come from one aggregation and are joined back by column name
    (one row per column, so the broadcast is bounded by the column count).
    """
    long = unpivot(df, [], columns, "column", "value")
    rng = long.groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    lo, hi, x = F.col("lo"), F.col("hi"), F.col("value")
    step = (hi - lo) / bins

    def edge(k):
        return F.when(k >= bins, hi).otherwise(k.cast("double") * step + lo)

    j = long.join(F.broadcast(rng), "column")
    j = j.withColumn("bin", F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((x - lo) / (hi - lo) * bins), F.lit(bins - 1))).cast("int"))
    b = F.col("bin")
    j = j.withColumn("bin", F.when((hi != lo) & (x < edge(b)), b - 1).otherwise(b))
    j = j.withColumn("bin", F.when((hi != lo) & (b != bins - 1) & (x >= edge(b + 1)), b + 1).otherwise(b))
    counted = j.groupBy("column", "bin", "lo", "hi").agg(F.count(F.lit(1)).alias("count"))
    return counted.select(
        "column", "bin", r6(edge(F.col("bin"))).alias("bin_start"), r6(edge(F.col("bin") + 1)).alias("bin_end"),
        "count",
    )


def box_summary(df: DataFrame, columns: Sequence[str], label: str = LABEL) -> DataFrame:
    """quartiles and 1.5·IQR whiskers (most extreme points inside the fences) by label."""
    long = unpivot(df.withColumn("_label", bool_key(F.col(label))), ["_label"], columns, "column", "value")
    q = quantile_columns(long, ["column", "_label"], "value", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    fences = q.select("*", (F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).alias("lo_f"),
                      (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("hi_f"))
    inside = F.col("value").between(F.col("lo_f"), F.col("hi_f"))
    w = long.join(F.broadcast(fences), ["column", "_label"]).groupBy("column", "_label").agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
    )
    return fences.join(w, ["column", "_label"]).select(
        "column", F.col("_label").alias("label"), r6(F.col("q1")).alias("q1"), r6(F.col("median")).alias("median"),
        r6(F.col("q3")).alias("q3"), "whisker_low", "whisker_high",
    )


def class_balance(df: DataFrame, label: str = LABEL) -> DataFrame:
    """sessions per class with readable class names."""
    name = F.when(F.col(label), "purchase").otherwise("no_purchase")
    return df.groupBy(name.alias("class")).agg(F.count(F.lit(1)).alias("sessions"))
