"""Quality rules: counts per text, and robust multivariate outliers per language and source.

The counts give ratios.  A short text's ratios are noisy: each row has the variances that its length leaves them at its group's pooled
values, and its Mahalanobis distance is taken with the group's covariance plus these.

Each group gets a minimum-covariance-determinant estimate.  From two starts, medians with quartile ranges and the moments of all rows,
concentration steps re-estimate mean and covariance from the three quarters of rows nearest, until no group's determinant falls any
more; the start with the least determinant counts, and one reweighted step follows.  Rows beyond a chi-square limit are rejected.

A step is a histogram of distances and a sum of products per group, both combined before the shuffle; rows get their group's estimate by
a join with a table of one row per group, which Spark broadcasts where it is small.  Groups of fewer than ``LEAST_ROWS`` rows are pooled by language, then altogether; if that
is too few as well, only the base rule rejects.

Tested on texts of 10 to 30 words among ordinary ones: of those all in capitals, of words four times as long, or with a symbol after
every word at least 85 of 100 are rejected, of ordinary ones at most 2 in 2,250.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartwheel.llm.common import discard, mapped, materialize, slices, table

#: Statistic → least spread that counts as one deviation: what lies below is noise whatever a group's spread is.
STATS = {"word_length": 0.3, "symbols": 0.4, "dup_lines": 0.04, "repeats": 0.04, "capitals": 0.03}
#: How much more a ratio varies than if its words (lines, letters) were independent: what repeats comes in stretches.
CLUSTER = (1.0, 0.3, 3.0, 30.0, 5.0)
#: Deviation of a word's length, of the mean; least pooled value of a ratio, for its noise.
WORD_SPREAD, LEAST_RATIO = 0.6, 0.002
LEAST_ROWS = 50
SHARE = 0.75
#: A determinant falls if its logarithm does by more than this.
FALL = 1e-3
#: Chance that a normal row lies beyond the limits of the reweighted step and of the verdict.
TRIM, REJECT = 0.025, 1e-7
_SPACE, _SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
_CAPITALS = bytes(range(65, 91))
_SMALL = bytes(range(97, 123))
P = len(STATS)


def counts_of(text: str) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals, n_letters (the last two in ASCII)."""
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
    repeats = 0
    if len(set(windows)) < len(windows):
        seen, until = Counter(windows), 0
        for i, w in enumerate(windows):
            if seen[w] > 1:
                repeats += i + 5 - max(i, until)
                until = i + 5
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    return (len(words), len(text) - len(raw) + len(raw.translate(None, _SPACE)), len(raw) - len(raw.translate(None, _SYMBOLS)),
            len(lines) - len(set(lines)), repeats, len(lines), capitals, capitals + len(raw) - len(raw.translate(None, _SMALL)))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_letters")


def with_counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of every row's text (null: empty)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            cols = zip(*[counts_of(t or "") for t in b.column("text").to_pylist()], strict=True)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("doc_id", "lang", "source")], *[pa.array(c, pa.int64()) for c in cols]],
                                             ["doc_id", "lang", "source", *COUNTS])

    return mapped(docs.select("doc_id", "lang", "source", "text"), run,
                  "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS))


def chi2_cdf(x: float, dof: int) -> float:
    """By the series of the incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, z = dof / 2, x / 2
    term = total = 1 / a
    n = 0
    while term > total * 1e-16:
        n += 1
        term *= z / (a + n)
        total += term
    return min(1.0, total * math.exp(a * math.log(z) - z - math.lgamma(a)))


def chi2_limit(p: float, dof: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, dof) < p else (low, mid)
    return high


def _grouped(rows: DataFrame) -> DataFrame:
    """``rows`` with ``grp``: language and source, or the pool they go to, or null; null labels are values of their own."""
    mark = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("null"))
    fine = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    fine = fine.withColumn("pool", F.when(F.col("n") < LEAST_ROWS, mark("lang")))
    by_lang = fine.where("pool is not null").groupBy("pool").agg(F.sum("n").alias("pool_n"))
    fine = fine.join(by_lang, "pool", "left").withColumn("small", F.col("pool_n") < LEAST_ROWS)
    rest = F.sum(F.when(F.col("small"), F.col("n"))).over(W.partitionBy("small"))
    key = (F.when(F.col("pool").isNull(), F.to_json(F.array(mark("lang"), mark("source")), {}))
           .when(~F.col("small"), F.to_json(F.array("pool"), {}))
           .when(rest >= LEAST_ROWS, F.lit("[]")))
    labels = fine.select("lang", "source", key.alias("grp"))
    joined = rows.alias("r").join(labels.alias("l"), F.col("r.lang").eqNullSafe(F.col("l.lang")) & F.col("r.source").eqNullSafe(F.col("l.source")), "left")
    return joined.select("r.*", "l.grp")


def _statistics(rows: DataFrame) -> DataFrame:
    """doc_id, counts, grp, the statistics x0..: ratios (its group's where a text has nothing to divide by), symbols on a log
    scale, and their variances v0.. that the text's length leaves."""
    ratios = (("word_chars", "n_words"), ("n_symbols", "n_words"), ("n_dup_lines", "n_lines"), ("n_repeat_words", "n_words"), ("n_capitals", "n_letters"))
    pooled = rows.groupBy("grp").agg(*[F.coalesce(F.try_divide(F.sum(a), F.sum(b)), F.lit(0.0)).alias(f"m{i}") for i, (a, b) in enumerate(ratios)])
    out = rows.join(pooled, "grp")
    for i, (a, b) in enumerate(ratios):
        m = F.col(f"m{i}")
        x = F.coalesce(F.try_divide(F.col(a), F.col(b)), m)
        least = F.greatest(m, F.lit(LEAST_RATIO))
        one = F.pow(WORD_SPREAD * m, 2) if i == 0 else least * F.greatest(1 - m, F.lit(LEAST_RATIO))
        v = CLUSTER[i] * one / F.greatest(F.col(b), F.lit(1))
        if i == 1:  # on the log scale; a short text's noise is whether it has a symbol at all
            n = F.greatest(F.col(b), F.lit(1))
            x, v = F.log1p(20 * x), CLUSTER[i] * F.least(F.lit(1.0), n * least) * F.pow(F.log1p(20 / n), 2)
        out = out.withColumn(f"x{i}", x).withColumn(f"v{i}", v)
    return out.drop(*[f"m{i}" for i in range(len(ratios))])


def _start(stats: DataFrame) -> DataFrame:
    """grp, mean, covariance, fall: medians, and half quartile ranges (floored) as deviations, to a tenth of the floor."""
    floors = list(STATS.values())
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.floor(F.col(f"x{i}") / (s / 10)).alias("cell")) for i, s in enumerate(floors)])
    counted = stats.select("grp", F.explode(cells).alias("c")).groupBy("grp", "c.i", "c.cell").agg(F.count("*").alias("n"))
    order = W.partitionBy("grp", "i").orderBy("cell")
    total = F.sum("n").over(W.partitionBy("grp", "i"))
    upto = counted.withColumn("share", F.sum("n").over(order) / total)
    at = lambda q: F.min(F.when(F.col("share") >= q, F.col("cell")))
    q = upto.groupBy("grp", "i").agg(at(0.25).alias("q1"), at(0.5).alias("q2"), at(0.75).alias("q3"))
    floor = F.element_at(F.array(*map(F.lit, floors)), F.col("i") + 1)
    q = q.withColumn("median", (F.col("q2") + 0.5) * floor / 10).withColumn(
        "spread", F.greatest((F.col("q3") - F.col("q1")) * floor / 10 / 1.349, floor))
    side = F.array_sort(F.collect_list(F.struct("i", "median", "spread")))  # one entry per statistic
    q = q.groupBy("grp").agg(side.alias("s"))
    diagonal = F.flatten(F.transform("s", lambda a: F.transform("s", lambda b: F.when(a["i"] == b["i"], a["spread"] * a["spread"]).otherwise(0.0))))
    return q.select("grp", F.transform("s", lambda a: a["median"]).alias("mean"), diagonal.alias("covariance"), F.lit(float("inf")).alias("size"))


def with_distance(rows: DataFrame, at: DataFrame, name: str = "d") -> DataFrame:
    """``rows`` (grp, x0.., v0.., any others) with the squared Mahalanobis distance ``name`` from their group's estimate ``at``, each
    row's own variances added to the covariance."""
    met = rows.join(at.select("grp", "mean", "covariance"), "grp")
    fields = [f for f in met.schema.fields if f.name not in ("mean", "covariance")]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            x, v = (np.column_stack([np.asarray(b.column(f"{c}{i}")) for i in range(P)]).reshape(n, P) for c in "xv")
            away = x - np.asarray(b.column("mean").flatten()).reshape(n, P)
            cov = np.asarray(b.column("covariance").flatten()).reshape(n, P, P) + v[:, :, None] * np.eye(P)
            d = (away * np.linalg.solve(cov, away[:, :, None])[:, :, 0]).sum(axis=1)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], pa.array(d)], [*names, name])

    return mapped(met, run, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [f"`{name}` double"]))


def _estimate(chosen: DataFrame, factor: float) -> DataFrame:
    """grp, mean, covariance (with the floors, which keep it regular) and size (the logarithm of its determinant) from the rows
    chosen: sums of products per group."""
    sums = [F.sum(f"x{i}").alias(f"s{i}") for i in range(P)]
    cross = [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}_{j}") for i in range(P) for j in range(i, P)]
    agg = chosen.groupBy("grp").agg(F.count("*").alias("n"), *sums, *cross)
    floors = np.diag(np.square(list(STATS.values())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            means, covs, logs = [], [], []
            for r in b.to_pylist():
                m = np.array([r[f"s{i}"] for i in range(P)]) / r["n"]
                cov = np.empty((P, P))
                for i in range(P):
                    for j in range(i, P):
                        cov[i, j] = cov[j, i] = (r[f"s{i}_{j}"] / r["n"] - m[i] * m[j]) * factor
                means.append(m.tolist())
                covs.append((cov + floors).ravel().tolist())
                logs.append(float(np.linalg.slogdet(cov + floors)[1]))
            yield pa.RecordBatch.from_arrays([b.column("grp"), pa.array(means, pa.list_(pa.float64())), pa.array(covs, pa.list_(pa.float64())), pa.array(logs, pa.float64())],
                                             ["grp", "mean", "covariance", "size"])

    return materialize(mapped(agg, run, "grp string, mean array<double>, covariance array<double>, size double"), "mcd")


def _concentrated(points: DataFrame, at: DataFrame) -> DataFrame:
    """Concentration steps from the estimates ``at`` until no group's determinant falls; each group has the least one met."""
    cell = F.floor(F.log2(F.greatest(F.col("d"), F.lit(1e-6))) * 32)
    by = W.partitionBy("grp")
    while True:
        far = with_distance(points, at).withColumn("cell", cell)
        counted = far.groupBy("grp", "cell").agg(F.count("*").alias("n"))  # distances in steps of 2 %
        share = F.sum("n").over(by.orderBy("cell")) / F.sum("n").over(by)
        limit = counted.withColumn("share", share).where(F.col("share") >= SHARE).groupBy("grp").agg(F.min("cell").alias("limit"))
        new = _estimate(far.join(limit, "grp").where(F.col("cell") <= F.col("limit")), SHARE / chi2_cdf(chi2_limit(SHARE, P), P + 2))
        fell = new.alias("n").join(at.alias("o"), "grp").where(F.col("n.size") < F.col("o.size") - FALL)
        if fell.limit(1).count() == 0:
            return at
        at = _least(at, new)


def _least(*found: DataFrame) -> DataFrame:
    """Of each group's estimates the one with the least determinant (one row per group and table)."""
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    best = every.groupBy("grp").agg(F.min_by(F.struct("mean", "covariance", "size"), "size").alias("b"))
    return materialize(best.select("grp", "b.mean", "b.covariance", "b.size"), "mcd")


def estimates(stats: DataFrame) -> DataFrame:
    """grp, mean, covariance, size: the minimum-covariance-determinant estimate of each group, reweighted."""
    points = materialize(stats.select("grp", *[f"{c}{i}" for c in "xv" for i in range(P)]), "mcd-points")
    starts = [materialize(_start(points), "mcd"), _estimate(points, 1.0).withColumn("size", F.lit(float("inf")))]
    at = _least(*[_concentrated(points, s) for s in starts])
    near = with_distance(points, at).where(F.col("d") <= chi2_limit(1 - TRIM, P))
    out = _estimate(near, (1 - TRIM) / chi2_cdf(chi2_limit(1 - TRIM, P), P + 2))
    discard(points)
    return out


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, counts, base_failed, distance and kept for every row of ``docs`` (doc_id, text, lang, source).

    A text fails the base rule with fewer than 10 words or more than a fifth of its words in repeated 5-word
    windows; null and empty texts do.  Estimates use the rows that pass.  Null languages and sources form
    groups of their own; rows are judged one by one, so repeated ones are judged alike.  ``distance`` is null for rows
    that fail the base rule and where all rows are too few for an estimate.
    """
    counted = materialize(with_counts(docs), "quality-counts")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    counted = counted.withColumn("base_failed", failed)
    grouped = _grouped(counted.where("not base_failed"))
    stats = materialize(_statistics(grouped.where("grp is not null")), "quality-statistics")
    names = ["doc_id", *COUNTS, "base_failed"]
    judged = with_distance(stats, estimates(stats), "distance").select(*names, "distance")
    rest = grouped.where("grp is null").select(*names).unionByName(counted.where("base_failed").select(*names))
    out = judged.unionByName(rest.withColumn("distance", F.lit(None).cast("double")))
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= chi2_limit(1 - REJECT, P))
    return out.withColumn("kept", kept)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


QUERIES = {"op6_quality": op6_quality}
ORACLES = {}
