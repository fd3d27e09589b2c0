"""Exact quantiles with linear interpolation by bracket refinement.

A quantile needs the values at two ranks of its group, not the order of all values.  Every group starts with one
bracket that holds all its values, and while a bracket holds more than ``FITS`` rows it is narrowed:

1. a sketch of the bracket's values gives cut points (map-side combined; also near the wanted probabilities);
2. the rows are counted per cell between cut points, a value equal to a cut point having a cell of its own;
3. the cells that hold a wanted rank are the next brackets, with the number of rows before them.

The sketch only places the cut points, the counts are exact.  A bracket of one value is known without looking
at rows again, whatever its size, so ties need no room.  What is left are brackets that fit: their
distinct values are counted, ranked in one window per bracket, and the values at the wanted ranks picked.  Groups that
fit from the start, which are all groups of a small table, take only that last step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.operators.joins import join_on
from cartwheel.operators.running import count_at_or_below
from cartwheel.session import materialize

#: Rows of a bracket whose distinct values one task may order.
FITS = 1_000_000
#: Evenly placed cut points of a sketch, its accuracy, and the distance of the cut points around a wanted probability.
CUTS, ACCURACY, NEAR = 256, 10_000, 1 / 4096


def _ranks(n: Column, p: float) -> tuple[Column, Column, Column]:
    """Position (n − 1)·p and the ranks around it."""
    at = (n - 1) * F.lit(float(p))
    return at, F.floor(at), F.ceil(at)


def _holds(first: Column, after: Column, n: Column, probs: Sequence[float]) -> Column:
    """Whether the ranks from ``first`` up to before ``after`` include a wanted one."""
    out = F.lit(False)
    for p in probs:
        for rank in _ranks(n, p)[1:]:
            out = out | (first <= rank) & (rank < after)
    return out


def _narrowed(long: DataFrame, brackets: DataFrame, g: list[str], value: str, probs: Sequence[float]) -> DataFrame:
    """One round for the brackets that do not fit yet; the others stay."""
    v, wide = F.col(value), (F.col("_rows") > FITS) & (F.col("_lo").isNull() | (F.col("_lo") < F.col("_hi")))
    fractions = sorted({i / CUTS for i in range(1, CUTS)} | {min(1.0, max(0.0, p + d)) for p in probs for d in (-NEAR, NEAR)})
    rows = _inside(long, brackets.where(wide), g, value)
    cuts = rows.groupBy(*g, "_before").agg(F.array_sort(F.array_distinct(F.percentile_approx(v, fractions, ACCURACY))).alias("_cuts"))
    rows = join_on(rows, cuts, [*g, "_before"], "inner")
    at = count_at_or_below(v, F.col("_cuts"), len(fractions))
    cell = 2 * at + F.when(F.get("_cuts", at - 1) == v, 0).otherwise(1)
    cells = rows.groupBy(*g, "_n", "_before", cell.alias("_cell")).agg(F.count(F.lit(1)).alias("_rows"), F.min(v).alias("_lo"), F.max(v).alias("_hi"))
    along = Window.partitionBy(*g, "_before").orderBy("_cell")  # some 600 cells
    cells = cells.withColumn("_after", F.col("_before") + F.sum("_rows").over(along)).withColumn("_before", F.col("_after") - F.col("_rows"))
    cells = cells.where(_holds(F.col("_before"), F.col("_after"), F.col("_n"), probs))
    return materialize(brackets.where(~wide).unionByName(cells.select(*brackets.columns)), "quantile-brackets")


def _inside(long: DataFrame, brackets: DataFrame, g: list[str], value: str) -> DataFrame:
    """The rows of ``brackets`` (groups, _n, _before, value) — AQE broadcasts the brackets if they are small."""
    v, keys = F.col(value), [F.col(c).eqNullSafe(F.col(f"_b_{c}")) for c in g]
    b = brackets.select(*[F.col(c).alias(f"_b_{c}") for c in g], "_n", "_before", "_lo", "_hi")
    within = (F.col("_lo").isNull() | (v >= F.col("_lo"))) & (F.col("_hi").isNull() | (v <= F.col("_hi")))
    for k in keys:
        within = within & k
    return long.join(b if g else F.broadcast(b), within).select(*g, "_n", "_before", value)  # without groups: a row per bracket


def _picked(values: DataFrame, g: list[str], value: str, probs: dict[str, float], n: Column, before: Column, within: list[str]) -> DataFrame:
    """Distinct values with counts ``_c`` → one row per group with a column per probability."""
    order = Window.partitionBy(*within).orderBy(value)
    total = F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ranked = values.select("*", F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("_to"), total.alias("_total"))
    ranked = ranked.select(*g, value, n.alias("_n"), (before + F.col("_to") - F.col("_c")).alias("_first"), (before + F.col("_to")).alias("_after"))
    at_rank = lambda rank: F.max(F.when((F.col("_first") <= rank) & (rank < F.col("_after")), F.col(value)))
    found = [at_rank(rank).alias(f"_{k}_{i}") for k, p in probs.items() for i, rank in enumerate(_ranks(F.col("_n"), p)[1:])]
    return ranked.groupBy(*g).agg(F.max("_n").alias("_n"), *found).select(*g, *[
        _between(F.col(f"_{k}_0"), F.col(f"_{k}_1"), *_ranks(F.col("_n"), p)[:2]).alias(k) for k, p in probs.items()])


def _between(a: Column, b: Column, at: Column, low: Column) -> Column:
    """numpy's linear interpolation: with t = at − low, a + (b − a)·t for t < 0.5 and b − (b − a)·(1 − t) otherwise —
    exact when a == b (ties), where the form (hi − at)·a + (at − lo)·b can miss a by one ulp."""
    t = at - low
    return F.when(a == b, a).when(t < 0.5, a + (b - a) * t).otherwise(b - (b - a) * (1 - t))


def quantile_columns(long: DataFrame, groups: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    """One row per group with one column per named probability; NULL values are ignored."""
    g = list(groups)
    long = long.where(F.col(value).isNotNull()).select(*g, value)
    sizes = long.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"))
    most = sizes.agg(F.max("_n").alias("n")).first()["n"] or 0
    counted = F.count(F.lit(1)).alias("_c")
    if most <= FITS:  # every group is one bracket
        values = long.groupBy(*g, value).agg(counted)
        return _picked(values, g, value, probs, F.col("_total"), F.lit(0), g)
    kind = long.schema[value].dataType
    brackets = sizes.select(*g, "_n", F.lit(0).cast("long").alias("_before"), F.col("_n").alias("_rows"),
                            F.lit(None).cast(kind).alias("_lo"), F.lit(None).cast(kind).alias("_hi"))
    one_value = F.coalesce(F.col("_lo") == F.col("_hi"), F.lit(False))
    while True:
        brackets = _narrowed(long, brackets, g, value, list(probs.values()))
        left = brackets.where(~one_value).agg(F.max("_rows").alias("n")).first()["n"] or 0
        if left <= FITS or left >= most:
            break
        most = left
    known = brackets.where(one_value).select(*g, "_n", "_before", F.col("_lo").alias(value), F.col("_rows").alias("_c"))
    values = _inside(long, brackets.where(~one_value), g, value).groupBy(*g, "_n", "_before", value).agg(counted)
    return _picked(values.unionByName(known), g, value, probs, F.col("_n"), F.col("_before"), [*g, "_before"])


def exact_quantiles(long: DataFrame, groups: Sequence[str], value: str, probs: Sequence[float],
                    name: str = "q") -> DataFrame:
    """(groups…, ``name`` = probability, ``value`` quantile) for every group and probability; NULLs ignored."""
    wide = quantile_columns(long, groups, value, {f"p{i}": p for i, p in enumerate(probs)})
    rows = F.array(*[F.struct(F.lit(float(p)).alias(name), F.col(f"p{i}").alias(value)) for i, p in enumerate(probs)])
    return wide.select(*groups, F.inline(rows))
