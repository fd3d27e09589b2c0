"""Ordered target statistics: categories as numbers without a row's own label (M6).

Training rows have a fixed random order, the hash of their key.  A row's category becomes the smoothed positive rate of
the rows with that category *before* it, (sum + strength · prior) / (rows + strength) with the training split's
positive rate as prior.  A row's own label and those after it have no part in its value, so a learner
cannot read the label back from a rare category.  Other rows (validation, requests) get the rate over all training
rows of the category, and the prior where it was never seen.

All columns go through one long table, and the running sums through ``running.running_sums``: buckets by leading hash
digits, so that a category of any size is worked on by many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.expr import unpivot
from cartwheel.operators.joins import join_on
from cartwheel.operators.running import hex_prefix_bucket, running_sums
from cartwheel.operators.split import order_hash
from cartwheel.schema import KEY_COLUMNS, LABEL


def _rate(positives, rows, prior: float, strength: float):
    return (positives + F.lit(strength * prior)) / (rows + F.lit(strength))


def _long(df: DataFrame, columns: Sequence[str], keys: Sequence[str], *extra: str) -> DataFrame:
    return unpivot(df, [*keys, *extra], columns, "column", "category", cast="string")


def ordered_statistics(train: DataFrame, columns: Sequence[str], prior: float, *, strength: float = 1.0, seed: int | str = 42,
                       keys: Sequence[str] = KEY_COLUMNS, label: str = LABEL) -> DataFrame:
    """(keys…, column, category, encoded) for every training row and column; NULL is a category of its own."""
    rows = train.select(*keys, *columns, order_hash(seed, keys).alias("_h"), F.coalesce(F.col(label).cast("long"), F.lit(0)).alias("_y"),
                        F.col(label).isNotNull().cast("long").alias("_one"))
    long = _long(rows, columns, keys, "_h", "_y", "_one")
    sums = running_sums(long, bucket=hex_prefix_bucket(F.col("_h"), 4), order=[F.col("_h"), *[F.col(k) for k in keys]],
                        sums=["_y", "_one"], partition_by=["column", "category"])
    before = _rate(F.col("_y_cum") - F.col("_y"), F.col("_one_cum") - F.col("_one"), prior, strength)
    return sums.select(*keys, "column", "category", before.alias("encoded"))


@dataclass
class TargetStatistics:
    """Fitted on a training split: the prior, and one row per column and category."""

    columns: tuple[str, ...]
    keys: tuple[str, ...]
    prior: float
    strength: float
    categories: DataFrame

    def encode(self, df: DataFrame) -> DataFrame:
        """(keys…, column, category, encoded) for rows outside the training split."""
        met = join_on(_long(df, self.columns, self.keys), self.categories, ["column", "category"])
        return met.select(*self.keys, "column", "category", F.coalesce("encoded", F.lit(self.prior)).alias("encoded"))

    def widened(self, df: DataFrame, encoded: DataFrame) -> DataFrame:
        """``df`` with one number column per category column (``<column>__rate``), joined on the row keys."""
        pick = lambda c: F.max(F.when(F.col("column") == c, F.col("encoded"))).alias(f"{c}__rate")
        return join_on(df, encoded.groupBy(*self.keys).agg(*[pick(c) for c in self.columns]), self.keys, "inner")

    def transform(self, df: DataFrame) -> DataFrame:
        return self.widened(df, self.encode(df))


def fit_target_statistics(train: DataFrame, columns: Sequence[str], *, strength: float = 1.0, keys: Sequence[str] = KEY_COLUMNS,
                          label: str = LABEL) -> TargetStatistics:
    known = train.where(F.col(label).isNotNull())
    prior = known.agg(F.avg(F.col(label).cast("double")).alias("p")).first()["p"] or 0.0
    long = _long(known.select(*keys, *columns, F.col(label).cast("long").alias("_y")), columns, keys, "_y")
    rates = long.groupBy("column", "category").agg(F.sum("_y").alias("positives"), F.count(F.lit(1)).alias("rows"))
    rates = rates.select("column", "category", "positives", "rows", _rate(F.col("positives"), F.col("rows"), prior, strength).alias("encoded"))
    return TargetStatistics(tuple(columns), tuple(keys), prior, strength, rates)
