"""Preprocessing fitted on train only.

Two forms: exact SQL-expressible versions (population-SD scaling, long-form
one-hot, class weights) used for checks and reports, and ``pyspark.ml``
stages used inside model pipelines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.expr import r6, unpivot
from cartwheel.operators.joins import join_on
from cartwheel.schema import LABEL


def scaler_stats(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """D1 fit: (column, mean, sd) with population SD; zero SD is reported as 1 (sklearn rule)."""
    long = unpivot(train, [], columns, "column", "value")
    return long.groupBy("column").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("_sd")).select(
        "column", "mean", F.when(F.col("_sd") == 0, F.lit(1.0)).otherwise(F.col("_sd")).alias("sd"))


def standardize(df: DataFrame, stats: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """D1 transform: (x − mean) / sd with the fitted stats.

    The stats are model parameters (two numbers per column); they are pulled
    to the driver once and inlined as literals, like a fitted scaler model.
    """
    params = {r["column"]: (r["mean"], r["sd"]) for r in stats.collect()}  # one row per column
    return df.select(*keep, *[((F.col(c) - F.lit(params[c][0])) / F.lit(params[c][1])).alias(c) for c in columns])


def one_hot_dictionary(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """D2 fit: (column, category, slot) — categories seen in train, slot alphabetical from 0."""
    from cartwheel.operators.features import category_dictionary

    return category_dictionary([train], columns).withColumnRenamed("value", "category").withColumnRenamed(
        "idx", "slot")


def one_hot_long(df: DataFrame, dictionary: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """D2 transform, sparse long form: (keys…, column, category, slot) for known categories only.

    Unknown categories produce no row — the all-zeros encoding.  The dictionary
    is a size-checked broadcast (one row per category value).
    """
    long = unpivot(df, list(keys), columns, "column", "category", cast="string")
    return join_on(long, dictionary, ["column", "category"], "inner").select(*keys, "column", "category", "slot")


def one_hot_dense(df: DataFrame, dictionary: DataFrame, columns: Sequence[str], keys: Sequence[str], name: str = "slots") -> DataFrame:
    """Dense form — (keys…, ``name``), one 0/1 number per known category, columns in the given order, slots within.

    The width is the dictionary's size in every row, so its categories go into the plan as literals and no row moves.
    """
    known: dict[str, list] = {c: [] for c in columns}
    for r in dictionary.orderBy("column", "slot").collect():  # one row per category
        known[r["column"]].append(r["category"])
    is_own = lambda value: lambda k: F.when(k == value, 1.0).otherwise(0.0)
    dense = [F.transform(F.lit(known[c]), is_own(F.col(c).cast("string"))) for c in columns if known[c]]
    return df.select(*keys, F.concat(*dense).alias(name))


def class_weights(train: DataFrame, label: str = LABEL) -> DataFrame:
    """Per class n, balanced weight n/(2·n_c) and positive weight negatives/positives."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("sessions"))
    # ``counts`` has one row per class (two rows): a window over it is a two-row single partition.
    j = counts.select("*", F.sum("sessions").over(Window.partitionBy()).alias("n"),
                      F.sum(F.when(F.col(label), F.col("sessions")).otherwise(0)).over(Window.partitionBy()).alias("pos"))
    return j.select(
        F.lower(F.col(label).cast("string")).alias("label"), "sessions",
        r6(F.col("n") / (2.0 * F.col("sessions"))).alias("balanced_weight"),
        r6((F.col("n") - F.col("pos")) / F.col("pos")).alias("scale_pos_weight"),
    )


def with_balanced_weight(df: DataFrame, train: DataFrame, label: str = LABEL, name: str = "weight") -> DataFrame:
    """D5 applied: weight column n/(2·n_c) for each row (weights are fitted on train)."""
    rows = {r[label]: r["sessions"] for r in train.groupBy(label).agg(F.count(F.lit(1)).alias("sessions")).collect()}
    n = sum(rows.values())
    w = {k: n / (2.0 * v) for k, v in rows.items()}
    return df.withColumn(name, F.when(F.col(label), F.lit(w.get(True, 1.0))).otherwise(F.lit(w.get(False, 1.0))))


def ml_preprocessor(numeric: Sequence[str], categorical: Sequence[str], *, scale: bool = True,
                    one_hot: bool = True, features_col: str = "features") -> list:
    """D3: pyspark.ml stages — index categoricals (alphabetical, unseen kept as an extra index),
    one-hot with unseen → zero vector, standardise numerics, assemble.

    Booleans and codes are indexed as text.  ``StandardScaler`` uses the sample SD
    (the exact population-SD form is ``standardize``); for model inputs the factor
    √((n−1)/n) is immaterial.
    """
    from pyspark.ml.feature import StandardScaler

    stages: list = []
    cat_in = [f"{c}__s" for c in categorical]
    stages.append(SQLTransformer(statement="SELECT *, " + ", ".join(
        f"CAST({c} AS STRING) AS {c}__s" for c in categorical) + " FROM __THIS__") if categorical else None)
    idx_out = [f"{c}__idx" for c in categorical]
    if categorical:
        stages.append(StringIndexer(inputCols=cat_in, outputCols=idx_out, handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
    cat_features = idx_out
    if categorical and one_hot:
        oh_out = [f"{c}__oh" for c in categorical]
        # The indexer puts unseen values at index n (its extra "unknown" label); dropLast drops
        # exactly that slot, so unseen categories encode as all zeros at unchanged width.
        stages.append(OneHotEncoder(inputCols=idx_out, outputCols=oh_out, dropLast=True, handleInvalid="error"))
        cat_features = oh_out
    num_features: list[str] = list(numeric)
    if numeric and scale:
        stages.append(VectorAssembler(inputCols=list(numeric), outputCol="__num", handleInvalid="keep"))
        stages.append(StandardScaler(inputCol="__num", outputCol="__num_scaled", withMean=True, withStd=True))
        num_features = ["__num_scaled"]
    stages.append(VectorAssembler(inputCols=[*num_features, *cat_features], outputCol=features_col,
                                  handleInvalid="keep"))
    return [s for s in stages if s is not None]


def ml_pipeline(numeric: Sequence[str], categorical: Sequence[str], estimator, **kw) -> Pipeline:
    return Pipeline(stages=[*ml_preprocessor(numeric, categorical, **kw), estimator])
