"""Run log (A7): one row per run with params MAP<STRING,STRING> and metrics MAP<STRING,DOUBLE>.

Appended to a Parquet table partitioned by experiment — the Spark stand-in
for a tracking server.  Parameters are stored as text, metrics as doubles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RUN_STATUSES = ("FINISHED", "FAILED")


def run_records(runs: DataFrame, experiment: str, *, metric_columns: Sequence[str],
                param_columns: Sequence[str], status: str = "FINISHED") -> DataFrame:
    """Fold metric / param columns into maps: experiment, run_name, status, params, metrics."""
    if status not in RUN_STATUSES:
        raise ValueError(f"status must be one of {RUN_STATUSES}")
    params = F.map_from_arrays(F.array(*[F.lit(p) for p in param_columns]),
                               F.array(*[F.col(p).cast("string") for p in param_columns]))
    metrics = F.map_from_arrays(F.array(*[F.lit(m) for m in metric_columns]).cast("array<string>"),
                                F.array(*[F.col(m).cast("double") for m in metric_columns]).cast("array<double>"))
    return runs.select(F.lit(experiment).alias("experiment"), "run_name", F.lit(status).alias("status"),
                       params.alias("params"), metrics.alias("metrics"))


def prefixed(records: DataFrame, prefix: str) -> DataFrame:
    """Metric names with a prefix (``validation_f1``)."""
    return records.withColumn("metrics", F.transform_keys("metrics", lambda k, v: F.concat(F.lit(prefix), k)))


def metrics_long(records: DataFrame, prefix: str = "") -> DataFrame:
    """(run_name, metric, value) rows, optionally prefixed."""
    r = prefixed(records, prefix) if prefix else records
    return r.select("run_name", F.explode("metrics").alias("metric", "value"))


def append_runs(records: DataFrame, path: str) -> None:
    """Append run records to the Parquet run log (partitioned by experiment)."""
    records.write.mode("append").partitionBy("experiment").parquet(path)


def read_runs(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)
