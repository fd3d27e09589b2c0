"""JSON reports (A2, A3).

Reports are long-form metric tables ``(path, value)``, published as one sorted document (``json_document``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.sources import json_document


def write_report(metrics: DataFrame, path: str) -> None:
    """A2: one JSON document, keys sorted, published by a rename."""
    json_document.register(metrics.sparkSession)
    metrics.select("path", "value").write.format(json_document.FORMAT).mode("overwrite").save(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """A3: read a report back as one row; pick fields by dotted access (``validation.f1``)."""
    return spark.read.option("multiLine", True).json(path)


def record_to_long(record: DataFrame, prefix: str) -> DataFrame:
    """One-row metric record → (path, value) rows: ``prefix.metric``."""
    cols = [c for c, t in record.dtypes if t in ("double", "bigint", "int")]
    long = record.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "metric", "value")
    return long.select(F.concat(F.lit(prefix + "."), F.col("metric")).alias("path"), "value")
