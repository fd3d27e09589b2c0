"""Name → Spark callable and name → DuckDB oracle SQL, collected from the query modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_MODULES = (
    "cartwheel.plans.quality_queries",
    "cartwheel.plans.contract_queries",
    "cartwheel.plans.feature_queries",
    "cartwheel.plans.eval_queries",
    "cartwheel.plans.ops_queries",
    "cartwheel.plans.train_queries",
    "cartwheel.plans.summary_queries",
)


def _load():
    import importlib

    spark_q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    sql_q: dict[str, str] = {}
    for mod_name in _MODULES:
        mod = importlib.import_module(mod_name)
        for k, v in mod.SPARK.items():
            if k in spark_q:
                raise ValueError(f"duplicate query name {k}")
            spark_q[k] = v
        sql_q.update(mod.SQL)
    return spark_q, sql_q


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _load()[0]


def oracle_sql() -> dict[str, str]:
    return _load()[1]
