"""Registered queries: name → Spark callable and name → DuckDB oracle SQL."""

from cartwheel.plans.registry import oracle_sql, queries  # noqa: F401
