"""Reusable Column expressions.

All of these are built-in Spark expressions, so they stay inside whole-stage
codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_bool(c: Column | str) -> Column:
    """Strict boolean text parser: trimmed, case-insensitive TRUE / FALSE.

    Anything else (including '1', 'yes', blanks) gives NULL, which the
    contract turns into a violation.  ``cast(... as boolean)`` is not used
    because Spark also accepts 'yes', 'y' and '1'.
    """
    col = F.col(c) if isinstance(c, str) else c
    norm = F.upper(F.trim(col.cast("string")))
    return F.when(norm == "TRUE", F.lit(True)).when(norm == "FALSE", F.lit(False))


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den with inf and NaN repaired to 0.0 (division by zero included)."""
    q = F.try_divide(num.cast("double"), den.cast("double"))
    return F.when(F.isnan(q) | (F.abs(q) == F.lit(float("inf"))), F.lit(0.0)).otherwise(F.coalesce(q, F.lit(0.0)))


def is_missing(c: str, dtype: str) -> Column:
    """NULL, or NaN for floating columns (NaN is not NULL in Spark)."""
    if dtype in ("double", "float"):
        return F.col(c).isNull() | F.isnan(F.col(c))
    return F.col(c).isNull()


def bool_key(c: Column, is_boolean: bool = True) -> Column:
    """Group key as text; boolean keys lower-cased ('true' / 'false'), others unchanged."""
    return F.lower(c.cast("string")) if is_boolean else c.cast("string")


def r6(c: Column) -> Column:
    """Round a derived double to 6 decimals (oracle comparisons use the same)."""
    return F.round(c.cast("double"), 6)


def unpivot(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str = "column",
            value: str = "value", cast: str = "double") -> DataFrame:
    """Wide → long in one pass (``stack``), values cast to one type."""
    return df.select(*ids, *[F.col(c).cast(cast).alias(c) for c in columns]).unpivot(
        list(ids), list(columns), name, value
    )
