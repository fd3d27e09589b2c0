"""Join helpers: NULL-safe keyed joins, and the comparison-table joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on(left: DataFrame, right: DataFrame, on: Sequence[str] | str, how: str = "left") -> DataFrame:
    """Keyed join (E5) in which a NULL key equals a NULL key; the keys appear once, from the left.

    No hint: AQE broadcasts a side by its measured size and splits skewed partitions otherwise.
    """
    keys = [on] if isinstance(on, str) else list(on)
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])


def align_reports(reports: Sequence[DataFrame]) -> DataFrame:
    """Stack one-row metric reports with differing columns (missing → NULL)."""
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    return out
