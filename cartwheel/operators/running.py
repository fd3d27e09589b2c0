"""Exact running sums over a total order without a single-task window.

``sum(x) OVER (ORDER BY o)`` with no PARTITION BY runs in one task.  Here the
order is cut into contiguous buckets (``bucket`` must be monotone with the
order), each bucket is summed locally in its own window partition, bucket
totals are prefix-summed on a table whose size is bounded by the bucket
count, and the offsets are joined back (AQE turns that join into a
broadcast at runtime because the table is tiny).  Bucket ids are a pure
function of the row, so recomputation after an executor loss gives the same
answer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.operators.joins import join_on

_B = "_bucket"


def bucket_count(df: DataFrame, minimum: int = 16) -> int:
    """Quantile buckets for a running sum: twice the shuffle width, 16 at least."""
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(minimum, 2 * width)


def quantile_bucket(df: DataFrame, column: str, n_buckets: int, *, descending: bool = False,
                    rel_error: float = 0.001) -> Column:
    """Bucket id from approximate quantile cut points of ``column``.

    Only ``n_buckets - 1`` cut points reach the driver.  With ``descending``
    a larger value gets a smaller id so ids ascend along a DESC order.
    """
    probs = [i / n_buckets for i in range(1, n_buckets)]
    cuts = sorted(set(float(v) for v in df.approxQuantile(column, probs, rel_error) if v is not None))
    if not cuts:
        return F.lit(0)
    at_or_below = count_at_or_below(F.col(column), cuts)
    return (F.lit(len(cuts)) - at_or_below) if descending else at_or_below


def count_at_or_below(x: Column, cuts: list[float] | Column, most: int | None = None) -> Column:
    """Number of sorted cut points ≤ x: a binary search over one array (a literal, or a column of at most ``most``
    cut points), in steps of falling powers of two, so that expression size does not grow with the number of
    cut points."""
    table = cuts if isinstance(cuts, Column) else F.lit([*cuts])
    n = F.size(table) if isinstance(cuts, Column) else F.lit(len(cuts))
    steps = [1 << k for k in reversed(range((len(cuts) if most is None else most).bit_length()))]
    # found so far + step is taken if that many cut points are ≤ x
    return F.aggregate(F.lit(steps), F.lit(0), lambda found, step: F.when(
        (found + step <= n) & (F.get(table, found + step - 1) <= x), found + step).otherwise(found))


def hex_prefix_bucket(hex_col: Column, chars: int = 2) -> Column:
    """Bucket id from the leading hex digits of a uniform hash (md5 / sha2)."""
    return F.conv(F.substring(hex_col, 1, chars), 16, 10).cast("int")


def running_sums(
    df: DataFrame,
    *,
    bucket: Column,
    order: Sequence[Column],
    sums: Sequence[str],
    partition_by: Sequence[str] = (),
    suffix: str = "_cum",
) -> DataFrame:
    """Append ``<c><suffix>`` = cumulative sum of ``c`` (ROWS, inclusive) for each c in sums.

    ``order`` must be a total order inside each ``partition_by`` group and
    ``bucket`` must be non-decreasing along it.
    """
    pcols = list(partition_by)
    base = df.withColumn(_B, bucket)
    w_local = Window.partitionBy(*pcols, _B).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = base.select("*", *[F.sum(c).over(w_local).alias(f"_{c}_loc") for c in sums])
    totals = base.groupBy(*pcols, _B).agg(*[F.sum(c).alias(f"_{c}_tot") for c in sums])
    # Prefix sum over bucket totals: one row per (group, bucket), i.e. ≤ #buckets rows per group
    # (twice the shuffle width, or 65,536 hash buckets), so this window's partitions stay small even
    # when there is no group column and Spark runs it as a single partition.
    w_off = Window.partitionBy(*pcols).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *pcols, _B, *[F.coalesce(F.sum(f"_{c}_tot").over(w_off), F.lit(0)).alias(f"_{c}_off") for c in sums]
    )
    joined = join_on(local, offsets, [*pcols, _B], "inner")  # a NULL group keeps its rows
    out = joined.select(
        *df.columns, *[(F.col(f"_{c}_loc") + F.col(f"_{c}_off")).alias(f"{c}{suffix}") for c in sums]
    )
    return out


def row_numbers(df: DataFrame, *, bucket: Column, order: Sequence[Column], partition_by: Sequence[str] = (),
                name: str = "rn") -> DataFrame:
    """Distributed ``row_number()`` over a total order (1-based)."""
    one = "_one"
    out = running_sums(df.withColumn(one, F.lit(1)), bucket=bucket, order=order, sums=[one],
                       partition_by=partition_by, suffix="_rn")
    return out.withColumnRenamed(f"{one}_rn", name).drop(one)
