"""Deterministic stratified splits and fold ids.

Row order inside each class is ``md5(seed|user_id|session_date)``, which is
portable across engines.

A split into quotas (G1, G2) needs no ranks, only the hash at which each
quota of a class ends.  That cut is found by radix selection: rows are counted
by class and hash prefix (partial aggregation), the one prefix that holds the
quota's last row is counted by a longer prefix, and so on until its rows fit one
window.  Every row then compares its own hash with its class's cuts: no row is
shuffled or ranked.

Fold ids (G3) do need ranks.  They come from the distributed running
count (``running.row_numbers``), bucketed by the first hex digits of the
hash, so no window ever holds a whole class in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.operators.running import hex_prefix_bucket, row_numbers
from cartwheel.schema import KEY_COLUMNS, LABEL


def order_hash(seed: int | str, key_columns: Sequence[str] = KEY_COLUMNS) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key_columns]))


def ranked_within_class(df: DataFrame, seed: int | str, label: str = LABEL,
                        key_columns: Sequence[str] = KEY_COLUMNS) -> DataFrame:
    """Add ``_h`` (order hash) and ``rn`` (1-based rank in class)."""
    h = df.withColumn("_h", order_hash(seed, key_columns))
    # 4 hex digits → 65,536 buckets per class: ~1.5 GB per window partition at 100 TB, and
    # the bucket-offset table stays at ≤ 65,536 rows per class.
    return row_numbers(h, bucket=hex_prefix_bucket(F.col("_h"), 4),
                       order=[F.col("_h"), *[F.col(k) for k in key_columns]], partition_by=[label])


#: Hex digits by which a prefix grows each round, and the rows of a prefix that are few enough to be ordered by one task.
PREFIX_DIGITS, PREFIX_FITS = 4, 100_000


def class_cuts(df: DataFrame, fractions: Sequence[float], seed: int | str, label: str = LABEL,
               key_columns: Sequence[str] = KEY_COLUMNS) -> dict[object, list[str]]:
    """For each class the order hashes at which its first round(fraction · n_class) rows end ('' where that is no row).

    Small results reach the driver: one row per class and fraction each round.  Rows whose keys are equal share a
    hash and go together; a NULL label is a class of its own.
    """
    rows = df.select(F.col(label).alias("_class"), order_hash(seed, key_columns).alias("_h"))
    digits = PREFIX_DIGITS
    cells = rows.groupBy("_class", F.substring("_h", 1, digits).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    along = Window.partitionBy("_class").orderBy("_p")  # one row per prefix: 65,536 at most
    cells = cells.select("*", F.sum("_n").over(along).alias("_to"), F.sum("_n").over(Window.partitionBy("_class")).alias("_all"))
    rank = lambda f: F.floor(F.lit(f) * F.col("_all") + 0.5)
    targets = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), rank(f).alias("rank")) for i, f in enumerate(fractions)])).alias("t")
    holds = (F.col("t.rank") > F.col("_to") - F.col("_n")) & (F.col("t.rank") <= F.col("_to"))
    nothing = (F.col("t.rank") == 0) & (F.col("_to") == F.col("_n"))  # told once, by the class's first prefix
    cells = cells.select("*", targets).where(holds | nothing)
    found = [(r["_class"], r["t"]["i"], r["_p"] if r["t"]["rank"] else "", r["_n"], r["t"]["rank"] - r["_to"] + r["_n"]) for r in cells.collect()]
    cuts = {c: [""] * len(fractions) for c, *_ in found}
    open_ = [t for t in found if t[2]]  # class, fraction, prefix, rows in it, rank in it
    while any(t[3] > PREFIX_FITS for t in open_) and digits < 32:
        digits = min(32, digits + PREFIX_DIGITS)
        inside = _within(rows, open_).groupBy("_class", "_i", "_rank", F.substring("_h", 1, digits).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
        inside = inside.withColumn("_to", F.sum("_n").over(Window.partitionBy("_class", "_i").orderBy("_p")))
        inside = inside.where((F.col("_rank") > F.col("_to") - F.col("_n")) & (F.col("_rank") <= F.col("_to")))
        open_ = [(r["_class"], r["_i"], r["_p"], r["_n"], r["_rank"] - r["_to"] + r["_n"]) for r in inside.collect()]
    if digits < 32 and open_:
        nth = F.row_number().over(Window.partitionBy("_class", "_i").orderBy("_h"))
        ends = _within(rows, open_).withColumn("_at", nth).where(F.col("_at") == F.col("_rank"))
        open_ = [(r["_class"], r["_i"], r["_h"], 1, 1) for r in ends.collect()]
    for c, i, h, *_ in open_:
        cuts[c][i] = h
    return cuts


def _within(rows: DataFrame, open_: Sequence[tuple]) -> DataFrame:
    """The rows under each open prefix, with its fraction and the rank looked for (one branch per class and fraction)."""
    hits = [F.when(F.col("_class").eqNullSafe(F.lit(c)) & F.col("_h").startswith(p), F.struct(F.lit(i).alias("_i"), F.lit(r).alias("_rank")))
            for c, i, p, _, r in open_]
    met = F.filter(F.array(*hits), lambda x: x.isNotNull())
    return rows.select("_class", "_h", F.explode(met).alias("_t")).select("_class", "_h", "_t._i", "_t._rank")


def _before(cuts: dict[object, list[str]], i: int, h: Column, label: str) -> Column:
    """Whether a row lies before its class's i-th cut."""
    out = F.lit(False)
    for c, ends in cuts.items():
        out = F.when(F.col(label).eqNullSafe(F.lit(c)), h <= F.lit(ends[i])).otherwise(out)
    return out


def stratified_split(df: DataFrame, *, seed: int = 42, train: float = 0.6, validation: float = 0.2,
                     label: str = LABEL, key_columns: Sequence[str] = KEY_COLUMNS, mode: str = "exact") -> DataFrame:
    """G1: add ``split`` ∈ {train, validation, test}.

    ``mode="exact"``: per-class quotas round(frac·n_class) over the md5 order, by cut hashes
    (``class_cuts`` runs its counting jobs here).  ``mode="hash"``: a row goes by its own hash
    fraction — no counting, stratified and sized in expectation only; the same rows for the same seed.
    """
    h = order_hash(seed, key_columns)
    if mode == "hash":
        u = F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / float(16 ** 8)
        return df.withColumn("split", F.when(u < train, "train").when(u < train + validation, "validation")
                             .otherwise("test"))
    cuts = class_cuts(df, [train, train + validation], seed, label, key_columns)
    return df.withColumn("split", F.when(_before(cuts, 0, h, label), "train").when(_before(cuts, 1, h, label), "validation")
                         .otherwise("test"))


def halves(df: DataFrame, *, seed: str = "42|calibration", label: str = LABEL,
           key_columns: Sequence[str] = KEY_COLUMNS) -> DataFrame:
    """Stratified 50/50 split into ``calibrate`` / ``check``, by cut hashes."""
    cuts = class_cuts(df, [0.5], seed, label, key_columns)
    return df.withColumn("half", F.when(_before(cuts, 0, order_hash(seed, key_columns), label), "calibrate").otherwise("check"))


def fold_ids(df: DataFrame, *, k: int = 5, seed: str = "42|folds", label: str = LABEL,
             key_columns: Sequence[str] = KEY_COLUMNS) -> DataFrame:
    """Stratified k-fold id ``fold`` = (rank in class − 1) mod k."""
    r = ranked_within_class(df, seed, label, key_columns)
    return r.withColumn("fold", ((F.col("rn") - 1) % k).cast("int")).drop("_h", "rn")


def split_frames(split_df: DataFrame) -> dict[str, DataFrame]:
    return {s: split_df.filter(F.col("split") == s).drop("split") for s in ("train", "validation", "test")}


def random_grid_sample(grid: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """``n`` parameter points drawn from a grid DataFrame (deterministic md5 order).

    The grid is a small parameter table; ``limit`` here is the sampling feature itself.
    """
    cols = grid.columns
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))
    return grid.withColumn("_h", h).orderBy("_h", *cols).limit(n).drop("_h")
