"""Hard negatives by a vertical scan (branch and bound over dimensions).

A task holds a group of rows by dimension, in blocks, and takes its anchors one after the other.  An anchor reads
the dimensions of a block in the order of its own components' magnitudes, largest first, a few at a time.
After each step a candidate's score lies between its partial sum plus the least and plus the most that the
unread dimensions can add in this block (the block's extremes per dimension).  Candidates whose interval cannot
reach what is asked for leave the bitmap; with all dimensions read the rest are exact.

Two scans with one kernel: the first finds an anchor's best rows of its own label (its positives), the second the
best rows of other labels in one score window per positive.  What earlier blocks of a task found raises the floor
for later ones.  Every pair of a row group and an anchor chunk is one task's work, so neither the rows nor the
anchors are ever in one place; groups and chunks are dealt by a hash of the id, whatever the labels are.

Rows with a null id, label or vector, or with a null or non-finite component take no part; of rows with one id
the least (label, vector) does.  Shorter vectors count as filled up with zeros.  Scores are exact while they
fit 64 bits.  An anchor without positives, or a positive without negatives in its window, gives no rows, as does
an empty table.  Other columns of the input may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import mapped, materialize, partitions, table

#: Rows of a block, dimensions read between two looks at the bitmap.
BLOCK, STEP = 4096, 8
#: Bytes of a task's row group, and anchors of a chunk; the tasks are all pairs of a group and a chunk.
GROUP_BYTES, CHUNK = 48 << 20, 100_000
SCALE = 256


def usable(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, label, vec (components floor(SCALE * x)) of the rows that take part, one per id."""
    v = F.col(f"`{vector}`")
    finite = F.forall(v, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    vec = F.transform(v, lambda x: F.floor(x.cast("double") * SCALE))
    found = rows.where(F.col(f"`{key}`").isNotNull() & F.col(f"`{label}`").isNotNull() & v.isNotNull() & finite)
    one = found.select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.struct(F.col(f"`{label}`").cast("long").alias("label"), vec.alias("vec")).alias("r"))
    return one.groupBy("vec_id").agg(F.min("r").alias("r")).select("vec_id", "r.label", "r.vec")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of ``width`` numbers, shorter lists filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten())
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.concatenate([np.arange(s) for s in sizes]) if len(flat) else np.zeros(0, int)] = flat
    return out


class Block:
    """Rows by dimension: ids, labels, one line of components per dimension and its extremes."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        self.ids, self.labels = ids, labels
        self.lines = np.ascontiguousarray(rows.T)
        self.low, self.high = self.lines.min(axis=1), self.lines.max(axis=1)


def _kth(values: np.ndarray, k: int):
    """The k-th largest."""
    return np.partition(values, len(values) - k)[len(values) - k]


class Wanted:
    """The best ``k`` (score, id) so far within the scores [low, high]."""

    def __init__(self, k: int, low=None, high=None):
        self.k, self.low, self.high, self.best = k, low, high, []

    def open(self, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Which candidates, with scores between ``least`` and ``most``, may still be among the best."""
        floor = self.low
        if len(self.best) == self.k:
            floor = self.best[-1][0] if floor is None else max(floor, self.best[-1][0])
        sure = least
        if self.low is not None:
            sure = least[(least >= self.low) & (most <= self.high)]
        if len(sure) >= self.k:
            floor = _kth(sure, self.k) if floor is None else max(floor, _kth(sure, self.k))
        may = np.ones(len(least), dtype=bool) if floor is None else most >= floor
        return may if self.high is None else may & (least <= self.high)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if self.low is not None:
            within = (scores >= self.low) & (scores <= self.high)
            scores, ids = scores[within], ids[within]
        if len(scores) > self.k:
            near = scores >= _kth(scores, self.k)
            scores, ids = scores[near], ids[near]
        order = np.lexsort((ids, -scores))[:self.k]
        found = [(int(scores[i]), int(ids[i])) for i in order]
        self.best = sorted(self.best + found, key=lambda r: (-r[0], r[1]))[:self.k]


def scan(block: Block, anchor: np.ndarray, candidates: np.ndarray, wanted: list[Wanted]) -> None:
    """Add to ``wanted`` what the block's ``candidates`` (row numbers) offer the anchor."""
    order = np.argsort(-np.abs(anchor), kind="stable")
    weights = anchor[order]
    ends = np.stack([weights * block.low[order], weights * block.high[order]])
    # what the dimensions from a place on can add at least and at most
    least = np.append(np.cumsum(ends.min(axis=0)[::-1])[::-1], 0)
    most = np.append(np.cumsum(ends.max(axis=0)[::-1])[::-1], 0)
    partial_sums = np.zeros(len(candidates), dtype=block.lines.dtype)
    for at in range(0, len(order), STEP):
        if not len(candidates):
            return
        dims = order[at:at + STEP]
        partial_sums = partial_sums + weights[at:at + STEP] @ block.lines[np.ix_(dims, candidates)]
        rest = min(at + STEP, len(order))
        low, high = partial_sums + least[rest], partial_sums + most[rest]
        keep = wanted[0].open(low, high)
        for w in wanted[1:]:
            keep |= w.open(low, high)
        if not keep.all():
            candidates, partial_sums = candidates[keep], partial_sums[keep]
    if len(candidates):
        for w in wanted:
            w.add(partial_sums, block.ids[candidates])


def _blocks(batches: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> list[Block]:
    if not batches:
        return []
    ids, labels, rows = (np.concatenate(x) for x in zip(*batches, strict=True))
    return [Block(ids[i:i + BLOCK], labels[i:i + BLOCK], rows[i:i + BLOCK]) for i in range(0, len(ids), BLOCK)]


def _paired(batches: Iterator[pa.RecordBatch], width: int, exact, answer) -> Iterator[pa.RecordBatch]:
    """Batches sorted by place, a place's rows before its anchors: ``answer(blocks, id, label, vector, scores)`` gives
    lists for each anchor."""
    place, rows, blocks = None, [], None
    for b in batches:
        places, anchor = np.asarray(b.column("place")), np.asarray(b.column("anchor"))
        ids, labels = np.asarray(b.column("vec_id")), np.asarray(b.column("label"))
        vectors = _matrix(b.column("vec"), width).astype(exact)
        scores = b.column("scores").to_pylist()
        out: list[tuple] = []
        cuts = np.flatnonzero(np.diff(places) | np.diff(anchor.astype(np.int8))) + 1
        for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ids)], strict=True):
            if s == e:
                continue
            if places[s] != place:
                place, rows, blocks = places[s], [], None
            if not anchor[s]:
                rows.append((ids[s:e], labels[s:e], vectors[s:e]))
                continue
            if blocks is None:
                blocks, rows = _blocks(rows), []
            for i in range(s, e):
                out += answer(blocks, int(ids[i]), labels[i], vectors[i], scores[i])
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)],
                                             ["anchor_id", "positive_id", "positive_score", "other_id", "score"])


_FOUND = "anchor_id long, positive_id long, positive_score long, other_id long, score long"


def _positives(blocks, key, label, vector, _, k):
    want = Wanted(k)
    for b in blocks:
        scan(b, vector, np.flatnonzero((b.labels == label) & (b.ids != key)), [want])
    return [(key, None, None, i, s) for s, i in want.best]


def _negatives(blocks, key, label, vector, positives, k, low, high):
    """``low`` and ``high``: the window in hundredths of the positive's score."""
    wanted = {}
    for p in positives:
        least, most = -((-low * p["score"]) // 100), (high * p["score"]) // 100
        if least <= most:
            wanted[p["other_id"]] = Wanted(k, least, most), p["score"]
    for b in blocks:
        if wanted:
            scan(b, vector, np.flatnonzero(b.labels != label), [w for w, _ in wanted.values()])
    return [(key, p, score, i, s) for p, (w, score) in wanted.items() for s, i in w.best]


class Scans:
    """The rows, dealt to groups; ``run`` holds all of them against anchors."""

    def __init__(self, rows: DataFrame):
        self.rows = rows
        n, self.width, largest = rows.agg(
            F.count(F.lit(1)), F.coalesce(F.max(F.size("vec")), F.lit(0)),
            F.coalesce(F.max(F.aggregate("vec", F.lit(0).cast("long"), lambda m, x: F.greatest(m, F.abs(x)))), F.lit(0))).first()
        #: Doubles add up whole numbers exactly up to 2^53, and faster than 64-bit integers.
        self.exact = np.float64 if self.width * float(largest) ** 2 < 2 ** 53 else np.int64
        most = max(BLOCK, GROUP_BYTES // (8 * max(1, self.width)))
        spread = min(partitions(rows.sparkSession), -(-n // BLOCK))
        self.groups = max(1, -(-n // most), spread)

    def run(self, anchors: DataFrame, answer) -> DataFrame:
        """``anchors``: vec_id, label, vec, scores.  What ``answer`` found in each group of rows."""
        chunks = max(1, -(-anchors.count() // CHUNK))
        dealt = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        columns = [(F.col("g") * chunks + F.col("c")).cast("int").alias("place"), "anchor", "vec_id", "label", "vec", "scores"]
        scores = anchors.schema["scores"].dataType
        left = self.rows.select("*", F.lit(False).alias("anchor"), F.lit(None).cast(scores).alias("scores"), dealt(self.groups, 1).alias("g"), every(chunks).alias("c"))
        right = anchors.select("*", F.lit(True).alias("anchor"), dealt(chunks, 2).alias("c"), every(self.groups).alias("g"))
        both = left.select(*columns).unionByName(right.select(*columns))
        both = both.repartitionById(self.groups * chunks, F.col("place")).sortWithinPartitions("place", "anchor")
        return mapped(both, partial(_paired, width=self.width, exact=self.exact, answer=answer), _FOUND)


def _ranked(found: DataFrame, keys: list[str | Column], k: int) -> DataFrame:
    """The best ``k`` of what all groups found (at most ``k`` per group and key)."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "other_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """``rows``: vec_id, label, vec (whole numbers), one row per id, written somewhere; ``anchors``: which of them ask.

    anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor and each of its
    first ``positives`` rows of the same label the first ``negatives`` rows of other labels whose score lies within
    ``low`` to ``high`` hundredths of the positive's; scores descend, ties by id."""
    scans = Scans(rows)
    asking = rows.where(anchors)
    nothing = F.array().cast("array<struct<other_id:long,score:long>>")
    found = scans.run(asking.withColumn("scores", nothing), partial(_positives, k=positives))
    best = _ranked(found, ["anchor_id"], positives)
    best = best.groupBy("anchor_id").agg(F.collect_list(F.struct("other_id", "score")).alias("scores"))  # at most ``positives``
    asking = materialize(asking.join(best, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id"), "hard-positives")
    found = scans.run(asking, partial(_negatives, k=negatives, low=low, high=high))
    return _ranked(found, ["anchor_id", "positive_id"], negatives).select(
        "anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = usable(table(spark, sf_dir, "embeddings"))
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(materialize(rows, "hard-vectors"), F.col("vec_id") % 100 == 0)


QUERIES = {"op12_hard_negatives": op12_hard_negatives}
ORACLES = {
    "op12_hard_negatives": """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_dot_product(a.v, b.v)::BIGINT AS score
  FROM whole a JOIN whole b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)::INTEGER AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
 AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) <= 5
""",
}
