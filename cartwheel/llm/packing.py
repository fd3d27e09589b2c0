"""Best-fit packing of tokenised documents into sequences, in bulk-synchronous rounds.

State is two tables: units waiting (length) and sequences open (gap).  A round sorts both by size over range
partitions and sweeps each range once: a gap takes the largest waiting unit not longer than itself, as
brackets are matched, so each unit goes to its successor among the gaps and each gap to one unit; what a
gap has left is swept again as long as its range finds takers.  What a range leaves over is matched across
ranges by rank: the driver sees two counts per range and pairs runs of ranks, tasks join on them.  Gaps are
updated and the round is repeated until nothing fits; then as many new sequences as the rest needs at least
are opened by its longest units.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import documents, mapped, materialize, slices
from cartwheel.llm.tokens import encoder, vocabulary_path

CAPACITY = 2048
END_ID = 0
#: Documents shorter than SHORT tokens are joined, as a task meets them, into units of at most twice that, so that
#: a sequence takes few rounds to fill whatever the documents' lengths are.
SHORT = 64
#: Rows that a range of a round holds.
RANGE_ROWS = 100_000
#: Lots among which units of one length are drawn.
LOTS = 1 << 14


def pieces_of(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece of each document: doc_id, piece, start, length, ids_crc32, unit, inner, head.

    A document's ids, ``end_id`` after them, are cut into pieces of ``capacity``.  ``unit`` numbers what is packed as
    a whole, ``inner`` is the piece's place in it, ``head`` the unit's length, on its first piece only.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        end = np.array([end_id], dtype="<u4").tobytes()
        unit, bundle, inner = TaskContext.get().partitionId() << 36, [], 0
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "unit", "inner", "head"]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        rows: list[tuple] = []

        def close():
            rows.extend((*r, inner if i == 0 else None) for i, r in enumerate(bundle))

        def out():
            cols = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

        loose = unit  # number of the bundle that is being filled
        unit += 1
        for b in slices(batches, most=8 << 20):  # the more words, the oftener each distinct one
            for key, ids in zip(b.column("doc_id").to_pylist(), enc.encode(b.column("text").to_pylist()), strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    n = len(part) // 4
                    row = (key, k, at // 4, n, zlib.crc32(part))
                    if n >= min(SHORT, capacity // 4):
                        rows.append((*row, unit, 0, n))
                        unit += 1
                        continue
                    if inner + n > min(2 * SHORT, capacity):
                        close()
                        bundle, inner, loose, unit = [], 0, unit, unit + 1
                    bundle.append((*row, loose, inner))
                    inner += n
            if len(rows) > 5000:
                yield out()
                rows = []
        close()
        if rows:
            yield out()

    return mapped(docs.select("doc_id", "text"), run,
                  "doc_id long, piece int, start long, length long, ids_crc32 long, unit long, inner long, head long")


def _sweep(sizes: list[int], ids: list[int], gap: list[bool]) -> tuple[list[tuple[int, int, int, int]], list[tuple[int, int]], list[tuple[int, int]]]:
    """Rows by rising size, units before gaps of their size.  Returns the pairs (unit, length, sequence, gap),
    the units left by falling length and the gaps left by rising size."""
    pairs: list[tuple[int, int, int, int]] = []
    waiting: list[tuple[int, int]] = []
    unmatched: list[tuple[int, int]] = []
    rest: list[tuple[int, int]] = []
    for n, i, g in zip(sizes, ids, gap, strict=True):
        if not g:
            waiting.append((n, i))
        elif waiting:
            length, u = waiting.pop()
            pairs.append((u, length, i, n))
            rest.append((n - length, i))
        else:
            unmatched.append((n, i))
    while waiting and rest:  # what matched gaps have left, as long as this range has takers
        least = waiting[0][0]
        rest = [r for r in rest if r[0] >= least]
        both = sorted([(n, 0, i) for n, i in waiting] + [(n, 1, i) for n, i in rest])
        waiting, left, before = [], [], len(pairs)
        for n, g, i in both:
            if not g:
                waiting.append((n, i))
            elif waiting:
                length, u = waiting.pop()
                pairs.append((u, length, i, n))
                left.append((n - length, i))
            else:
                left.append((n, i))
        rest = left
        if len(pairs) == before:
            break
    return pairs, waiting[::-1], unmatched


def _round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sweep one range.  Rows out: kind 'pair' (unit, length, sequence, gap), or 'unit' / 'gap' left with their rank."""
    table = pa.Table.from_batches(list(batches))
    if not table.num_rows:
        return
    order = np.lexsort((table["id"].to_numpy(), table["gap"].to_numpy(zero_copy_only=False), table["size"].to_numpy()))
    cols = [table[c].to_numpy(zero_copy_only=False)[order].tolist() for c in ("size", "id", "gap")]
    pairs, units, gaps = _sweep(*cols)
    part = TaskContext.get().partitionId()
    rows = [("pair", u, n, s, g, 0) for u, n, s, g in pairs]
    rows += [("unit", u, n, None, None, k) for k, (n, u) in enumerate(units)]
    rows += [("gap", None, None, s, g, k) for k, (g, s) in enumerate(gaps)]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
    yield pa.RecordBatch.from_arrays([*arrays, pa.array([part] * len(rows), pa.int32())],
                                     ["kind", "unit", "length", "sequence", "gap", "rank", "part"])


_ROUND = "kind string, unit long, length long, sequence long, gap long, rank long, part int"


def _across(counts: dict[int, tuple[int, int]]) -> list[tuple[str, int, int, int, int]]:
    """Pair what ranges have left: (kind, range, first rank, number, first match) for units and gaps.

    Ranges by rising size; all gaps left in a range fit all units left in earlier ones.  A range's gaps take
    the longest units of the nearest earlier range.
    """
    out, stack, match = [], [], 0
    for part in sorted(counts):
        units, gaps = counts[part]
        used = 0
        while used < gaps and stack:
            other, first, left = stack.pop()
            n = min(left, gaps - used)
            out += [("unit", other, first, n, match), ("gap", part, used, n, match)]
            match, used = match + n, used + n
            if left > n:
                stack.append((other, first + n, left - n))
        if units:
            stack.append((part, 0, units))
    return out


def pack(units: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """unit, sequence, offset for every row of ``units`` (unit: distinct longs, length: 1 to ``capacity``).

    A sequence is numbered by the unit that opens it; offsets leave no holes.  Ties in length are broken by
    unit, an empty table gives an empty one.
    """
    units = units.select("unit", F.col("length").cast("long").alias("length"))
    placed = [units.where(F.col("length") == capacity).select("unit", F.col("unit").alias("sequence"), F.lit(0).cast("long").alias("offset"))]
    waiting = units.where(F.col("length") < capacity)
    while True:
        sizes = waiting.groupBy("length").agg(F.count("*").alias("n")).collect()  # at most `capacity` rows
        if not sizes:
            break
        opened, rest = _opened(waiting, {r.length: r.n for r in sizes}, capacity)
        opened = materialize(opened, "packing-opened")
        placed.append(opened.select("unit", F.col("unit").alias("sequence"), F.lit(0).cast("long").alias("offset")))
        gaps = opened.select(F.col("unit").alias("sequence"), (capacity - F.col("length")).alias("gap"))
        pairs, waiting = _fill(rest, gaps, sum(r.n for r in sizes), capacity)
        placed += pairs
    out = placed[0]
    for p in placed[1:]:
        out = out.unionByName(p)
    return out


def _opened(waiting: DataFrame, sizes: dict[int, int], capacity: int) -> tuple[DataFrame, DataFrame]:
    """The longest units, as many as the rest needs sequences at least (all longer than half a sequence open one), and the others."""
    need = max(-(-sum(n * k for n, k in sizes.items()) // capacity), sum(k for n, k in sizes.items() if 2 * n > capacity))
    shortest = 0
    for n in sorted(sizes, reverse=True):
        if sizes[n] >= need:
            shortest = n
            break
        need -= sizes[n]
    # of the units of the least length that opens, as many as are needed, by hash
    bucket = F.pmod(F.xxhash64("unit"), F.lit(LOTS))
    last = -1
    if shortest:
        lots = waiting.where(F.col("length") == shortest).groupBy(bucket.alias("lot")).agg(F.count("*").alias("n"))
        for r in sorted(lots.collect()):  # at most LOTS rows
            if need <= 0:
                break
            last, need = r.lot, need - r.n
    chosen = (F.col("length") > shortest) | ((F.col("length") == shortest) & (bucket <= last))
    return waiting.where(chosen), waiting.where(~chosen)


def _matched(runs: list[tuple[str, int, int, int, int]]):
    """Number the rows left by the pairs of ``_across`` that they belong to: equal numbers are a pair."""
    table: dict[tuple[str, int], list[tuple[int, int, int]]] = {}
    for kind, part, first, n, base in runs:
        table.setdefault((kind, part), []).append((first, n, base))
    table = {k: sorted(v) for k, v in table.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for kind, part, rank in zip(*[b.column(c).to_pylist() for c in ("kind", "part", "rank")], strict=True):
                own = table.get((kind, part), [])
                at = bisect_right(own, (rank, 1 << 62, 0)) - 1
                out.append(own[at][2] + rank - own[at][0] if at >= 0 and rank < own[at][0] + own[at][1] else None)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.int64())], [*b.schema.names, "match"])

    return run


def _fill(waiting: DataFrame, gaps: DataFrame, rows: int, capacity: int) -> tuple[list[DataFrame], DataFrame]:
    """Rounds until no waiting unit fits a gap: tables of placements, and the units left.  ``rows``: units waiting."""
    placed = []
    while True:
        state = (waiting.select(F.col("length").alias("size"), F.col("unit").alias("id"), F.lit(False).alias("gap"))
                 .unionByName(gaps.select(F.col("gap").alias("size"), F.col("sequence").alias("id"), F.lit(True).alias("gap"))))
        n = -(-rows // RANGE_ROWS)
        ranged = state.repartitionByRange(n, "size", "gap", "id") if n > 1 else state.coalesce(1)
        done = materialize(mapped(ranged, _round, _ROUND), "packing-round")
        counts: dict[int, list[int]] = {}
        swept = 0
        for r in done.groupBy("part", "kind").agg(F.count("*").alias("n")).collect():  # three rows a range at most
            swept += r.n if r.kind == "pair" else 0
            if r.kind != "pair":
                counts.setdefault(r.part, [0, 0])[r.kind == "gap"] = r.n
        runs = _across({k: (u, g) for k, (u, g) in counts.items()})
        pairs = done.where("kind = 'pair'").select("unit", "length", "sequence", "gap")
        left = mapped(done.where("kind <> 'pair'"), _matched(runs), _ROUND + ", match long")
        rest = left.where("match is null")
        if runs:
            met = left.where("match is not null")
            matched = met.where("kind = 'unit'").select("match", "unit", "length").join(
                met.where("kind = 'gap'").select("match", "sequence", "gap"), "match").drop("match")
            pairs = materialize(pairs.unionByName(matched), "packing-pairs")
        if not swept and not runs:
            return placed, rest.where("kind = 'unit'").select("unit", "length")
        placed.append(pairs.select("unit", "sequence", (capacity - F.col("gap")).alias("offset")))
        waiting = rest.where("kind = 'unit'").select("unit", "length")
        # a gap may have taken several units of its range: what is left is after the last of them
        shrunk = pairs.groupBy("sequence").agg(F.min(F.col("gap") - F.col("length")).alias("gap"))
        gaps = shrunk.unionByName(rest.where("kind = 'gap'").select("sequence", "gap"))
        left_now = waiting.agg(F.count("*").alias("n"), F.min("length").alias("least")).first()
        if not left_now.n:
            return placed, waiting
        gaps = gaps.where(F.col("gap") >= left_now.least)
        rows = left_now.n


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Every piece of every row of ``docs`` (doc_id, text) with its sequence: doc_id, piece, start, length,
    ids_crc32, sequence_id, offset.

    A null or empty text has the end id alone.  Each row is a document of its own, so equal rows and equal
    or null ids are packed as often as they occur; an empty table gives an empty one.
    """
    pieces = materialize(pieces_of(docs, vocabulary, capacity, end_id), "packing-pieces")
    placed = pack(pieces.where("head is not null").select("unit", F.col("head").alias("length")), capacity)
    return pieces.join(placed.withColumnRenamed("offset", "__at"), "unit").select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.col("sequence").alias("sequence_id"),
        (F.col("__at") + F.col("inner")).alias("offset"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), vocabulary_path())


QUERIES = {"op2_packing": op2_packing}
ORACLES = {}
