"""Removal of every byte under a 400-byte string that occurs elsewhere too.

1. Each 400-byte window is keyed by the least hash of its 32-byte strings; equal windows have equal keys, and
   neighbouring windows mostly share theirs, so a text becomes a few runs of windows.  Runs whose key
   occurs once in the corpus are done with.
2. The text under the other runs goes to the task of its key, equal stretches once.  There a Burrows-Wheeler
   transform is built, and breadth-first backward extension of intervals derives the common prefixes of
   neighbouring suffixes by increasing value.  It begins at the depth of the sort before the last, and stops at 400:
   neighbours without a value by then share 400 bytes at least.
3. Windows found go back to their documents, where the bytes they cover are removed.

Keys under which more text comes together than a task should hold are settled window by window by hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import discard, documents, mapped, materialize, partitions, slices

LENGTH = 400
GRAM = 32
#: Bytes that are sorted together, and the most that one key may bring to a task.
BATCH, MOST = 1 << 20, 4 << 20
_MIX = 0x9E3779B97F4A7C15


# ---- windows and runs ----------------------------------------------------------------------------------------

def _table() -> np.ndarray:
    z = np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    z = (z ^ (z >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return z ^ (z >> np.uint64(32))


_BYTES = _table()


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes (a power of two) from each position on; the last ones are not whole."""
    h, span = _BYTES[data], 1
    while span < gram:
        h[:-span] = h[:-span] * np.uint64(pow(_MIX, span, 1 << 64)) + h[span:]
        span *= 2
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def runs(texts: list[bytes], length: int = LENGTH, gram: int | None = None) -> tuple[np.ndarray, ...]:
    """Runs of windows with one key: text, key, first start, start after the last, and whether the string of
    the key (``GRAM`` bytes, fewer for short windows) occurs more than once under the run."""
    gram = gram or min(GRAM, 1 << max(0, (length // 2).bit_length() - 1))
    sizes = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts) + b"\0" * length, dtype=np.uint8)
    h = gram_hashes(data, gram)
    width = length - gram + 1
    low, span = h.copy(), 1
    while span * 2 <= width:
        low[:-span] = np.minimum(low[:-span], low[span:])
        span *= 2
    low[:len(low) - (width - span)] = np.minimum(low[:len(low) - (width - span)], low[width - span:])
    at = np.cumsum(sizes) - sizes
    windows = np.maximum(sizes - length + 1, 0)
    some = np.flatnonzero(windows)
    if not len(some):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    # starts of all texts one after the other
    ends = np.cumsum(windows[some])
    first = ends - windows[some]
    start = np.arange(ends[-1]) + np.repeat(at[some] - first, windows[some])
    v = low[start]
    new = np.append(True, v[1:] != v[:-1])
    new[first] = True
    r0 = np.flatnonzero(new)
    r1 = np.append(r0[1:], len(v))
    text = some[np.searchsorted(ends, r0, side="right")]
    hits = np.append(0, np.cumsum(h[start] == v))
    twice = np.empty(len(r0), dtype=bool)
    for i in range(0, len(r0), 4096):  # hits before the last window, and in it
        a, b = r0[i:i + 4096], r1[i:i + 4096] - 1
        last = (h[start[b][:, None] + np.arange(width)] == v[b][:, None]).sum(axis=1)
        twice[i:i + 4096] = hits[b] - hits[a] + last > 1
    s0 = start[r0] - at[text]
    return text, v[r0].view(np.int64), s0, s0 + (r1 - r0), twice


# ---- Burrows-Wheeler transform and interval expansion -----------------------------------------------------------

def rotation_order(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Rotations of ``data`` ordered by their first ``depth`` bytes, by prefix tripling (doubling, if three ranks have more
    than 63 bits); classes that are settled are not sorted again.  Also the places, ``len(data)`` last, at which the
    classes of an earlier sort end, and the number of bytes, fewer than ``depth``, by which it was."""
    n = len(data)
    span = min(8, depth - 1)
    ring = np.concatenate([data, np.resize(data, span)]).astype(np.uint64)
    key = np.zeros(n, dtype=np.uint64)
    for k in range(span):
        key = (key << np.uint64(8)) | ring[k:k + n]
    order = np.argsort(key)
    key = key[order]
    head = np.append(True, key[1:] != key[:-1])
    rank = np.empty(n + depth, dtype=np.int64)  # the first ones again at the end
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    bits = n.bit_length()
    while True:
        rank[n:] = np.resize(rank[:n], depth)
        ends, sorted_by = np.append(np.flatnonzero(head[1:]) + 1, n), span
        lone = head & np.append(head[1:], True)
        open_at = np.flatnonzero(~lone)  # places in the order whose class is not settled
        own = order[open_at]
        key = rank[own]
        for k in range(1, 3 if 3 * bits < 64 else 2):
            step = min(k * sorted_by, depth - sorted_by)
            key = (key << bits) | rank[own + step]
            span = step + sorted_by
            if span == depth:
                break
        by = np.argsort(key)
        own, key = own[by], key[by]
        order[open_at] = own
        if span == depth:
            return order, ends, sorted_by
        change = np.append(True, key[1:] != key[:-1])[:len(key)]
        head[open_at] = change
        rank[own] = np.maximum.accumulate(np.where(change, open_at, 0))


def shared_prefixes(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rotations of ``data``, and for each place whether it shares ``length`` bytes with the place before.

    Intervals of the transform stand for strings; extending an interval by the byte before gives the interval of a
    string one longer.  In breadth-first order, the first interval to end at a place fixes the common prefix
    there to its string's length less one; only such intervals are extended on.  The first intervals are those of
    the sort before the last: what ends there has a shorter common prefix.
    """
    n = len(data)
    order, ends, known = rotation_order(data, length)
    bwt = data[order - 1]
    back = np.empty(n, dtype=np.int64)  # place of the rotation that starts one byte earlier
    back[np.argsort(bwt, kind="stable")] = np.arange(n)
    fixed = np.zeros(n + 1, dtype=bool)
    fixed[0] = fixed[ends] = True
    low, high = np.append(0, ends[:-1]), ends
    for value in range(known, length):  # the common prefixes of this value
        sizes = high - low
        one = sizes == 1
        lone = back[low[one]]
        wide_low, wide = low[~one], sizes[~one]
        # every byte that occurs in a wide interval: its first and last place there
        own = np.repeat(np.arange(len(wide)), wide)
        at = np.arange(wide.sum()) + np.repeat(wide_low - (np.cumsum(wide) - wide), wide)
        key = own * 256 + bwt[at]
        if len(key):
            by = np.argsort(key, kind="stable")
            key, at = key[by], at[by]
            edge = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            first, last = back[at[edge]], back[at[np.append(edge[1:], len(at)) - 1]] + 1
        else:
            first = last = np.zeros(0, dtype=np.int64)
        low, high = np.concatenate([lone, first]), np.concatenate([lone + 1, last])
        fresh = ~fixed[high]
        low, high = low[fresh], high[fresh]
        fixed[high] = True
        if not len(low):
            break
    return order, ~fixed[:n]


def repeated_windows(parts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each part the starts of its ``length``-byte windows that occur again in any of the parts."""
    # 0 parts them: bytes of UTF-8 end at 244
    data = np.concatenate([x for p in parts for x in (np.frombuffer(p, np.uint8) + np.uint8(1), np.zeros(1, np.uint8))])
    order, same = shared_prefixes(data, length)
    whole = np.zeros(len(data), dtype=bool)
    at = 0
    spans = []
    for p in parts:
        whole[at:at + max(0, len(p) - length + 1)] = True
        spans.append((at, at + max(0, len(p) - length + 1)))
        at += len(p) + 1
    hit = np.zeros(len(data), dtype=bool)
    hit[order[same]] = True
    hit[order[np.flatnonzero(same) - 1]] = True
    hit &= whole
    return [np.flatnonzero(hit[a:b]) for a, b in spans]


def _ranges(starts: np.ndarray) -> list[int]:
    """Runs of starts as first, after last, first, ..."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    return np.stack([starts[np.append(0, cut + 1)], starts[np.append(cut, len(starts) - 1)] + 1], axis=1).ravel().tolist()


# ---- the jobs -----------------------------------------------------------------------------------------------------

def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.md5(text).alias("key"))


def _spots(docs: DataFrame, length: int) -> DataFrame:
    """key, spots: the runs of each text whose window key occurs elsewhere, as (v, s0, s1)."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, most=2 << 20):
            text, v, s0, s1, twice = runs([t.encode("utf-8", "replace") for t in b.column("text").to_pylist()], length)
            yield pa.RecordBatch.from_arrays([b.column("key").take(pa.array(text, pa.int64())), pa.array(v, pa.int64()), pa.array(s0.astype(np.int32)),
                                              pa.array(s1.astype(np.int32)), pa.array(twice.astype(bool))], ["key", "v", "s0", "s1", "twice"])

    found = materialize(mapped(docs.where(F.octet_length("text") >= length).select("key", "text"), cut, "key string, v long, s0 int, s1 int, twice boolean"), "suffix-runs")
    place = F.struct("key", "s0")
    again = found.groupBy("v").agg(F.min(place).alias("a"), F.max(place).alias("b"), F.max("twice").alias("twice")).where("twice or a <> b").select("v")
    spots = found.join(again, "v").groupBy("key").agg(F.collect_set(F.struct("v", "s0", "s1")).alias("spots"))
    out = materialize(spots, "suffix-spots")
    discard(found)
    return out


def _stretches(docs: DataFrame, spots: DataFrame, length: int) -> DataFrame:
    """key, v, s0, part (text under a run's windows) for one row of each text with spots."""
    firsts = docs.groupBy("key").agg(F.min("doc_id").alias("first_id"))
    chosen = spots.join(firsts, "key")
    rows = docs.join(chosen, (docs["key"] == chosen["key"]) & docs["doc_id"].eqNullSafe(chosen["first_id"])).select(docs["key"], "text", "spots")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "v", "s0", "part", "mark"]
        for b in slices(batches, most=2 << 20):
            out = []
            for key, text, found in zip(b.column("key").to_pylist(), b.column("text").to_pylist(), b.column("spots").to_pylist(), strict=True):
                raw = text.encode("utf-8", "replace")
                for r in found:
                    part = raw[r["s0"]:r["s1"] + length - 1]
                    out.append((key, r["v"], r["s0"], part, hashlib.md5(part).digest()))
            if out:
                types = [pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    return mapped(rows, cut, "key string, v long, s0 int, part binary, mark binary")


def _expand(length: int):
    """Repeated windows of whole keys, as many keys at a time as make a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[bytes] = []
        marks: list[bytes] = []
        total, last = 0, None

        def done():
            found = repeated_windows(parts, length)
            some = [i for i, s in enumerate(found) if len(s)]
            return pa.RecordBatch.from_arrays([pa.array([marks[i] for i in some], pa.binary()), pa.array([_ranges(found[i]) for i in some], pa.list_(pa.int32()))],
                                              ["mark", "ranges"])

        for b in batches:
            for v, mark, part in zip(*[b.column(c).to_pylist() for c in ("v", "mark", "part")], strict=True):
                if v != last and total >= BATCH:
                    yield done()
                    parts, marks, total = [], [], 0
                parts.append(part)
                marks.append(mark)
                total, last = total + len(part), v
        if parts:
            yield done()

    return run


def _by_hash(crowded: DataFrame, length: int) -> DataFrame:
    """mark, ranges of stretches under crowded keys: their windows meet by 128-bit hash."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for mark, part in zip(b.column("mark").to_pylist(), b.column("part").to_pylist(), strict=True):
                for i in range(0, max(0, len(part) - length + 1), 5000):
                    starts = range(i, min(i + 5000, len(part) - length + 1))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([hashlib.md5(part[s:s + length]).digest() for s in starts], pa.binary()), pa.array([mark] * len(starts), pa.binary()), pa.array(starts, pa.int32())],
                        ["window", "mark", "s"])

    windows = mapped(crowded.select("mark", "part"), cut, "window binary, mark binary, s int")
    again = windows.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
    return windows.join(again, "window").groupBy("mark").agg(F.flatten(F.collect_list(F.array(F.col("s"), F.col("s") + 1))).alias("ranges"))


def repeats(docs: DataFrame, length: int = LENGTH, most: int = MOST) -> DataFrame:
    """key, whole, spans: for each text with repeated windows its md5, whether all of it occurs in another
    row, and else the byte ranges covered as first, after last, ... (unsorted, they may overlap)."""
    docs = _keyed(docs)
    spots = _spots(docs, length)
    stretches = materialize(_stretches(docs, spots, length), "suffix-stretches")
    discard(spots)
    parts = stretches.groupBy("v", "mark").agg(F.any_value("part").alias("part"), F.count("*").alias("n"))
    parts = materialize(parts.withColumn("size", F.octet_length("part")), "suffix-parts")
    crowded = parts.groupBy("v").agg((F.sum("size") > most).alias("crowded"))
    sorted_out = parts.join(crowded, "v")
    calm = sorted_out.where("not crowded").repartition(partitions(docs.sparkSession), "v").sortWithinPartitions("v", "mark")
    within = mapped(calm.select("v", "mark", "part"), _expand(length), "mark binary, ranges array<int>")
    within = within.unionByName(_by_hash(sorted_out.where("crowded"), length))
    multiple = parts.where("n > 1").select("mark", F.array(F.lit(0), (F.col("size") - length + 1).cast("int")).alias("ranges"))
    marks = materialize(within.unionByName(multiple), "suffix-marks")
    hits = stretches.select("key", "s0", "mark").join(marks, "mark")
    # windows first..after last cover bytes up to length - 1 further
    spans = F.transform("ranges", lambda x, i: F.col("s0") + x + F.when(i % 2 == 1, length - 1).otherwise(0))
    spans = hits.select("key", spans.alias("spans")).groupBy("key").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    copies = docs.where(F.octet_length("text") >= length).groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key", F.lit(True).alias("whole"))
    out = spans.join(copies, "key", "full").select("key", F.coalesce("whole", F.lit(False)).alias("whole"), F.when(F.col("whole"), None).otherwise(F.col("spans")).alias("spans"))
    out = materialize(out, "suffix-spans")
    discard(stretches, parts, marks)
    return out


def without(raw: bytes, whole: bool | None, spans: list[int] | None) -> tuple[bytes, int]:
    """``raw`` less the covered bytes, and the number of maximal runs removed."""
    if whole:
        return b"", int(len(raw) > 0)
    if not spans:
        return raw, 0
    kept, at, n = [], 0, 0
    for s, e in sorted(zip(spans[::2], spans[1::2], strict=True)):
        if s > at or n == 0:
            kept.append(raw[at:s])
            n += 1
        at = max(at, e)
    return b"".join([*kept, raw[at:]]), n


def deduplicate(docs: DataFrame, length: int = LENGTH, digest: bool = False, most: int = MOST) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) with every byte removed that is covered by a
    ``length``-byte string starting anywhere else, in the same text or another row.

    All occurrences go, the first too; overlapping strings count, and strings are judged on the input.  What
    is left of a character cut in two is dropped from the new text.  A null text stays null and counts as empty;
    rows with equal texts of ``length`` bytes or more lose them whole, whatever their ids are; shorter texts stay as they are; an
    empty table gives an empty one.  With ``digest``: doc_id, n_bytes, n_removed, n_spans, kept_sha256
    instead, on bytes.  Column names that begin with two underscores are this operator's own.
    """
    found = repeats(docs.select("doc_id", "text"), length, most)
    rows = docs.withColumn("__key", F.md5(F.coalesce("text", F.lit(""))))
    joined = rows.join(found.select(F.col("key").alias("__key"), F.col("whole").alias("__whole"), F.col("spans").alias("__spans")), "__key", "left").drop("__key")
    fields = docs.schema.fields
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = b.column("text").to_pylist()
            raw = [(t or "").encode("utf-8", "replace") for t in texts]
            kept = [without(r, w, s) for r, w, s in zip(raw, b.column("__whole").to_pylist(), b.column("__spans").to_pylist(), strict=True)]
            if digest:
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array([len(r) for r in raw], pa.int64()), pa.array([len(r) - len(k) for r, (k, _) in zip(raw, kept, strict=True)], pa.int64()),
                     pa.array([n for _, n in kept], pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k, _ in kept], pa.string())],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
            else:
                new = pa.array([t if n == 0 else k.decode("utf-8", "ignore") for t, (k, n) in zip(texts, kept, strict=True)], pa.string())
                yield pa.RecordBatch.from_arrays([new if c == "text" else b.column(c) for c in names], names)

    if digest:
        return mapped(joined.select("doc_id", "text", "__whole", "__spans"), run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return mapped(joined.select(*names, "__whole", "__spans"), run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns, and whether anything was removed."""
    return deduplicate(documents(spark, sf_dir), digest=True).withColumn("has_repeat", F.col("n_removed") > 0)


QUERIES = {"op5_suffix_dedup": op5_suffix_dedup}
ORACLES = {}
