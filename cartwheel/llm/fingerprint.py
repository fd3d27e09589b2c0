"""Document fingerprints by content-defined chunking.

A gear hash over the last 16 bytes marks cut points; normalised chunking makes them rare before the normal
size and frequent after it, so chunk sizes lie close together.  A cut depends on the bytes around it only:
an insertion moves the cuts after it along with the text.  A fingerprint is the set of its chunks' digests
with their lengths, and the likeness of a document to another text is the share of the document's chunk
bytes that the other one holds as well (containment).
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import documents, mapped, partitions, range_bounds, slices

LEAST, NORMAL, MOST = 16, 48, 256
#: Bits that must be zero before and after the normal size.
STRICT, LOOSE = np.uint32(0xFE000000), np.uint32(0xF0000000)
WINDOW = 16


def _gear() -> np.ndarray:
    """One random word per byte, by the splitmix64 rule."""
    z = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (z >> np.uint64(32)).astype(np.uint32)


GEAR = _gear()


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """For each byte the sum of its window's gear words, shifted by their distance: built by doubling."""
    h = GEAR[data]
    span = 1
    while span < WINDOW:
        h[span:] += h[:-span] << np.uint32(span)
        span *= 2
    return h


def chunked(texts: list[bytes]) -> list[list[int]]:
    """The ends of each text's chunks; none for an empty text."""
    pad = b"\0" * WINDOW  # windows never reach into the text before
    data = np.frombuffer(pad + pad.join(texts), dtype=np.uint8)
    h = gear_hashes(data)
    loose = np.flatnonzero((h & LOOSE) == 0)
    strict = loose[(h[loose] & STRICT) == 0].tolist()
    loose = loose.tolist()
    strict.append(len(data) + MOST)
    loose.append(len(data) + MOST)
    out, base, i, j = [], WINDOW, 0, 0
    for t in texts:
        at, end, cuts = base, base + len(t), []
        while at < end:
            # a chunk that ends after byte p has p + 1 - at bytes
            i = bisect_left(strict, at + LEAST - 1, i)
            cut = strict[i] + 1
            if cut > at + NORMAL:
                j = bisect_left(loose, at + NORMAL, j)
                cut = min(loose[j] + 1, at + MOST)
            at = min(cut, end)
            cuts.append(at - base)
        out.append(cuts)
        base = end + WINDOW
    return out


def fingerprints(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct chunks of each text: 48 bits of digest, 16 bits of length."""
    out = []
    digest = xxhash.xxh3_64_intdigest
    for t, cuts in zip(texts, chunked(texts), strict=True):
        chunks, at = set(), 0
        for cut in cuts:
            chunks.add((digest(t[at:cut]) & ~0xFFFF) | (cut - at))
            at = cut
        out.append(np.array(sorted(chunks), dtype=np.uint64))
    return out


def containment(one: np.ndarray, other: np.ndarray) -> float:
    """Share of the chunk bytes of ``one`` that ``other`` holds; two empty sets are alike, an empty and a full one are not."""
    if not len(one) or not len(other):
        return float(len(one) == len(other))
    bits = np.uint64(0xFFFF)
    both = np.intersect1d(one, other, assume_unique=True)
    return float((both & bits).sum() / (one & bits).sum())


def shown(chunks: np.ndarray) -> str:
    return base64.b64encode(chunks.astype(">u8").tobytes()).decode()


def parsed(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), dtype=">u8").astype(np.uint64)


def fingerprint_documents(docs: DataFrame, text: str = "text", column: str = "fingerprint") -> DataFrame:
    """``docs`` with ``column``, the fingerprint of its text (a null text counts as empty).

    Rows are fingerprinted alone; equal texts have equal fingerprints, the empty text the empty one.
    """
    fields = [f for f in docs.schema.fields if f.name != column]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text):
            found = fingerprints([(t or "").encode("utf-8", "replace") for t in b.column(text).to_pylist()])
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in names], pa.array(map(shown, found), pa.string())], [*names, column])

    return mapped(docs.select(*names), run, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [f"`{column}` string"]))


def with_next(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) dealt so that in each partition a row is followed by the next document by
    descending doc_id: place, lead, doc_id, text.

    Rows with ``lead`` are not the partition's own: they repeat the document that follows its last one (the
    first of the next range; after the lowest range the highest id).  Ranges are cut by quantiles of doc_id, so
    each text travels once and no range grows with the table; equal ids stay together, ordered by text.  Rows
    without an id have no next document and are marked by ``place`` >= number of ranges.
    """
    spark = docs.sparkSession
    parts = max(1, partitions(spark))
    bounds = np.array(range_bounds(docs, "doc_id", parts), dtype=np.int64)

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most: dict[int, int] = {}
        for b in batches:
            ids = np.asarray(b.column("doc_id"))
            place = np.searchsorted(bounds, ids, side="left")
            for p in np.unique(place).tolist():
                most[p] = max(most.get(p, -1 << 63), int(ids[place == p].max()))
        yield pa.RecordBatch.from_arrays([pa.array(most.keys(), pa.int32()), pa.array(most.values(), pa.int64())], ["place", "most"])

    heads = mapped(docs.select("doc_id").where("doc_id is not null"), firsts, "place int, most long")
    heads = sorted(heads.groupBy("place").agg(F.max("most").alias("most")).collect())  # one row per range
    above = [h.place for h in heads[1:]] + [h.place for h in heads[:1]]
    follows = {h.most: p for h, p in zip(heads, above, strict=True)}  # first id of a range → the range before it

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            keys = b.column("doc_id")
            ids = np.asarray(keys.fill_null(0))
            place = np.where(np.asarray(keys.is_valid()), np.searchsorted(bounds, ids, side="left"), parts + np.arange(len(ids)) % parts)
            again = [i for i, k in enumerate(keys.to_pylist()) if k in follows]
            rows = pa.array(list(range(len(ids))) + again, pa.int64())
            place = np.append(place, [follows[k] for k in keys.take(pa.array(again, pa.int64())).to_pylist()])
            lead = np.arange(len(place)) >= len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int32)), pa.array(lead), keys.take(rows), b.column("text").take(rows)],
                                             ["place", "lead", "doc_id", "text"])

    dealt = mapped(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), deal, "place int, lead boolean, doc_id long, text string")
    return dealt.repartitionById(2 * parts, F.col("place")).sortWithinPartitions("place", "lead", F.desc("doc_id"), "text")


def compare_with_next(docs: DataFrame) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    The edited text has its last half replaced by the next document's beginning, the next document being the
    one with the next smaller doc_id, after the smallest the largest.  Of rows with one id each follows the
    other by text; a row without id, and the only row of a table, is its own next document.  Null texts
    count as empty; an empty table gives an empty one.
    """
    lone = max(1, partitions(docs.sparkSession))
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: tuple | None = None  # the last row: (place, doc_id, text)

        def pairs(b: pa.RecordBatch) -> Iterator[tuple]:
            nonlocal waiting
            for row in zip(*[b.column(c).to_pylist() for c in ("place", "lead", "doc_id", "text")], strict=True):
                place, lead, key, text = row
                if place >= lone:
                    yield (key, text, text)
                    continue
                if waiting:
                    if waiting[0] == place:
                        yield (waiting[1], waiting[2], text)
                        waiting = None
                if not lead:
                    waiting = (place, key, text)

        for b in slices(batches):
            rows = list(pairs(b))
            if not rows:
                continue
            texts = [t for _, t, _ in rows]
            edited = [(t[:len(t) - len(t) // 2] + n[:len(t) // 2]).encode("utf-8", "replace") for _, t, n in rows]
            raw = [t.encode("utf-8", "replace") for t in texts]
            # the next row's text is mostly this batch's own next one: fingerprint each text once
            own = fingerprints(raw)
            nexts = [own[i + 1] if i + 1 < len(rows) and rows[i + 1][1] is n else None for i, (_, _, n) in enumerate(rows)]
            missing = [i for i, x in enumerate(nexts) if x is None]
            for i, x in zip(missing, fingerprints([rows[i][2].encode("utf-8", "replace") for i in missing]), strict=True):
                nexts[i] = x
            changed = fingerprints(edited)
            yield pa.RecordBatch.from_arrays([
                pa.array([k for k, _, _ in rows], pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(e).hexdigest() for e in edited]), pa.array([shown(f) for f in own]),
                pa.array([shown(f) for f in changed]),
                pa.array([containment(f, c) for f, c in zip(own, changed, strict=True)], pa.float64()),
                pa.array([containment(f, n) for f, n in zip(own, nexts, strict=True)], pa.float64())], names)

    return mapped(with_next(docs), run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                        "edited_fingerprint string, near_edited double, near_next double")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(documents(spark, sf_dir))


QUERIES = {"op1_fingerprints": op1_fingerprints}
ORACLES = {}
