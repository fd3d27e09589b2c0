"""Token ids as files of frequency-ranked, byte-aligned variable-length integers.

A file is a Parquet table of blocks (so that Spark's commit protocol makes it whole or absent).  The payload
of a block, all little-endian:

    4 bytes   b"FRV1"
    3 x u32   number of documents D, of ids N, of distinct ids K
    K x u32   the distinct ids by falling frequency in the block (ties: the smaller id first)
    D x u32   number of ids of each document
    ceil(N/4) control bytes: two bits per id, first id lowest: bytes of its rank, less one
    ...       data bytes: the ranks, each in 1 to 4 bytes

Ranks are taken per block, so no pass over the corpus is needed before writing and a reader needs one block
at a time.  Blocks hold about ``BLOCK_IDS`` ids (a longer document is a block of its own).
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartwheel.llm.common import documents, mapped, partitions, range_bounds, slices
from cartwheel.llm.tokens import encoder, vocabulary_path
from cartwheel.session import ensure_checkpoint_dir

MAGIC = b"FRV1"
BLOCK_IDS = 1 << 20
END_ID = 2
#: Ids below are counted in an array of all ids up to the greatest.
DENSE = 1 << 20
#: Bytes of each of the four ranks behind a control byte, and the bits of a rank of so many bytes.
LENGTHS = (((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1).astype(np.uint8)
OWN = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype=np.uint32)


def pack(ids: np.ndarray, sizes: np.ndarray) -> bytes:
    """One block's payload from all its ids and the number of ids of each document."""
    if len(ids) and int(ids.max()) < DENSE:
        counts = np.bincount(ids)  # no sorting of all ids
        distinct = np.flatnonzero(counts)
        by_rank = np.argsort(-counts[distinct], kind="stable")
        rank = np.empty(len(counts), dtype=np.uint32)
        rank[distinct[by_rank]] = np.arange(len(distinct), dtype=np.uint32)
        r = rank[ids]
    else:
        distinct, inverse, counts = np.unique(ids, return_inverse=True, return_counts=True)
        by_rank = np.argsort(-counts, kind="stable")
        rank = np.empty(len(distinct), dtype=np.uint32)
        rank[by_rank] = np.arange(len(distinct), dtype=np.uint32)
        r = rank[inverse]
    lengths = np.ones(-(-len(r) // 4) * 4, dtype=np.uint8)
    width = 1
    for top in (0xFF, 0xFFFF, 0xFFFFFF):
        if len(distinct) > top + 1:
            lengths[:len(r)] += r > top
            width += 1
    whole = 4 if width > 2 else 2
    wide = r.astype(f"<u{whole}").view(np.uint8).reshape(-1, whole)[:, :width]
    data = wide[lengths[:len(r), None] > np.arange(width, dtype=np.uint8)]
    codes = (lengths - np.uint8(1)).reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    head = np.array([len(sizes), len(ids), len(distinct)], dtype="<u4")
    return b"".join([MAGIC, head.tobytes(), distinct[by_rank].astype("<u4").tobytes(), sizes.astype("<u4").tobytes(),
                     control.tobytes(), data.tobytes()])


def unpack(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a block and the number of ids of each document."""
    if payload[:4] != MAGIC:
        raise ValueError("not a block of ranked ids")
    d, n, k = np.frombuffer(payload, dtype="<u4", count=3, offset=4).tolist()
    at = 16
    table = np.frombuffer(payload, dtype="<u4", count=k, offset=at)
    at += 4 * k
    sizes = np.frombuffer(payload, dtype="<u4", count=d, offset=at)
    at += 4 * d
    control = np.frombuffer(payload, dtype=np.uint8, count=-(-n // 4), offset=at)
    at += len(control)
    lengths = LENGTHS[control].reshape(-1)[:n]
    # of two or four bytes read at each rank's first one, its own are kept
    kind = "<u2" if lengths.max(initial=1) <= 2 else "<u4"
    data = np.ndarray(len(payload) - at, kind, payload[at:] + bytes(4), strides=(1,))
    starts = np.cumsum(lengths, dtype=np.int64)
    starts -= lengths
    r = data[starts] & OWN[lengths].astype(kind)
    return table[r], sizes


def write_ids(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> None:
    """Encode ``docs`` (doc_id, text) and write their ids, each document's closed by ``end_id``, to ``path``.

    Documents lie in ascending doc_id order by (part, block, place in the block).  A null or empty text has the end id only.
    Rows with equal ids lie side by side in any order; rows without id come last, in any order.  An empty
    table gives a file without blocks.
    """
    spark = docs.sparkSession
    parts = max(1, partitions(spark))
    bounds = np.array(range_bounds(docs, "doc_id", parts), dtype=np.int64)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        end = np.array([end_id], dtype="<u4").tobytes()
        for b in slices(batches, most=8 << 20):  # the more words, the oftener each distinct one
            ids = [x + end for x in enc.encode(b.column("text").to_pylist())]
            keys = b.column("doc_id")
            known = np.asarray(keys.is_valid())
            part = np.searchsorted(bounds, np.asarray(keys.fill_null(0)), side="left")
            part = np.where(known, part, parts + np.arange(len(part)) % parts)
            small = [np.frombuffer(x, "<u4") for x in ids]
            # ids below 65536 need half the bytes on their way
            ids = [x.astype("<u2").tobytes() if x.max() < 65536 else b"\0" + x.tobytes() for x in small]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), keys, pa.array(ids, pa.binary())], ["part", "doc_id", "ids"])

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block_no, keys, arrays, total = None, 0, [], [], 0

        def close():
            sizes = np.array([len(x) for x in arrays], dtype=np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block_no], pa.int32()), pa.array([total], pa.int64()),
                 pa.array([list(keys)], pa.list_(pa.int64())), pa.array([pack(np.concatenate(arrays), sizes)], pa.binary())],
                ["part", "block", "n_ids", "doc_ids", "payload"])

        for b in batches:
            for p, key, x in zip(b.column("part").to_pylist(), b.column("doc_id").to_pylist(), b.column("ids").to_pylist(), strict=True):
                ids = np.frombuffer(x, "<u2").astype(np.uint32) if len(x) % 2 == 0 else np.frombuffer(x, "<u4", offset=1)
                if keys and (p != part or total + len(ids) > block_ids):
                    yield close()
                    block_no, keys, arrays, total = block_no + 1, [], [], 0
                if p != part:
                    part, block_no = p, 0
                keys.append(key)
                arrays.append(ids)
                total += len(ids)
        if keys:
            yield close()

    encoded = mapped(docs.select("doc_id", "text"), encode, "part int, doc_id long, ids binary")
    ordered = encoded.repartitionById(2 * parts, F.col("part")).sortWithinPartitions("part", F.asc_nulls_last("doc_id"))
    mapped(ordered, block, "part int, block int, n_ids long, doc_ids array<long>, payload binary").write.parquet(path)


def read_ids(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (array of int) of every document in a file;
    with ``digest``, ids_crc32 over the ids as little-endian unsigned 32-bit integers instead of ids."""
    blocks = spark.read.parquet(path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, no, keys, payload in zip(*[b.column(c).to_pylist() for c in ("part", "block", "doc_ids", "payload")], strict=True):
                ids, sizes = unpack(payload)
                sizes = sizes.astype(np.int64)
                ends = np.cumsum(sizes)
                if digest:
                    raw = ids.astype("<u4").tobytes()
                    last = pa.array([zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)], pa.int64())
                else:
                    last = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(keys), pa.int32()), pa.array([no] * len(keys), pa.int32()), pa.array(keys, pa.int64()),
                     pa.array(ends - sizes), pa.array(sizes), last],
                    ["part", "block", "doc_id", "within", "n_tokens", "ids_crc32" if digest else "ids"])

    kind = "ids_crc32 long" if digest else "ids array<int>"
    rows = mapped(blocks.select("part", "block", "doc_ids", "payload"), decode,
                  f"part int, block int, doc_id long, within long, n_tokens long, {kind}")
    # ids before a block: those of earlier parts (one row per part) and of earlier blocks of its part
    sizes = blocks.select("part", "block", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).withColumn(
        "before", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    inside = F.sum("n_ids").over(W.partitionBy("part").orderBy("block").rowsBetween(W.unboundedPreceding, -1))
    base = sizes.withColumn("inside", F.coalesce(inside, F.lit(0))).join(parts.select("part", "before"), "part")
    return rows.join(base, ["part", "block"]).select(
        "doc_id", (F.col("before") + F.col("inside") + F.col("within")).alias("start"), "n_tokens", kind.split()[0])


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the ids of ``documents`` to files in the shared folder and reports what is read back from them."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/token-ids-{uuid.uuid4().hex}"
    write_ids(documents(spark, sf_dir), path, vocabulary_path())
    return read_ids(spark, path, digest=True)


QUERIES = {"op3_token_files": op3_token_files}
ORACLES = {}
