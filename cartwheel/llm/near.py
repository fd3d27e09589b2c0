"""Near-duplicate documents: consistent weighted sampling over TF-IDF shingles.

1. Tasks cut texts into 5-word shingles.  Distinct shingle hashes of a slice of documents go, with their
   counts, to the bucket of their leading bits, where document frequencies are counted over the whole table and sent back
   as one byte per shingle: a frequent shingle costs a row per slice, not per document.
2. A document whose weight lies to less than 0.8 in shingles of other texts cannot have a near-duplicate.
   The rest (texts once each) get improved consistent weighted samples, which are banded.
3. A band's bucket links its members to its most common one.  Links are verified by weighted Jaccard
   similarity.  Members that this leaves in different classes are then compared with each other as far as
   exact bounds on their weights, and the triangle inequality over the bucket's leader, allow a link: a bucket's
   members are cut into blocks, and one row per pair of blocks holds both blocks' vectors, so that only links are
   ever rows.
4. Classes are the connected components of verified links.

A shingle weighs (1 + ln tf) · idf.  Frequencies tf and df up to 128 count exactly, larger ones are rounded to one of 2.25 steps
an octave (within a sixth), so that each is one byte at any size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import discard, documents, files_for, mapped, materialize, partitions, release, slices
from cartwheel.llm.components import components

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 16, 4
#: idf runs from 1 (in every text) to 1 + IDF_SPAN (in one).  With a plain logarithm one edited word would outweigh ten
#: words of a frequent text, and copies in a large group would fall below the similarity their words have.
IDF_SPAN = 0.1
#: Frequencies up to EXACT have a code each; beyond, there are STEPS codes to an octave: 255 stands for 2^63.
EXACT, STEPS = 128, 2.25
_WORDS_KEPT = 300_000
#: Bytes of text whose shingles travel together.
SLICE = 1 << 20
#: Bytes of text per bucket of shingles.
BUCKET_BYTES = 16 << 20
#: Members, and bytes of vectors, of a block of a bucket.
BLOCK, BLOCK_BYTES = 256, 4 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
_ROW = ("pid int, slice long, kind int, bucket int, a binary, b binary, c binary, doc_ids array<long>, keys binary, sizes array<int>")


# ---- shingles and document frequencies ---------------------------------------------------------------------

class Shingler:
    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
        """Key of the text's words, its distinct shingle hashes (sorted) and how often each occurs."""
        words = text.split()
        key = xxhash.xxh3_128_digest(b" ".join(words))
        if not words:
            return key, np.zeros(0, np.uint64), np.zeros(0, np.int64)
        known = self.known
        if len(known) > _WORDS_KEPT:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
        n = max(1, len(h) - WORDS + 1)
        s = np.full(n, min(len(h), WORDS), dtype=np.uint64)
        for k in range(min(len(h), WORDS)):
            s = (s ^ h[k:k + n]) * _MIX
            s ^= s >> np.uint64(31)
        return key, *np.unique(s, return_counts=True)


def code_of(df: np.ndarray) -> np.ndarray:
    over = EXACT + np.round(STEPS * np.log2(np.maximum(df, EXACT) / EXACT))
    return np.where(df <= EXACT, df, np.minimum(over, 255)).astype(np.uint8)


def _decoded() -> np.ndarray:
    """The frequency that each code stands for."""
    codes = np.arange(256)
    return np.where(codes <= EXACT, np.maximum(codes, 1), EXACT * 2.0 ** ((codes - EXACT) / STEPS))


#: 1 + ln tf by code.
TF_WEIGHT = 1 + np.log(_decoded())


def idf_table(n: int) -> np.ndarray:
    df = _decoded()
    return 1 + IDF_SPAN * np.maximum(0, np.log(max(n, 2) / df)) / math.log(max(n, 2))


def _six(h: np.ndarray) -> bytes:
    """The six low bytes of each hash; the leading ones are known from the bucket."""
    return h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _frequencies(docs: DataFrame, bits: int) -> DataFrame:
    """Per slice of documents: its directory (kind 1) and, per bucket, codes of its distinct shingles (kind 0)."""
    buckets = 1 << bits
    shift = np.uint64(64 - bits)
    size = max(SLICE, buckets << 11)  # so that a slice's part for a bucket is not much smaller than a row's overhead

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, number = Shingler(), TaskContext.get().partitionId() << 32
        schema = pa.schema([("pid", pa.int32()), ("slice", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int32()), ("a", pa.binary()),
                            ("b", pa.binary()), ("c", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("keys", pa.binary()), ("sizes", pa.list_(pa.int32()))])
        for batch in slices(batches, most=size, rows=0xFFFF):  # a slice's frequencies fit 16 bits
            keys, sets, counts = zip(*[cut((t or "").encode("utf-8", "replace")) for t in batch.column("text").to_pylist()], strict=True)
            distinct, inverse, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
            edges = np.searchsorted(distinct >> shift, np.arange(buckets + 1, dtype=np.uint64)).tolist()
            rows = [(b, number, 0, b, _six(distinct[s:e]), times[s:e].astype("<u2").tobytes(), None, None, None, None)
                    for b, (s, e) in enumerate(zip(edges, edges[1:])) if e > s]
            # places of each document's shingles among the slice's: rising, so their differences are small
            steps = np.diff(inverse, prepend=0)
            ends = np.cumsum([len(s) for s in sets])
            starts = (ends - [len(s) for s in sets])
            starts = starts[starts < len(steps)]
            steps[starts] = inverse[starts]
            rows.append((number % buckets, number, 1, 0, (steps & 0xFFFF).astype("<u2").tobytes(), (steps >> 16).astype("<u2").tobytes(),
                         code_of(np.concatenate(counts)).tobytes(), batch.column("doc_id").to_pylist(),
                         b"".join(keys), [len(s) for s in sets]))
            for i in range(0, len(rows), 64):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[i:i + 64], strict=True), schema, strict=True)], schema=schema)
            number += 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, bytes, bytes]] = []
        for batch in batches:
            kind = np.asarray(batch.column("kind"))
            for i in np.flatnonzero(kind == 0).tolist():
                held.append(tuple(batch.column(c)[i].as_py() for c in ("slice", "bucket", "a", "b")))
            yield from (batch.slice(i, 1) for i in np.flatnonzero(kind == 1).tolist())
        for bucket in sorted({h[1] for h in held}):
            own = [h for h in held if h[1] == bucket]
            sizes = np.array([len(h[3]) // 2 for h in own])
            low = np.zeros((sizes.sum(), 8), dtype=np.uint8)
            low[:, :6] = np.frombuffer(b"".join(h[2] for h in own), np.uint8).reshape(-1, 6)
            times = np.frombuffer(b"".join(h[3] for h in own), "<u2")
            h = low.view("<u8").ravel()
            _, inverse = np.unique(h, return_inverse=True)
            df = np.bincount(inverse, weights=times)[inverse]
            codes, full = code_of(df), h | (np.uint64(bucket) << shift if bits <= 16 else np.uint64(0))
            ends = np.cumsum(sizes)
            for (number, *_), s, e in zip(own, (ends - sizes).tolist(), ends.tolist(), strict=True):
                shared = full[s:e][codes[s:e] > 1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([0], pa.int32()), pa.array([number]), pa.array([0], pa.int32()), pa.array([bucket], pa.int32()),
                     pa.array([codes[s:e].tobytes()]), pa.array([shared.astype("<u8").tobytes()]), pa.array([None], pa.binary()),
                     pa.array([None], pa.list_(pa.int64())), pa.array([None], pa.binary()), pa.array([None], pa.list_(pa.int32()))],
                    names=[f.split()[0] for f in _ROW.split(", ")])

    dealt = mapped(docs.select("doc_id", "text"), shingle, _ROW).repartitionById(buckets, F.col("pid"))
    return materialize(mapped(dealt, count, _ROW), "near-codes")


def _vectors(codes: DataFrame, n_docs: int, buckets: int) -> DataFrame:
    """doc_id, key of every document; where other texts' shingles may make up enough of it also its vector:
    hashes, codes and counts of the shared shingles and codes' share: counts of the others."""
    idf = idf_table(n_docs)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, shared = None, [], []
        for batch in batches:
            for r in batch.to_pylist():
                if r["slice"] != now:
                    now, parts, shared = r["slice"], [], []
                if r["kind"] == 0:
                    parts.append(np.frombuffer(r["a"], np.uint8))
                    shared.append(np.frombuffer(r["b"], "<u8"))
                    continue
                code = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
                hashes = np.zeros(len(code), np.uint64)
                hashes[code > 1] = np.concatenate(shared) if shared else np.zeros(0, np.uint64)
                steps = np.frombuffer(r["a"], "<u2").astype(np.int64) | (np.frombuffer(r["b"], "<u2").astype(np.int64) << 16)
                tf = np.frombuffer(r["c"], np.uint8)
                at, out = 0, []
                for i, (key, size) in enumerate(zip(r["doc_ids"], r["sizes"], strict=True)):
                    place = np.cumsum(steps[at:at + size])
                    c, t = code[place], tf[at:at + size]
                    at += size
                    w = TF_WEIGHT[t] * idf[c]
                    many = c > 1
                    vec = [None, None, None, None]
                    if size and w[many].sum() >= SIMILARITY * w.sum():
                        vec = [hashes[place[many]].tobytes(), c[many].tobytes(), t[many].tobytes(), t[~many].tobytes()]
                    out.append((key, r["keys"][16 * i:16 * i + 16], *vec))
                types = [pa.int64(), *[pa.binary()] * 5]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                                                 ["doc_id", "key", "hashes", "codes", "times", "alone"])

    slices_of = codes.withColumn("pid", F.pmod(F.xxhash64("slice"), F.lit(buckets)).cast("int")).repartitionById(buckets, F.col("pid"))
    ordered = slices_of.sortWithinPartitions("slice", "kind", "bucket")
    return materialize(mapped(ordered, assemble, "doc_id long, key binary, hashes binary, codes binary, times binary, alone binary"), "near-vectors")


# ---- consistent weighted sampling ---------------------------------------------------------------------------

def _gamma_quantiles() -> np.ndarray:
    """Quantiles of the Gamma(2, 1) distribution at 65536 even steps, by Newton's rule."""
    p = (np.arange(65536) + 0.5) / 65536
    x = np.sqrt(2 * p)
    for _ in range(60):
        x -= (1 - (1 + x) * np.exp(-x) - p) / np.maximum(x * np.exp(-x), 1e-300)
        x = np.maximum(x, 1e-9)
    return x


_GAMMA = _gamma_quantiles()
_LN_GAMMA = np.log(_GAMMA)


def samples(h: np.ndarray, w: np.ndarray, k: int) -> np.ndarray:
    """``k`` improved consistent weighted samples of the set of hashes ``h`` with weights ``w``, as 64-bit values:
    two sets agree in a sample with the probability of their weighted Jaccard similarity."""
    lw = np.log(w)
    out = np.empty(k, dtype=np.uint64)
    for i in range(k):
        z = (h ^ (np.uint64(i + 1) * np.uint64(0xD6E8FEB86659FD93))) * _MIX
        z ^= z >> np.uint64(32)
        z *= np.uint64(0xBF58476D1CE4E5B9)
        z ^= z >> np.uint64(29)
        r = _GAMMA[z & np.uint64(0xFFFF)]
        beta = (((z >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.float64) + 0.5) / 65536
        t = np.floor(lw / r + beta)
        a = _LN_GAMMA[(z >> np.uint64(32)) & np.uint64(0xFFFF)] - r * (t - beta + 1)
        best = int(a.argmin())
        out[i] = h[best] * _MIX + np.uint64(int(t[best]) & 0xFFFFFFFF)
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _MIX
    return x ^ (x >> np.uint64(29))


def _signatures(texts: DataFrame, n_docs: int, files: int | None = None) -> DataFrame:
    """key, first_id, weight, shared (the weight of shingles of other texts), hashes, weights and bands of every
    text that can have a near-duplicate."""
    idf = idf_table(n_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                h, c = np.frombuffer(r["hashes"], "<u8"), np.frombuffer(r["codes"], np.uint8)
                w = TF_WEIGHT[np.frombuffer(r["times"], np.uint8)] * idf[c]
                lone = TF_WEIGHT[np.frombuffer(r["alone"], np.uint8)] * idf[1]
                total = float(w.sum() + lone.sum())
                # a shingle of other texts occurs in more documents than this text has copies
                own = int(code_of(np.array([r["copies"]]))[0])
                others = (c > own) | ((c == own) & (r["copies"] > EXACT))
                shared = float(w[others].sum())
                if shared < SIMILARITY * total - 1e-9:
                    continue
                # shingles of one text agree with nothing: any hash of their own will do
                odd = _mixed(np.frombuffer(r["key"], "<u8")[0] + np.arange(1, len(lone) + 1, dtype=np.uint64) * _MIX)
                s = samples(np.concatenate([h, odd]), np.concatenate([w, lone]), BANDS * ROWS).reshape(BANDS, ROWS)
                band = np.arange(BANDS, dtype=np.uint64)
                for k in range(ROWS):
                    band = _mixed(band * _MIX + s[:, k])
                out.append((r["key"], r["first_id"], total, shared, h[others].tobytes(), w[others].astype("<f4").tobytes(), band.view(np.int64).tolist()))
            if out:
                types = [pa.binary(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                                                 ["key", "first_id", "weight", "shared", "hashes", "weights", "bands"])

    return materialize(mapped(texts, run, "key binary, first_id long, weight double, shared double, hashes binary, weights binary, bands array<long>"),
                       "near-signatures", files)


# ---- links ---------------------------------------------------------------------------------------------------

def _may_link(a: str, b: str):
    """The least common weight that the similarity asks of two weights, against what each shares with other texts."""
    need = SIMILARITY / (1 + SIMILARITY)
    return F.least(f"{a}.shared", f"{b}.shared") + 1e-6 >= need * (F.col(f"{a}.weight") + F.col(f"{b}.weight"))


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """``pairs`` (a, b) with their weighted Jaccard ``similarity``."""
    side = lambda k: texts.select(F.col("key").alias(k), F.col("weight").alias(f"w{k}"), F.col("hashes").alias(f"h{k}"), F.col("weights").alias(f"v{k}"))
    rows = pairs.select("a", "b").distinct().join(side("a"), "a").join(side("b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                _, i, j = np.intersect1d(np.frombuffer(r["ha"], "<u8"), np.frombuffer(r["hb"], "<u8"), assume_unique=True, return_indices=True)
                common = float(np.minimum(np.frombuffer(r["va"], "<f4")[i], np.frombuffer(r["vb"], "<f4")[j]).astype(np.float64).sum())
                out.append((r["a"], r["b"], common / (r["wa"] + r["wb"] - common)))
            a, b, s = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(s, pa.float64())], ["a", "b", "similarity"])

    return mapped(rows, run, "a binary, b binary, similarity double")


def links(texts: DataFrame, files: int | None = None) -> DataFrame:
    """a, b: verified links that connect every class of near-duplicate ``texts`` (output of ``_signatures``).  ``files``: see ``materialize``."""
    members = texts.select("key", "weight", "shared", "bands", F.posexplode("bands").alias("band", "hash"))
    lead = F.struct((F.col("shared") / F.col("weight")).alias("common"), "weight", "key", "shared")
    groups = members.groupBy("band", "hash").agg(F.count("*").alias("size"), F.max(lead).alias("lead"), F.min("weight").alias("least")).where("size > 1")
    near = materialize(members.join(groups, ["band", "hash"]), "near-members", files)
    stars = near.alias("m").withColumn("l", F.col("lead")).where((F.col("key") != F.col("l.key")) & _may_link("m", "l"))
    first = materialize(_verified(stars.select(F.col("l.key").alias("a"), F.col("key").alias("b")), texts), "near-links", files)
    slack = SIMILARITY - 1e-6  # weights are kept as 32-bit floats
    good = first.where(F.col("similarity") >= slack).select("a", "b")
    roots = materialize(components(good, files), "near-roots", files)
    # what the stars left apart: members that some bound still lets link to another class of their bucket
    need = (1 + SIMILARITY) / SIMILARITY
    alive = (F.col("weight") + F.col("least")) <= need * F.col("shared") + 1e-6
    known = near.where(alive).join(roots, F.col("key") == F.col("node"), "left").withColumn("root", F.coalesce("root", "key")).drop("node")
    to_lead = first.select(F.col("a").alias("lead_key"), F.col("b").alias("key"), "similarity")
    known = known.withColumn("lead_key", F.col("lead.key")).join(to_lead, ["lead_key", "key"], "left")
    known = known.withColumn("far", F.when(F.col("key") == F.col("lead_key"), 0.0).otherwise(1 - F.col("similarity")))
    split = known.groupBy("band", "hash").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).where("r1 <> r2").select("band", "hash")
    left = known.where(F.col("key") != F.col("lead_key")).join(split, ["band", "hash"]).select("band", "hash", "bands", "key", "weight", "shared", "root", "far")
    left = materialize(left.join(texts.select("key", "hashes", "weights"), "key"), "near-left", files)
    second = mapped(_block_pairs(left), _compared, "a binary, b binary, similarity double")
    return materialize(good.unionByName(second.where(F.col("similarity") >= slack).select("a", "b").distinct()), "near-all-links")


def _block_pairs(left: DataFrame) -> DataFrame:
    """Members of a bucket in blocks by hash of the key, and one row for each two blocks of a bucket (or one with
    itself): band, one (whether it is one block), x, y (the members)."""
    sizes = left.groupBy("band", "hash").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum(F.octet_length("hashes")) / BLOCK_BYTES)).alias("blocks"))
    member = F.struct("key", "weight", "shared", "root", "far", "bands", "hashes", "weights")
    blocks = left.join(sizes, ["band", "hash"]).withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")))
    blocks = materialize(blocks.groupBy("band", "hash", "block").agg(F.collect_list(member).alias("m")), "near-blocks")  # a block is bounded
    x, y = blocks.alias("x"), blocks.alias("y")
    met = x.join(y, (F.col("x.band") == F.col("y.band")) & (F.col("x.hash") == F.col("y.hash")) & (F.col("x.block") <= F.col("y.block")))
    return met.select(F.col("x.band").alias("band"), (F.col("x.block") == F.col("y.block")).alias("one"), F.col("x.m").alias("x"), F.col("y.m").alias("y"))


class _Block:
    def __init__(self, members: list[dict], roots: dict[bytes, int]):
        members = sorted(members, key=lambda m: m["key"])
        self.keys = [m["key"] for m in members]
        self.weight, self.shared, self.far = (np.array([m[c] if m[c] is not None else np.nan for m in members], dtype=np.float64) for c in ("weight", "shared", "far"))
        self.bands = np.array([m["bands"] for m in members], dtype=np.int64).reshape(len(members), BANDS)
        self.root = np.array([roots.setdefault(m["root"], len(roots)) for m in members])
        hashes = [np.frombuffer(m["hashes"], "<u8") for m in members]
        order = [np.argsort(h) for h in hashes]
        self.hashes = [h[o] for h, o in zip(hashes, order, strict=True)]
        self.weights = [np.frombuffer(m["weights"], "<f4")[o].astype(np.float64) for m, o in zip(members, order, strict=True)]


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between the members of two blocks, as far as bounds allow them and no earlier band compares them."""
    need = SIMILARITY / (1 + SIMILARITY)
    for batch in batches:
        for i in range(batch.num_rows):
            band, one, mx, my = (batch.column(c)[i].as_py() for c in ("band", "one", "x", "y"))
            roots: dict[bytes, int] = {}
            x = _Block(mx, roots)
            y = x if one else _Block(my, roots)
            may = x.root[:, None] != y.root[None]
            may &= np.minimum(x.shared[:, None], y.shared[None]) + 1e-6 >= need * (x.weight[:, None] + y.weight[None])
            may &= ~(np.abs(x.far[:, None] - y.far[None]) > 1 - SIMILARITY + 1e-6)  # an unknown distance allows all
            may &= ~(x.bands[:, None, :band] == y.bands[None, :, :band]).any(axis=2)
            if one:
                may = np.triu(may, 1)
            a, b, s = [], [], []
            for p in np.flatnonzero(may.any(axis=1)).tolist():
                others = np.flatnonzero(may[p]).tolist()
                hs, ws = np.concatenate([y.hashes[q] for q in others]), np.concatenate([y.weights[q] for q in others])
                own = x.hashes[p]
                at = np.minimum(np.searchsorted(own, hs), len(own) - 1)
                both = np.where(own[at] == hs, np.minimum(x.weights[p][at], ws), 0.0)
                sizes = np.array([len(y.hashes[q]) for q in others])
                common = np.add.reduceat(both, np.cumsum(sizes) - sizes)
                like = common / (x.weight[p] + y.weight[others] - common)
                for k in np.flatnonzero(like >= SIMILARITY - 1e-6).tolist():
                    a.append(x.keys[p])
                    b.append(y.keys[others[k]])
                    s.append(float(like[k]))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(s, pa.float64())], ["a", "b", "similarity"])


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, key, class_key, class_id, class_size, n_links for every row of ``docs`` (doc_id, text).

    ``key`` identifies a text's words, ``class_key`` a class; texts that differ in white space only are equal, as are null, empty
    and blank ones.  ``class_id`` is the least doc_id of the class (null if none of its rows has an id);
    ``n_links`` counts the verified links of the text to other texts.  A text of fewer than five words is one shingle.
    Repeated rows are in one class, an empty table gives an empty one.
    """
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    wanted = max(partitions(docs.sparkSession), size // BUCKET_BYTES)  # as the table grows, a bucket does not
    bits = min(16, max(4, (wanted - 1).bit_length()))
    files = files_for(docs.sparkSession, size)
    codes = _frequencies(docs, bits)
    release(docs.sparkSession)
    n_docs = codes.where("kind = 1").agg(F.sum(F.size("doc_ids")).alias("n")).first().n or 0
    rows = _vectors(codes, n_docs, 1 << bits)
    discard(codes)
    release(docs.sparkSession)
    ids = rows.groupBy("key").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id"))
    vector = F.struct("hashes", "codes", "times", "alone")
    texts = rows.where("hashes is not null").groupBy("key").agg(F.any_value(vector).alias("v"), F.count("*").alias("copies"), F.min("doc_id").alias("first_id"))
    texts = _signatures(texts.select("key", "copies", "first_id", "v.*"), n_docs, files)
    edges = links(texts, files)
    roots = materialize(components(edges, files), "near-classes", files)
    ends = edges.select(F.col("a").alias("key")).unionByName(edges.select(F.col("b").alias("key"))).groupBy("key").agg(F.count("*").alias("n_links"))
    ids = ids.join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    classes = ids.groupBy("root").agg(F.min("first_id").alias("class_id"), F.sum("copies").alias("class_size"))
    by_key = ids.join(classes, "root").join(ends, "key", "left").select(
        "key", "root", "class_id", "class_size", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    return rows.select("doc_id", "key").join(by_key, "key").select("doc_id", "key", F.col("root").alias("class_key"), "class_id", "class_size", "n_links")


def with_key(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__key``, the key of its text's words as in ``near_duplicates``."""
    fields = docs.schema.fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [xxhash.xxh3_128_digest(b" ".join((t or "").encode("utf-8", "replace").split())) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(keys, pa.binary())], [*[f.name for f in fields], "__key"])

    return mapped(docs, run, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["__key binary"]))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The row of ``docs`` (doc_id, text and any other columns) that stays of each class of near-duplicates: that of
    the least doc_id, a row without id only if none has one; of rows with equal id and words any one."""
    found = materialize(near_duplicates(docs.select("doc_id", "text")), "near-found")
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    stays = found.groupBy("class_key").agg(F.min(rank).alias("s")).select(F.col("s.doc_id").alias("__id"), F.col("s.key").alias("__stays"))
    keyed = with_key(docs)
    kept = keyed.join(stays, (F.col("__key") == F.col("__stays")) & F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")
    return kept.dropDuplicates(["__key", "doc_id"]).drop("__key")


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).select("doc_id", "class_id", "class_size", "n_links")


QUERIES = {"op8_near_duplicates": op8_near_duplicates}
ORACLES = {}
