"""Language identification with interpolated Kneser-Ney character models.

Every training document is counted: tasks count words per label, cut each distinct word (padded with blanks)
into 4-grams and Spark adds the counts up.  Lower orders need only the 4-gram types, because Kneser-Ney
uses continuation counts there.  The model is a sorted array of n-gram hashes per order with one
log-probability per language; what an n-gram's language has not seen is filled in by interpolation, so most
characters need one binary search for all languages together.

A text gets the language of lowest cross-entropy per character.  Rejection is calibrated on held-back rows:
each half of the training rows is scored by a model of the other half, and a high quantile of what its correctly
labelled documents need over their language's mean, by language and length, is the limit.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import mapped, materialize, slices, table

ORDER = 4
#: Size of the character set over which the lowest order is smoothed.
CHARACTERS = 5000
#: Distinct words whose scores a task keeps, and counts before they are cut into n-grams; scores kept, of all languages.
WORDS_KEPT, SCORES_KEPT = 400_000, 40_000_000
#: Rejection: the quantile of held-back excesses that is the limit, the rows that all languages and lengths together
#: count as beside a language's own rows of one length, and the length at which a text's own noise equals the documents' spread.
QUANTILE, PRIOR_ROWS, STEADY = 0.999, 1000, 200.0
#: Excesses are counted in steps of 1 / CELLS nats; lengths by their power of two.
CELLS, LENGTHS = 100, 40
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BLANKS = bytes(c if chr(c).isalpha() or c > 127 else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    """Lower-case runs of letters and non-ASCII characters, as UTF-8."""
    return text.lower().encode("utf-8", "replace").translate(_BLANKS).split()


def windows(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the n-gram that ends at each character of each word (and at the blank after it), and
    the index of its word."""
    pad = b" " * (ORDER - 1)
    s = np.frombuffer((pad + pad.join(words) + pad).decode().encode("utf-32-le"), dtype=np.uint32)
    ink = s != 32
    ends = np.flatnonzero(ink[1:] | ink[:-1]) + 1
    ends = ends[ends >= ORDER - 1]
    first = ink & ~np.concatenate(([False], ink[:-1]))
    return s[ends[:, None] + np.arange(1 - ORDER, 1)], np.cumsum(first)[ends] - 1


def hashed(grams: np.ndarray) -> np.ndarray:
    """64-bit hash of each row of code points."""
    h = np.full(len(grams), grams.shape[1], dtype=np.uint64)
    for k in range(grams.shape[1]):
        h = (h ^ grams[:, k].astype(np.uint64)) * _MIX
        h ^= h >> np.uint64(29)
    return h


def _grams_of(counts: Counter) -> Iterator[tuple[str, int]]:
    words = list(counts)
    grams, own = windows(words)
    weight = np.fromiter(counts.values(), dtype=np.int64, count=len(words))[own]
    h = hashed(grams)
    _, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    total = np.bincount(inverse, weights=weight).astype(np.int64)
    texts = np.ascontiguousarray(grams[first]).tobytes().decode("utf-32-le")
    return ((texts[i * ORDER:(i + 1) * ORDER], int(n)) for i, n in enumerate(total))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[tuple[str, int], Counter] = defaultdict(Counter)

    def flush():
        rows = [(lang, half, g, n) for (lang, half), c in seen.items() if c for g, n in _grams_of(c)]
        seen.clear()
        for i in range(0, len(rows), 50_000):
            lang, half, gram, n = zip(*rows[i:i + 50_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(half, pa.int32()), pa.array(gram), pa.array(n, pa.int64())],
                                             ["lang", "half", "gram", "n"])

    for b in slices(batches):
        for text, lang, half in zip(*(b.column(c).to_pylist() for c in ("text", "lang", "half")), strict=True):
            seen[lang, half].update(words_of(text))
        if sum(map(len, seen.values())) > WORDS_KEPT:
            yield from flush()
    yield from flush()


def half_of(doc_id: Column) -> Column:
    """0 or 1, the half of the training rows that a document is in."""
    return (F.floor(F.crc32(doc_id.cast("string")) / 4) % 2).cast("int")


def gram_counts(train: DataFrame) -> DataFrame:
    """lang, gram, n and n0, n1 (of each half) over all rows (doc_id, text, lang) with a text and a label."""
    rows = train.select("text", "lang", half_of(F.col("doc_id")).alias("half")).where("text is not null and lang is not null")
    part = lambda h: F.sum(F.when(F.col("half") == h, F.col("n")).otherwise(0))
    return (mapped(rows, _count, "lang string, half int, gram string, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n"), part(0).alias("n0"), part(1).alias("n1")))


class Model:
    """Per order: sorted n-gram hashes with log-probabilities (n-grams x languages), sorted context hashes
    with the logarithms of what their smoothing leaves to the order below."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        """``counts``: language → (code points of its n-grams, their counts)."""
        self.langs = sorted(counts)
        per = {lang: self._estimate(*counts[lang]) for lang in self.langs}
        n = len(self.langs)
        self.floor = np.array([per[x][0] for x in self.langs], dtype=np.float32)
        self.grams, self.contexts = [], []
        below: tuple[np.ndarray, np.ndarray] | None = None
        for k in range(1, ORDER + 1):
            rows = np.concatenate([per[x][k][0] for x in self.langs]) if n else np.zeros((0, k), np.uint32)
            keys, first = np.unique(hashed(rows), return_index=True)
            rows = rows[first]
            ctx = np.unique(np.concatenate([per[x][k][2] for x in self.langs])) if n else np.zeros(0, np.uint64)
            gamma = np.zeros((len(ctx), n), dtype=np.float32)
            value = np.zeros((len(keys), n), dtype=np.float32)
            own_ctx = hashed(rows[:, :-1])
            for j, lang in enumerate(self.langs):
                g, logp, c, logg = per[lang][k]
                gamma[np.searchsorted(ctx, c), j] = logg
                lower = self.floor[j] if below is None else below[1][np.searchsorted(below[0], hashed(rows[:, 1:])), j]
                at = np.searchsorted(ctx, own_ctx)
                value[:, j] = lower + gamma[at, j]
                value[np.searchsorted(keys, hashed(g)), j] = logp
            self.grams.append((keys, value))
            self.contexts.append((ctx, gamma))
            below = (keys, value)

    @staticmethod
    def _estimate(grams: np.ndarray, counts: np.ndarray) -> dict:
        levels, c = {ORDER: (grams, counts.astype(np.float64))}, None
        for k in range(ORDER - 1, 0, -1):  # continuation counts: types of the order above with this end
            rows = levels[k + 1][0][:, 1:]
            _, first, inverse = np.unique(hashed(rows), return_index=True, return_inverse=True)
            levels[k] = (rows[first], np.bincount(inverse).astype(np.float64))
        out: dict = {}
        below = None
        for k in range(1, ORDER + 1):
            rows, c = levels[k]
            ones, twos = (c == 1).sum(), (c == 2).sum()
            d = min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones else 0.5
            ctx, inverse = np.unique(hashed(rows[:, :-1]), return_inverse=True)
            total, types = np.bincount(inverse, weights=c), np.bincount(inverse)
            gamma = d * types / total
            if k == 1:
                out[0] = np.log(1 / CHARACTERS)
                lower = np.full(len(rows), 1 / CHARACTERS)
            else:
                lower = below[1][np.searchsorted(below[0], hashed(rows[:, 1:]))]
            p = np.maximum(c - d, 0) / total[inverse] + gamma[inverse] * lower
            out[k] = (rows, np.log(p), ctx, np.log(gamma))
            h = hashed(rows)
            order = np.argsort(h)
            below = (h[order], p[order])
        return out

    def score(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihood of each word in each language, and the number of characters behind it."""
        n = len(self.langs)
        grams, own = windows(words)
        out = np.zeros((len(grams), n), dtype=np.float32)
        left = np.arange(len(grams))
        for k in range(ORDER, 0, -1):
            rows = grams[left, ORDER - k:]
            keys, value = self.grams[k - 1]
            h = hashed(rows)
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            hit = keys[at] == h
            out[left[hit]] += value[at[hit]]
            left, rows = left[~hit], rows[~hit]
            if not len(left):
                break
            ctx, gamma = self.contexts[k - 1]
            h = hashed(rows[:, :-1])
            at = np.minimum(np.searchsorted(ctx, h), len(ctx) - 1)
            known = ctx[at] == h
            out[left[known]] += gamma[at[known]]
        out[left] += self.floor
        starts = np.searchsorted(own, np.arange(len(words)))
        return np.add.reduceat(out, starts, axis=0), np.diff(np.append(starts, len(own)))


def fit(train: DataFrame) -> tuple[Model | None, Model | None, Model | None]:
    """The model of all labelled rows of ``train`` (doc_id, text, lang), the one without half 0 and the one without
    half 1; None if their rows hold no letter.

    All labels and all n-grams count.  Driver and tasks hold the model: n-gram types times labels, which grows with
    what the languages write, not with the rows.
    """
    got = gram_counts(train).toArrow().sort_by([("lang", "ascending"), ("gram", "ascending")])  # the same order in every run
    out: tuple[dict, dict, dict] = ({}, {}, {})
    langs = got.column("lang").value_counts().to_pylist()
    ends = np.cumsum([x["counts"] for x in langs])
    for lang, end, size in ((x["values"], int(e), x["counts"]) for x, e in zip(langs, ends, strict=True)):
        mine = got.slice(end - size, size)
        cps = np.frombuffer("".join(mine.column("gram").to_pylist()).encode("utf-32-le"), dtype=np.uint32).reshape(-1, ORDER)
        for counts_of, column in zip(out, ("n", "n1", "n0"), strict=True):
            n = mine.column(column).to_numpy()
            if n.any():
                counts_of[lang] = (cps[n > 0], n[n > 0])
    whole, *parts = (Model(x) if x else None for x in out)
    return whole, *parts


def predict(docs: DataFrame, model: Model | None, keep_text: bool = False, prefix: str = "") -> DataFrame:
    """``docs`` (text and any other columns) without its text, plus lang_pred, score, entropy (nats per character),
    margin (to the second language) and n_letters (scored characters), their names after ``prefix``.

    A null text or one without a letter is 'und' with score 0, entropy null and 0 characters, as is
    everything if there is no model.  Equal scores go to the first language by name.
    """
    schema = docs.schema
    keys = [f for f in schema.fields if keep_text or f.name != "text"]
    added = [prefix + c for c in ("lang_pred", "score", "entropy", "margin", "n_letters")]
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        langs = m.langs if m else []
        index: dict[bytes, int] = {}
        kept = min(WORDS_KEPT, SCORES_KEPT // max(1, len(langs)))
        table = np.zeros((kept, max(1, len(langs))), dtype=np.float32)
        chars = np.zeros(kept, dtype=np.int64)
        for b in slices(batches):
            texts = [words_of(x or "") if m else [] for x in b.column("text").to_pylist()]
            sums, sizes = np.zeros((len(texts), max(1, len(langs)))), np.zeros(len(texts), dtype=np.int64)
            fresh = {w for t in texts for w in t if w not in index}
            if len(index) + len(fresh) > kept:
                index.clear()
                fresh = {w for t in texts for w in t}
            if len(index) + len(fresh) > len(table):  # one slice with more words than are kept
                table = np.zeros((len(fresh), table.shape[1]), dtype=np.float32)
                chars = np.zeros(len(fresh), dtype=np.int64)
            if fresh:
                own = [w for w in fresh if w.isalpha() or any(map(str.isalpha, w.decode()))]
                at = len(index)
                index.update((w, at + i) for i, w in enumerate(own))
                step = max(1, kept // 8)
                for i in range(0, len(own), step):
                    v, n = m.score(own[i:i + step])
                    table[at + i:at + i + len(v)], chars[at + i:at + i + len(v)] = v, n
                at = len(index)
                rest = [w for w in fresh if w not in index]
                index.update((w, at + i) for i, w in enumerate(rest))
                table[at:at + len(rest)], chars[at:at + len(rest)] = 0, 0
            at = np.fromiter((index[w] for t in texts for w in t), dtype=np.int64)
            counts = np.array([len(t) for t in texts])
            some = np.flatnonzero(counts)
            if len(some):
                starts = (np.cumsum(counts) - counts)[some]
                sums[some] = np.add.reduceat(table[at].astype(np.float64), starts, axis=0)
                sizes[some] = np.add.reduceat(chars[at], starts)
            found = sizes > 0
            ce = -sums / np.maximum(sizes, 1)[:, None]
            best = ce.argmin(axis=1)
            low = ce[np.arange(len(ce)), best]
            share = np.exp(-(ce - low[:, None]) * np.minimum(sizes, STEADY)[:, None]).sum(axis=1)
            other = np.where(np.arange(ce.shape[1])[None] == best[:, None], np.inf, ce).min(axis=1) - low
            yield pa.RecordBatch.from_arrays(
                [b.column(f.name) for f in keys]
                + [pa.array([langs[i] if ok else "und" for i, ok in zip(best, found, strict=True)], pa.string()),
                   pa.array(np.where(found, 1 / share, 0.0)),
                   pa.array(low, mask=~found), pa.array(np.where(np.isfinite(other), other, 0.0), mask=~found), pa.array(sizes)],
                [f.name for f in keys] + added)

    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in keys]
                    + [f"`{c}` {t}" for c, t in zip(added, ("string", "double", "double", "double", "long"), strict=True)])
    return mapped(docs, run, ddl)


def held_back(train: DataFrame, without: tuple[Model | None, Model | None]) -> DataFrame:
    """lang_pred, entropy and n_letters of the labelled rows of ``train`` (doc_id, text, lang) that the model without
    their half (``without[half]``) gives their label."""
    rows = train.select(F.col("lang").alias("label"), half_of(F.col("doc_id")).alias("half"), "text").where("text is not null and lang is not null")
    scored = [predict(rows.where(F.col("half") == h).drop("half"), m) for h, m in enumerate(without)]
    good = scored[0].unionByName(scored[1]).where("label = lang_pred and n_letters > 0")
    return good.select("lang_pred", "entropy", "n_letters")


def _quantile(own: np.ndarray, every: np.ndarray) -> int:
    """Index of the cell that holds the QUANTILE of the counts ``own`` and of ``every``, scaled to PRIOR_ROWS rows."""
    share = np.cumsum(own + every * (PRIOR_ROWS / every.sum()))
    return int(np.searchsorted(share, QUANTILE * share[-1] * (1 - 1e-12)))


def limits(back: DataFrame) -> tuple[DataFrame, float | None, float | None]:
    """__lang, __length (its power of two), __mean, __reach from ``held_back`` rows; mean and reach of all languages
    together, which hold for a label without such rows (None if there are no rows at all).

    The excess of a row is (entropy - mean) / sqrt(1 + STEADY / characters); the mean is its language's, with one row
    at the mean of all languages added.  The reach is a quantile of the excesses of the language's rows of this
    length, beside which all rows count as PRIOR_ROWS: the more own rows, the less these matter.
    """
    spark, back = back.sparkSession, materialize(back, "held-back")
    sums = back.groupBy("lang_pred").agg(F.sum("entropy").alias("s"), F.count("*").alias("n")).collect()  # a row per language
    schema = "__lang string, __length long, __mean double, __reach double"
    if not sums:
        return spark.createDataFrame([], schema), None, None
    over_all = sum(r.s for r in sums) / sum(r.n for r in sums)
    means = {r.lang_pred: round((r.s + over_all) / (r.n + 1), 6) for r in sums}
    excess = (F.col("entropy") - F.col("mean")) / F.sqrt(1 + STEADY / F.col("n_letters"))
    cell = F.ceil(F.greatest(F.least(excess, F.lit(20.0)), F.lit(-20.0)) * CELLS) + 20 * CELLS
    of = spark.createDataFrame(list(means.items()), "lang_pred string, mean double")
    counted = back.join(F.broadcast(of), "lang_pred").groupBy("lang_pred", length_of(F.col("n_letters")).alias("length"), cell.alias("cell")).agg(F.count("*").alias("n"))
    own: dict = defaultdict(lambda: np.zeros(40 * CELLS + 1))
    every = np.zeros(40 * CELLS + 1)
    for r in counted.collect():  # languages x lengths x cells at most
        own[r.lang_pred, r.length][r.cell] += r.n
        every[r.cell] += r.n
    none = np.zeros_like(every)
    reach = lambda lang, k: (_quantile(own.get((lang, k), none), every) - 20 * CELLS) / CELLS
    rows = [(x, k, means[x], reach(x, k)) for x in means for k in range(LENGTHS)]
    return spark.createDataFrame(rows, schema), over_all, reach(None, 0)


def length_of(characters: Column) -> Column:
    return F.least(F.floor(F.log2(characters)), F.lit(LENGTHS - 1)).cast("long")


def with_rejection(scored: DataFrame, calibration: tuple[DataFrame, float | None, float | None], prefix: str = "") -> DataFrame:
    """``scored`` plus rejected: no letter, or an entropy beyond the limit of the predicted language.

    The limit is mean + reach · sqrt(1 + STEADY / characters), with mean and reach of all languages for a label that
    has none.  Only where no label has a held-back row is nothing known to reject a text with letters by.
    """
    found, mean, reach = calibration
    n, entropy = F.col(f"{prefix}n_letters"), F.col(f"{prefix}entropy")
    joined = scored.join(found, (F.col(f"{prefix}lang_pred") == F.col("__lang")) & (length_of(n) == F.col("__length")), "left")  # few rows: AQE broadcasts by measured size
    limit = F.coalesce("__mean", F.lit(mean)) + F.coalesce("__reach", F.lit(reach)) * F.sqrt(1 + STEADY / n)
    return joined.withColumn(f"{prefix}rejected", F.when(n == 0, True).otherwise(F.coalesce(entropy > limit, F.lit(False)))).drop(*found.columns)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training; a null id isn't, but does not train either."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected and further figures for every row of ``docs`` (doc_id, text, lang).

    Repeated rows are counted and scored as often as they occur; an empty table gives an empty one.
    """
    model, found = _calibrated(docs)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return with_rejection(predict(rows, model), found)


def _calibrated(docs: DataFrame) -> tuple[Model | None, tuple[DataFrame, float | None, float | None]]:
    train = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    model, *without = fit(train)
    return model, limits(held_back(train, tuple(without)))


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, lang and any other columns) that are not rejected, each judged by its text.
    Column names that begin with two underscores are this operator's own."""
    model, found = _calibrated(docs.select("doc_id", "text", "lang"))
    judged = with_rejection(predict(docs, model, keep_text=True, prefix="__"), found, prefix="__")
    return judged.where(~F.col("__rejected")).select(*docs.columns)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return out.select("doc_id", "held_out", "lang_pred", "score", "rejected", "entropy", "margin", "n_letters")


QUERIES = {"op4_language": op4_language}
ORACLES = {}
