"""Runs of repeated words: maximal stretches of a text that repeat a period three times or more.

A run with period q covers three neighbouring multiples of q (more where the least length asks for it), and all
words between the first two equal those a period later.  So the candidates of a period are grid places whose words
agree that far; there are n/1 + n/2 + ... grid places in all.  Longest common extensions on the texts'
recompression grammar (``recompress``), forwards and on the grammar read backwards, give each candidate's exact
stretch, whatever its length.  Of periods with one stretch the smallest is the run's.

Texts are worked on where they are read, several megabytes at a time and one grammar for those of a batch that
have candidates; nothing is shuffled.  Memory follows a batch, or the longest text where that is larger.

Words are the stretches without ASCII white space.  Null and empty texts have no words and no runs.  Rows are
independent: repeated rows, null ids and columns of any name make no difference, and an empty table gives an
empty one.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import mapped, slices, table
from cartwheel.llm.recompress import Grammar

LEAST_WORDS, LEAST_PERIODS = 24, 3
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUN = "struct<start:long,length:long,period:long>"


def _chains(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each stretch of consecutive numbers."""
    breaks = np.flatnonzero(np.diff(places) != 1)
    return places[np.append(0, breaks + 1)], places[np.append(breaks, len(places) - 1)]


def candidates(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chains (period, first place, last place) of grid places that may lie in a run.

    ``words``: the texts one after the other, the longest first, each followed by a word of its own; ``sizes``:
    their numbers of words."""
    out = []
    ends = np.cumsum(sizes + 1)
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes + 1)  # a run has one
    longest = int(sizes[0]) if len(sizes) else 0
    for q in range(1, longest // LEAST_PERIODS + 1):
        least = max(LEAST_WORDS, LEAST_PERIODS * q)
        if least > longest:
            continue
        line = words[:ends[np.searchsorted(-sizes, -least, side="right") - 1]]
        grid = line[::q]
        alike = grid[:-1] == grid[1:]
        need = least // q - 1  # so many steps of the grid lie within any stretch of ``least``
        if need == 2:
            found = np.flatnonzero(alike[:-1] & alike[1:])
            found = found[owner[found * q] == owner[(found + 2) * q]]
            for ahead in {1, q // 3, q // 2, q - 1}:
                if not len(found):
                    break
                at = found * q + ahead
                found = found[line[at] == line[at + q]]
            if len(found):
                first, last = _chains(found)
                out.append((np.full(len(first), q), first * q, last * q))
        else:
            found = np.flatnonzero(alike)
            found = found[owner[found * q] == owner[(found + 1) * q]]
            if len(found):
                first, last = _chains(found)
                long = last - first + 1 >= need
                if long.any():
                    out.append((np.full(int(long.sum()), q), first[long] * q, last[long] * q))
    if not out:
        return (np.zeros(0, dtype=np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _stretches(forwards: Grammar, backwards: Grammar, n: int, q: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the stretch with period ``q`` around the places ``at`` and ``at + q`` begins and ends."""
    end = at + q + forwards.extensions(at, at + q)
    # place x is n - 1 - x when read backwards; the words before both places are compared
    return at - backwards.extensions(n - at, n - at - q), end


def find_runs(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of each text (an array of word numbers, not negative), in order."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    order = sorted((i for i in range(len(texts)) if len(texts[i]) >= LEAST_WORDS), key=lambda i: -len(texts[i]))
    if not order:
        return out
    lone = int(max(texts[i].max() for i in order)) + 1  # from here on words that occur once
    parts = [x for k, i in enumerate(order) for x in (texts[i], [lone + k])]
    sizes = np.array([len(texts[i]) for i in order])
    q, first, last = candidates(np.concatenate(parts).astype(np.int32), sizes)
    if not len(q):
        return out
    starts = np.append(0, np.cumsum(sizes + 1))
    text = np.searchsorted(starts, first, side="right") - 1
    used, which = np.unique(text, return_inverse=True)
    line = np.concatenate([[lone + len(order)], *[np.append(texts[order[k]], lone + k) for k in used]])
    begins = 1 + np.append(0, np.cumsum(sizes[used] + 1))
    shift = begins[which] - starts[text]
    first, last = first + shift, last + shift
    forwards = Grammar(line)
    backwards = forwards.reversed()
    start, end = _stretches(forwards, backwards, len(line), q, first)
    found = [(start, end, q)]
    # the rest of a chain, where its first stretch ends before it does
    beyond = np.maximum(first + q, first + -(-(end - q - first) // q) * q)
    left = np.where(beyond <= last, (last - beyond) // q + 1, 0)
    if left.any():
        periods = np.repeat(q, left)
        nth = np.arange(left.sum()) - np.repeat(np.cumsum(left) - left, left)
        found.append((*_stretches(forwards, backwards, len(line), periods, np.repeat(beyond, left) + nth * periods), periods))
    start, end, q = (np.concatenate(x) for x in zip(*found, strict=True))
    long = end - start >= np.maximum(LEAST_WORDS, LEAST_PERIODS * q)
    start, end, q = start[long], end[long], q[long]
    sort = np.lexsort((q, end, start))
    start, end, q = start[sort], end[sort], q[sort]
    least = np.append(True, (np.diff(start) != 0) | (np.diff(end) != 0))[:len(start)]
    start, end, q = start[least], end[least], q[least]
    sort = np.lexsort((q, start))
    where = np.searchsorted(begins, start, side="right") - 1
    for k in sort.tolist():
        out[order[used[where[k]]]].append((int(start[k] - begins[where[k]]), int(end[k] - start[k]), int(q[k])))
    return out


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the most periods; of equals the first, then the one with the smaller period."""
    best = None
    for run in runs:  # by start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def repeated(runs: list[tuple[int, int, int]], n: int) -> np.ndarray:
    """Which of ``n`` words lie in a run after its first period."""
    edge = np.zeros(n + 1, dtype=np.int64)
    for start, length, q in runs:
        edge[start + q] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:n]) > 0


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words, and the numbers of words per text."""
    lists = pc.ascii_split_whitespace(texts)
    words = lists.flatten()
    real = pc.greater(pc.binary_length(words), 0)
    sizes = np.bincount(np.asarray(pc.list_parent_indices(lists).filter(real)), minlength=len(texts))
    return words.filter(real), sizes


def _worked(batches: Iterator[pa.RecordBatch], edit: Callable | None) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text"):
        keys = b.column("key")
        words, sizes = _split(pc.fill_null(b.column("text"), ""))
        starts = np.append(0, np.cumsum(sizes))
        if edit:
            source = np.arange(len(words))
            for key, s, n in zip(keys.to_pylist(), starts.tolist(), sizes.tolist(), strict=False):
                if n and (change := edit(key, n)):
                    a, p = change
                    source[s + a:s + n] = s + a + np.arange(n - a) % p
            words = words.take(pa.array(source))
        numbers = np.asarray(words.dictionary_encode().indices).astype(np.int64)
        runs = find_runs([numbers[s:e] for s, e in zip(starts[:-1], starts[1:], strict=True)])
        keep = np.ones(len(words), dtype=bool)
        for r, s, n in zip(runs, starts.tolist(), sizes.tolist(), strict=False):
            if r:
                keep[s:s + n] = ~repeated(r, n)
        kept = np.append(0, np.cumsum(keep))[starts].astype(np.int32)
        collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(kept), words.filter(pa.array(keep))), " ")
        as_struct = lambda r: dict(zip(("start", "length", "period"), r, strict=True))
        yield pa.RecordBatch.from_arrays([
            keys, pa.array(sizes, pa.int64()), pa.array([[as_struct(x) for x in r] for r in runs], pa.list_(_RUN)),
            pa.array([as_struct(x) if (x := strongest(r)) else None for r in runs], _RUN), collapsed.cast(pa.string())],
            ["key", "n_words", "runs", "strongest", "collapsed"])


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", edit: Callable[[int | None, int], tuple[int, int] | None] | None = None) -> DataFrame:
    """Per row of ``docs``: its id, n_words, runs (by start, then period), strongest (the run with the most periods, or
    null) and collapsed (the text's words without the repetitions, one space between).

    ``edit(id, n)`` may give (a, p): the words from place a on are replaced by the first p of them over and over."""
    found = mapped(docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")),
                   lambda batches: _worked(batches, edit), f"key {docs.schema[key].dataType.simpleString()}, n_words long, runs array<{RUN}>, strongest {RUN}, collapsed string")
    return found.withColumnRenamed("key", key)


def planted(key: int | None, n: int) -> tuple[int, int] | None:
    """The edit of a tenth of all ids; rows without an id stay as they are."""
    h = zlib.crc32(str(key).encode())
    if key is None or h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(table(spark, sf_dir, "documents"), edit=planted)
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "strongest.start", "strongest.length", "strongest.period",
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {"op11_periodic_runs": op11_periodic_runs}
ORACLES = {}
