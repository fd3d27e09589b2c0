"""BPE encoding and decoding over a trie of distinct words.

A sequence of tokens is the BPE encoding of its string exactly if each neighbouring pair is the encoding of
the pair's string.  So the encoding of a prefix is known from its *last* token alone: the one token t that
ends there and fits the last token of the shorter prefix that t leaves.  Distinct words go into a trie (as a
sorted list, in which neighbours share their common prefix); a depth-first walk keeps the last tokens of the
current path and computes those of each shared prefix once.  Tokens are looked up only at the lengths at which
one ends like the prefix.  A word's ids are read off backwards.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from cartwheel.llm.common import documents, mapped, slices, worker_cache
from cartwheel.llm.tokens import WordEncoder, byte_symbols, vocabulary_path

#: Pieces of words in each of the two generations that a Python worker keeps, and checked pairs of tokens.
PIECES_KEPT, PAIRS_KEPT = 250_000, 2_000_000
#: Last bytes of a prefix by which the lengths of its tokens are known, and such endings that are kept.
TAIL, TAILS_KEPT = 3, 500_000


class TrieBpe:
    """Encodes and decodes with the merges of a vocabulary file of word-end BPE over byte-level symbols."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.words = WordEncoder(path, PIECES_KEPT, self.merge)
        model = spec["model"]
        end = model.get("end_of_word_suffix") or ""

        def key(token: str) -> str:
            """A token as one character per byte; the closing byte of a word is moved up by 256."""
            body = token.removesuffix(end) if end else token
            body, whole = body.translate(_BYTE), body == token
            return body if whole else closed(body)

        self.id_of = {key(t): i for t, i in model["vocab"].items()}
        self.ending: dict[str, set[int]] = {}  # last bytes → lengths of the tokens that end so
        for token in self.id_of:
            self.ending.setdefault(token[-TAIL:], set()).add(len(token))
        self.tails: dict[str, list[int]] = {}
        self.shown = {i: t for t, i in model["vocab"].items()}
        self.shown |= {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.texts = pa.array([self.shown.get(i) for i in range(max(self.shown) + 1)], pa.large_string())
        self.bytes = [i.to_bytes(4, "little") for i in range(len(self.texts))]
        self.halves: dict[int, tuple[int, int]] = {}  # token → the two tokens it is merged from
        self.rank: dict[int, int] = {}  # pair → place of its merge
        self.result: dict[int, int] = {}
        vocab = model["vocab"]
        for place, (a, b) in enumerate(model["merges"]):
            pair, made = (vocab[a] << 32) | vocab[b], vocab[a + b]
            self.rank[pair], self.result[pair] = place, made
            self.halves[made] = (vocab[a], vocab[b])
        self.place = {made: self.rank[pair] for pair, made in self.result.items()}
        self.fits: dict[int, bool] = {}
        self.wholes: dict[int, bool] = {}

    def _merged(self, ids: list[int]) -> list[int]:
        """Plain BPE: the merge of lowest place first, the leftmost of equals."""
        while len(ids) > 1:
            best, at = min((self.rank.get((a << 32) | b, 1 << 30), i) for i, (a, b) in enumerate(zip(ids, ids[1:])))
            if best == 1 << 30:
                break
            ids = ids[:at] + [self.result[(ids[at] << 32) | ids[at + 1]]] + ids[at + 2:]
        return ids

    def _fit(self, a: int, b: int) -> bool:
        """Whether the tokens a, b stay apart: undo their merges from the last to the first and see whether a
        merge across the boundary would have come before one of them."""
        rank, place, halves = self.rank, self.place, self.halves
        left, right = a, b
        # a merge across the boundary happens once both its sides exist, if it comes before what built them further
        limit = 1 << 30
        while True:
            r = rank.get((left << 32) | right)
            if r is not None and r < limit:
                return False
            pl, pr = place.get(left, -1), place.get(right, -1)
            if pl < 0 and pr < 0:
                return True
            if pl > pr:
                limit, left = pl, halves[left][1]
            else:  # a merge of the same place further left comes first: at the boundary, before the right token's own
                limit, right = pr + 1, halves[right][0]

    def _lengths(self, tail: str) -> list[int]:
        """Lengths of the tokens that may end a prefix with the last bytes ``tail`` (all its bytes, if fewer than ``TAIL``), longest first."""
        found = {n for n in range(1, len(tail) + 1) if tail[-n:] in self.id_of}
        if len(tail) == TAIL:
            found |= self.ending.get(tail, set())
        if len(self.tails) > TAILS_KEPT:
            self.tails.clear()
        self.tails[tail] = sorted(found, reverse=True)
        return self.tails[tail]

    def _walk(self, words: list[str]) -> Iterator[bytes]:
        """The ids of each of the sorted ``words``, from the last tokens along their trie."""
        id_of, fits, tails, wholes, four = self.id_of, self.fits, self.tails, self.wholes, self.bytes
        last: list[tuple[int, int]] = []  # (token, its length) for each prefix on the path
        before = ""
        for word in words:
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del last[shared:]
            for d in range(shared + 1, len(word) + 1):
                tail = word[d - TAIL:d] if d > TAIL else word[:d]
                for n in tails.get(tail) or self._lengths(tail):
                    if n > d:
                        continue
                    t = id_of.get(word[d - n:d])
                    if t is None:
                        continue
                    if n == d:
                        if wholes.get(t) or self.whole(t):
                            last.append((t, n))
                            break
                        continue
                    pair = (last[d - n - 1][0] << 32) | t
                    ok = fits.get(pair)
                    if ok is None:
                        ok = fits[pair] = (wholes.get(t) or self.whole(t)) and self._fit(last[d - n - 1][0], t)
                    if ok:
                        last.append((t, n))
                        break
            ids, d = [], len(word)
            while d:
                t, n = last[d - 1]
                ids.append(four[t])
                d -= n
            ids.reverse()
            yield b"".join(ids)
            before = word

    def whole(self, t: int) -> bool:
        """Whether a token is what its own string is encoded to: its halves are, and they would be merged."""
        known = self.wholes.get(t)
        if known is None:
            known = t not in self.halves or (all(map(self.whole, self.halves[t])) and self._merged(self._symbols(t)) == [t])
            self.wholes[t] = known
        return known

    def _symbols(self, t: int) -> list[int]:
        return [t] if t not in self.halves else self._symbols(self.halves[t][0]) + self._symbols(self.halves[t][1])

    def merge(self, pieces: list[str], marked: bool) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct pieces, one after the other, and where they end, as ``WordEncoder`` asks for them."""
        if len(self.fits) > PAIRS_KEPT:
            self.fits.clear()
        if marked:
            keys = [closed(p.removeprefix("\0").translate(_BYTE)) for p in pieces]
        else:
            keys = [closed(p if p.isascii() else p.encode().decode("latin-1")) for p in pieces]
        words = sorted(keys)
        found = dict(zip(words, self._walk(words), strict=True))
        ids = [found[k] for k in keys]
        return np.frombuffer(b"".join(ids), "<u4"), np.cumsum([0, *map(len, ids)]) // 4

    def encode(self, texts: list[str | None]) -> Iterator[tuple[bytes, bytes]]:
        """For each text its ids (little-endian unsigned 32 bits) and what they decode to."""
        ids = self.words.encode(texts)
        ends = np.cumsum([0, *map(len, ids)]) // 4
        tokens = self.texts.take(pa.array(np.frombuffer(b"".join(ids), "<u4")))
        decoded = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), tokens), pa.scalar(" ", pa.large_string()))
        return zip(ids, decoded.cast(pa.large_binary()).to_pylist(), strict=True)

    def decode(self, ids: np.ndarray) -> str:
        """The tokens' texts with blanks between them, as the library decodes without a decoder."""
        return " ".join([self.shown[t] for t in ids.tolist()])


_BYTE = {ord(c): chr(b) for b, c in byte_symbols().items()}


def closed(piece: str) -> str:
    """A piece, given as one character per byte, with the last one moved up by 256."""
    return piece[:-1] + chr(ord(piece[-1]) + 256)


_coders: dict[str, TrieBpe] = worker_cache()


def coder(path: str) -> TrieBpe:
    """The worker's coder: what one task has learnt serves the next."""
    if path not in _coders:
        _coders[path] = TrieBpe(path)
    return _coders[path]


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32 bits) and decoded (string) for every row of ``docs``
    (doc_id, text).

    A null or empty text has no ids and decodes to ''.  Rows are encoded alone: repeated rows, null ids and
    ids in any order stay as they are; an empty table gives an empty one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path)
        for b in slices(batches):
            ids, texts = zip(*bpe.encode(b.column("text").to_pylist()), strict=True)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, pa.binary()), pa.array(texts, pa.binary()).cast(pa.string())],
                                             ["doc_id", "ids", "decoded"])

    return mapped(docs.select("doc_id", "text"), run, "doc_id long, ids binary, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """As ``encode_documents``, with lengths and digests instead of ids and texts, taken within the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path)
        for b in slices(batches):
            n, ids_sha, text_sha = [], [], []
            for ids, text in bpe.encode(b.column("text").to_pylist()):
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(text_sha)],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return mapped(docs.select("doc_id", "text"), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir), vocabulary_path())


QUERIES = {"op10_bpe": op10_bpe}
ORACLES = {}
