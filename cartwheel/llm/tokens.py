"""Word-wise use of a public tokenizer whose words end at white space.

The vocabulary file ``word_bpe_49k.json`` drops white space before it merges, and its patterns never look
across it.  A text's ids are therefore the ids of its white-space-separated words, one after the other;
each distinct word is encoded by the tokenizers library once and kept.  Splitting is done at ASCII white
space only (all of which the tokenizer drops), so unusual characters stay inside a word and are the
library's business.  Texts within Latin-1 are put to lower case first, as the tokenizer does character by
character, so that fewer words are distinct.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

from cartwheel.llm.common import worker_cache

VOCABULARY = "word_bpe_49k.json"
#: Distinct pieces of words in each of the two generations that a Python worker keeps (some 200 bytes each), and those of one batch.
WORDS_KEPT = 200_000
_CHUNK = 20_000


def vocabulary_path() -> str:
    return public_tokenizers.path(VOCABULARY)


def split_words(text: str | None) -> list[bytes]:
    """The text's words as UTF-8, in lower case where that is safe before special tokens are looked for."""
    if not text:
        return []
    if "<|" not in text and (text.isascii() or not _BEYOND.search(text)):
        text = text.lower()
    return text.encode("utf-8", "replace").split()


_BEYOND = re.compile("[^\0-\xff]")


class Pieces:
    """Cuts words as a vocabulary file's normaliser and pre-tokenizer do, into pieces of the byte-level
    alphabet, with the ids of special tokens in their places."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = self.library.normalizer, self.library.pre_tokenizer
        self.added = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self._special = regex.compile("|".join(map(regex.escape, self.added)) or r"(?!)")

    def cut(self, word: str) -> list[str | int]:
        """By the library, around special tokens."""
        out: list[str | int] = []
        at = 0
        for m in [*self._special.finditer(word), None]:
            part = word[at:m.start() if m else None]
            if part:
                part = self.normalizer.normalize_str(part)
                out += [p for p, _ in self.pre_tokenizer.pre_tokenize_str(part)]
            if m:
                out.append(self.added[m.group()])
                at = m.end()
        return out

    def __call__(self, word: str) -> list[str | int]:
        """The same; words of printable Latin-1 without special tokens need only the file's split pattern."""
        if "<|" not in word:
            if word.isascii():
                if word.isprintable():
                    return _ASCII.findall(word.lower())
            elif _SIMPLE.fullmatch(word):
                return [p if p.isascii() else p.encode().decode("latin-1").translate(_SHOWN) for p in _SPLIT.findall(word.lower())]
        return self.cut(word)


_SIMPLE = re.compile(r"[!-~\xa1-\xff]+")
#: The file's split pattern, and what is left of it in ASCII.
_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")


def byte_symbols() -> dict[int, str]:
    """Byte-level alphabet: printable bytes stand for themselves, the others follow from code point 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


_SHOWN = byte_symbols()
_SHOWN_LINES = {b: c for b, c in _SHOWN.items() if b != 10}


def _latin_class(kind: str) -> str:
    """The Latin-1 characters of a Unicode category (L or N), lower case only, as they stand in a character class."""
    return "".join(c for c in map(chr, range(0x100)) if unicodedata.category(c)[0] == kind and c == c.lower())


_LETTER, _NUMBER = _latin_class("L"), _latin_class("N")
#: The file's split pattern for words of printable lower-case Latin-1, one word a line; line ends come along.
_LINES = re.compile(rf"\n|'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\n{_LETTER}{_NUMBER}]+")
#: White space that is dropped, and printable Latin-1.
_PLAIN = bytes([*range(9, 14), *range(32, 127), *range(161, 256)])
_LINE_END = 0xFFFFFFFF
#: Distinct words of plain texts and distinct pieces of them that a Python worker keeps with their ids (some 40 bytes each), and
#: those of one batch.
WORDS_STORED, PIECES_STORED = 400_000, 500_000


def _is_plain(text: str) -> bool:
    """Whether the text may be put to lower case and cut by ``_LINES``."""
    try:
        return not text.encode("latin-1").translate(None, _PLAIN) and "<|" not in text
    except UnicodeEncodeError:
        return False


def _lines(strings: pa.Array) -> str:
    """All strings, one a line; quicker than a list of them."""
    all_of_them = pa.LargeListArray.from_arrays(pa.array([0, len(strings)], pa.int64()), strings.cast(pa.large_string()))
    return pc.binary_join(all_of_them, pa.scalar("\n", pa.large_string()))[0].as_py()


class _Stored:
    """Distinct strings, each with some ids, in arrays: those of string i are in ``flat`` from ``ends[i]`` to the next."""

    def __init__(self, first: str | None = None, ids: Iterable[int] = ()):
        self.strings = pa.array([] if first is None else [first], pa.string())
        self.flat = np.array(ids, "<u4")
        self.ends = np.array([0] if first is None else [0, len(self.flat)], np.int64)

    def __len__(self) -> int:
        return len(self.strings)

    def places(self, strings: pa.Array, learn: Callable[[pa.Array], None]) -> np.ndarray:
        """The numbers of distinct strings; ``learn`` is to add those that are new."""
        at = pc.index_in(strings, value_set=self.strings)
        fresh = strings.filter(at.is_null())
        at = pc.fill_null(at, -1).to_numpy().astype(np.int64)
        if len(fresh):
            at[at < 0] = len(self) + np.arange(len(fresh))
            learn(fresh)
        return at

    def add(self, fresh: pa.Array, flat: np.ndarray, ends: np.ndarray) -> None:
        """Strings that are new, their ids one after the other, and where they end, from 0."""
        self.strings = pa.concat_arrays([self.strings, fresh])
        self.flat = np.concatenate([self.flat, flat])
        self.ends = np.concatenate([self.ends, self.ends[-1] + ends[1:]])

    def copied(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the strings at ``places``, one after the other, and where they end, from 0."""
        found = pa.LargeListArray.from_arrays(pa.array(self.ends), pa.array(self.flat)).take(pa.array(places))
        ends = np.asarray(found.offsets)
        return np.asarray(found.values)[ends[0]:ends[-1]], ends - ends[0]


class WordEncoder:
    """Whole texts to ids (as little-endian unsigned 32-bit bytes).

    The distinct words of all plain texts of a call that are not known yet are cut into pieces by one pattern, other texts
    word by word; each distinct piece is merged once, by the library or by ``merge`` (which gets what ``_by_library`` would),
    and the ids of words are copied to the places where they occur.  Words of plain texts and their pieces are kept in
    arrays, all forgotten when these are full.  Of the others' pieces two generations are kept: when the younger one is
    full the older one is forgotten, but for what has been used since.
    """

    def __init__(self, path: str, kept: int = WORDS_KEPT, merge: Callable[[list[str], bool], tuple[np.ndarray, np.ndarray]] | None = None):
        self.pieces = Pieces(path)
        self.merge = merge or self._by_library
        self.model = self.pieces.library  # merges only: what it gets is cut already
        self.model.no_truncation()
        self.model.no_padding()
        self.model.normalizer = None
        self.model.pre_tokenizer = None
        vocabulary, end = self.model.get_vocab(), self.model.model.end_of_word_suffix
        self.closing = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.closing[[i for t, i in vocabulary.items() if end and t.endswith(end)]] = True
        self.kept = kept
        self.known: dict[str | int, bytes] = {}
        self.older: dict[str | int, bytes] = {}
        self.words, self.stems = _Stored(), _Stored("\n", [_LINE_END])

    def _learn(self, pieces: list[str | int], marked: bool) -> None:
        """Make all pieces known; those that are not ``marked`` are distinct and new.  They are Latin-1 text; in ``marked`` ones
        those after a NUL are in the byte-level alphabet, and numbers are ids."""
        if not marked:
            self.stems.add(pa.array(pieces, pa.string()), *self.merge(pieces, False))
            return
        if len(self.known) > self.kept:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        fresh = set(pieces).difference(known)
        again = {p for p in fresh if p in older}
        known.update((p, older[p]) for p in again)
        fresh -= again
        known.update((p, p.to_bytes(4, "little")) for p in fresh if isinstance(p, int))
        new = [p for p in fresh if not isinstance(p, int)]
        flat, ends = self.merge(new, True)
        data, at = flat.tobytes(), (4 * ends).tolist()
        known.update((p, data[s:e]) for p, s, e in zip(new, at, at[1:], strict=False))

    def _by_library(self, pieces: list[str], marked: bool) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, and where each piece's begin and the last one's end; pieces are as in ``_learn``."""
        ids, ends, total = [np.zeros(0, "<u4")], [np.zeros(1, np.int64)], 0
        for i in range(0, len(pieces), _CHUNK):
            part = pieces[i:i + _CHUNK]
            if marked:
                shown = [p[1:] if p[0] == "\0" else p for p in part]
            else:
                shown = "\n".join(part).encode().decode("latin-1").translate(_SHOWN_LINES).split("\n")
            found, stops = self._merged(shown)
            ids.append(found)
            ends.append(total + stops)
            total += len(found)
        return np.concatenate(ids), np.concatenate(ends)

    def _merged(self, shown: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The library's ids of pieces in the byte-level alphabet, and where each one's end: at tokens that close a word, if the file has such."""
        ids = np.array(self.model.encode_batch_fast([shown], is_pretokenized=True, add_special_tokens=False)[0].ids, dtype="<u4")
        stops = np.flatnonzero(self.closing[ids]) + 1
        if len(stops) != len(shown):
            got = self.model.encode(shown, is_pretokenized=True, add_special_tokens=False)
            ids = np.array(got.ids, dtype="<u4")
            stops = np.searchsorted(np.array(got.word_ids, dtype=np.int64), np.arange(1, len(shown) + 1))
        return ids, stops

    def _ids(self, pieces: list[str | int], marked: bool) -> np.ndarray:
        """The ids of all pieces, one after the other; pieces are as in ``_learn``, but line ends among those that are not
        ``marked`` become ``_LINE_END``."""
        if marked:
            self._learn(pieces, True)
            return np.frombuffer(b"".join(map(self.known.__getitem__, pieces)), "<u4")
        coded = pa.array(pieces, pa.string()).dictionary_encode()
        if len(self.stems) > PIECES_STORED:
            self.stems = _Stored("\n", [_LINE_END])
        at = self.stems.places(coded.dictionary, lambda fresh: self._learn(_lines(fresh).split("\n"), False))
        return self.stems.copied(at[np.asarray(coded.indices)])[0]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out, plain = [b""] * len(texts), []
        for i, t in enumerate(texts):
            if t and _is_plain(t):
                plain.append(i)
            elif t:
                cut = (p for w in split_words(t) for p in self.pieces(w.decode()))
                out[i] = self._ids([p if isinstance(p, int) or p.isascii() and p[0] != "\0" else "\0" + p for p in cut], True).tobytes()
        if plain:
            found, ends = self._plain([texts[i].lower() for i in plain])
            for i, s, e in zip(plain, ends, ends[1:], strict=False):
                out[i] = found[s:e].tobytes()
        return out

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, list[int]]:
        """All ids of the texts, and where each text's begin."""
        lists = pc.ascii_split_whitespace(pa.array(texts, pa.string()))
        coded = lists.flatten().dictionary_encode()
        if len(self.words) > WORDS_STORED:
            self.words = _Stored()
        at = self.words.places(coded.dictionary, lambda fresh: self.words.add(fresh, *self._cut(fresh)))
        found, ends = self.words.copied(at[np.asarray(coded.indices)])
        return found, ends[np.asarray(lists.offsets)].tolist()

    def _cut(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, and where they end."""
        flat = self._ids(_LINES.findall(_lines(words)), False)
        line_ends = flat == _LINE_END
        stops = np.append(np.flatnonzero(line_ends), len(flat)) - np.arange(len(words))  # less the line ends before
        return flat[~line_ends], np.append(0, stops)


_encoders: dict[str, WordEncoder] = worker_cache()


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a vocabulary file: words learnt in one task serve the next."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
