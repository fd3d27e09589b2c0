"""op10, op3 and op2 against the tokenizers library on whole texts."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cartwheel.llm import bpe_trie, packing, tokenfile
from cartwheel.llm.tokens import WordEncoder, vocabulary_path
from tests.llm.conftest import AWKWARD, TINY

LIBRARY = Tokenizer.from_file(vocabulary_path())
CODER, WORDS = bpe_trie.TrieBpe(vocabulary_path()), WordEncoder(vocabulary_path(), kept=50)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abcdeéßÀÞ 'sSTtmlvr.,!1İσΣ日<|>endoftxXE\u0301\xa0\x85\x1c\u3000😀", max_size=40), max_size=6))
def test_encoders_equal_the_library(texts):
    for t, (ids, text), words in zip(texts, CODER.encode(texts), WORDS.encode(texts), strict=True):
        want = ids_of(t)
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert np.frombuffer(words, "<u4").tolist() == want
        assert text.decode() == LIBRARY.decode(want, skip_special_tokens=False) == CODER.decode(np.array(want, dtype=int))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abcqlostr", min_size=1, max_size=60))
def test_trie_on_long_words(word):
    (ids, _), = CODER.encode([word])
    assert np.frombuffer(ids, "<u4").tolist() == ids_of(word)


def test_op10(spark, texts):
    got = {r.doc_id: r for r in bpe_trie.op10_bpe(spark, TINY).collect()}
    assert got.keys() == texts.keys()
    for k, t in texts.items():
        ids = ids_of(t)
        assert got[k].n_tokens == len(ids)
        assert got[k].ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert got[k].decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_op10_awkward(awkward, nothing):
    rows = bpe_trie.encode_documents(awkward, vocabulary_path()).collect()
    want = Counter((i, tuple(ids_of(t)), LIBRARY.decode(ids_of(t), skip_special_tokens=False)) for i, t in AWKWARD)
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist()), r.decoded) for r in rows) == want
    assert bpe_trie.digests(nothing, vocabulary_path()).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), min_size=1, max_size=40), min_size=1, max_size=8))
def test_block_round_trip(docs):
    ids = np.array([x for d in docs for x in d], dtype=np.uint32)
    back, sizes = tokenfile.unpack(tokenfile.pack(ids, np.array([len(d) for d in docs])))
    assert back.tolist() == ids.tolist() and sizes.tolist() == [len(d) for d in docs]


def test_ranks_of_every_width():
    ids = np.concatenate([np.arange(70_000, dtype=np.uint32), np.zeros(5, dtype=np.uint32)])
    payload = tokenfile.pack(ids, np.array([len(ids)]))
    assert tokenfile.unpack(payload)[0].tolist() == ids.tolist()
    with pytest.raises(ValueError):
        tokenfile.unpack(b"NOPE" + payload[4:])


def test_op3(spark, texts):
    got = sorted(tokenfile.op3_token_files(spark, TINY).collect())
    at = 0
    for r, k in zip(got, sorted(texts), strict=True):
        ids = [*ids_of(texts[k]), 2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (k, at, len(ids), crc(ids))
        at += len(ids)


def test_op3_awkward(spark, awkward, nothing, tmp_path):
    tokenfile.write_ids(awkward, f"{tmp_path}/a", vocabulary_path(), block_ids=1000)
    rows = sorted(tokenfile.read_ids(spark, f"{tmp_path}/a").collect(), key=lambda r: r.start)
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == Counter((i, (*ids_of(t), 2)) for i, t in AWKWARD)
    assert [r.start for r in rows] == np.cumsum([0, *[r.n_tokens for r in rows]])[:-1].tolist()
    known = [r.doc_id for r in rows if r.doc_id is not None]
    assert known == sorted(known) and all(r.doc_id is None for r in rows[len(known):])
    tokenfile.write_ids(nothing, f"{tmp_path}/b", vocabulary_path())
    assert tokenfile.read_ids(spark, f"{tmp_path}/b").count() == 0


def check_packing(rows, capacity):
    """Sequences are gapless from 0 and not too long; returns their number."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
    return len(by)


def test_op2(spark, texts):
    rows = packing.op2_packing(spark, TINY).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert by.keys() == texts.keys()
    total = 0
    for k, t in texts.items():
        ids = [*ids_of(t), 0]
        total += len(ids)
        for i, r in enumerate(sorted(by[k], key=lambda r: r.piece)):
            part = ids[2048 * i:2048 * (i + 1)]
            assert (r.piece, r.start, r.length, r.ids_crc32) == (i, 2048 * i, len(part), crc(part))
        assert sum(r.length for r in by[k]) == len(ids)
    assert check_packing(rows, 2048) <= 1.03 * total / 2048 + 1


def test_op2_awkward(awkward, nothing):
    rows = packing.pack_documents(awkward, vocabulary_path(), capacity=64).collect()
    want = Counter()
    for i, t in AWKWARD:
        n = len(ids_of(t)) + 1
        want.update((i, at, min(64, n - at)) for at in range(0, n, 64))
    assert Counter((r.doc_id, r.start, r.length) for r in rows) == want
    check_packing(rows, 64)
    assert packing.pack_documents(nothing, vocabulary_path()).count() == 0


def best_fit_decreasing(sizes, capacity):
    gaps = []
    for n in sorted(sizes, reverse=True):
        fit = [g for g in gaps if g >= n]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


@pytest.mark.parametrize("sizes", [[100] * 300, [40, 60] * 200 + [100] * 5, list(range(1, 101)) * 6, [51] * 50 + [49] * 50, [3] * 700])
def test_rounds_against_sequential_best_fit(spark, sizes):
    units = spark.createDataFrame(list(enumerate(sizes)), "unit long, length long")
    rows = packing.pack(units, 100).join(units, "unit").withColumnRenamed("sequence", "sequence_id").collect()
    assert sorted(r.unit for r in rows) == list(range(len(sizes)))
    assert check_packing(rows, 100) <= 1.03 * best_fit_decreasing(sizes, 100) + 1
