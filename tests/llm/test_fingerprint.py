"""op1 against a plain version of its contract."""

from __future__ import annotations

import hashlib

import numpy as np

from cartwheel.llm import fingerprint as fp
from tests.llm.conftest import AWKWARD, TINY


def plain_cuts(t: bytes) -> list[int]:
    """Byte by byte."""
    padded, cuts, at = b"\0" * 16 + t, [], 0
    for p in range(len(t)):
        h = sum(int(fp.GEAR[padded[p + 16 - k]]) << k for k in range(16)) & 0xFFFFFFFF
        n = p + 1 - at
        if n >= 16 and not h & (0xFE000000 if n <= 48 else 0xF0000000) or n == 256:
            cuts.append(p + 1)
            at = p + 1
    return cuts + [len(t)] * (at < len(t))


def test_chunks_against_byte_by_byte():
    rng = np.random.default_rng(0)
    texts = [b"", b"a", b"abcd" * 300, b"\0" * 700, *[bytes(rng.integers(0, 256, n).astype(np.uint8)) for n in (15, 16, 17, 400, 2000)]]
    assert fp.chunked(texts) == [plain_cuts(t) for t in texts]


def test_shift_resistance():
    rng = np.random.default_rng(1)
    text = bytes(rng.integers(97, 123, 20_000).astype(np.uint8))
    a, b = fp.fingerprints([text, text[:5000] + b"inserted" + text[5000:]])
    assert fp.containment(a, b) > 0.98
    assert np.array_equal(fp.parsed(fp.shown(a)), a)


def expected(rows):
    known = sorted(((i, t or "") for i, t in rows if i is not None), key=lambda r: (-r[0], r[1]))
    pairs = [(i, t, known[(k + 1) % len(known)][1]) for k, (i, t) in enumerate(known)]
    pairs += [(i, t or "", t or "") for i, t in rows if i is None]
    out = []
    for i, t, n in pairs:
        half = len(t) // 2
        edited = t[:len(t) - half] + n[:half]
        f, e, x = fp.fingerprints([t.encode(), edited.encode(), n.encode()])
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), fp.shown(f), fp.shown(e), fp.containment(f, e), fp.containment(f, x)))
    return out


def test_op1(spark, texts):
    rows = [tuple(r) for r in fp.op1_fingerprints(spark, TINY).collect()]
    assert sorted(rows) == sorted(expected(list(texts.items())))
    long = [r for r in rows if r[1] > 600]
    assert sum(r[5] > 0.3 for r in long) > 0.95 * len(long)


def test_op1_awkward(spark, awkward, nothing):
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, fp.compare_with_next(awkward).collect()), key=key) == sorted(expected(AWKWARD), key=key)
    assert fp.compare_with_next(nothing).count() == 0
    lone = awkward.where("doc_id = 7")
    assert [r.near_next for r in fp.compare_with_next(lone).collect()] == [1.0]
    got = fp.fingerprint_documents(awkward).collect()
    assert len(got) == len(AWKWARD) and {r.fingerprint for r in got if not r.text} == {""}
