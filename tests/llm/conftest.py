"""Fixtures of the corpus operators' tests."""

from __future__ import annotations

import glob

import pytest

TINY = "/root/testdata/sf0.001"

AWKWARD = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "word"), (5, "word"), (None, "no id at all"), (None, None),
    (7, "x" * 5000), (8, "a b c d e f g h " * 900), (9, "Ünïcödé ß ﬁ İ ΣΑΣ 日本語 😀😀 é"), (9, "Ünïcödé ß ﬁ İ ΣΑΣ 日本語 😀😀 é"),
    (11, "<|endoftext|>a<|startoftext|> ' 's I'LL 12345"), (12, "...!!! ??? 123"), (13, "a\x1cb\x85c　d​e"),
]


@pytest.fixture
def awkward(spark):
    """Null, empty, very long and repeated rows, with columns whose names operators use themselves."""
    rows = [(i, t, "en" if t else None, None, 7, "x") for i, t in AWKWARD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_tokens long, part string")


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def texts():
    import pyarrow.parquet as pq

    t = pq.read_table(glob.glob(f"{TINY}/documents.parquet")[0], columns=["doc_id", "text"]).to_pylist()
    return {r["doc_id"]: r["text"] for r in t}
