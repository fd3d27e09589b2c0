"""op13 against a plain grouping, with collisions forced by a weak hash."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cartwheel.llm import exact
from tests.llm.conftest import AWKWARD, TINY


def plain(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    out = []
    for form, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        first = True
        for i in ids:
            stays = i == keep and first
            first = first and not stays
            out.append((i, keep, len(ids), stays, hashlib.sha256(form.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


def test_op13(spark, texts):
    assert found(exact.op13_exact_duplicates(spark, TINY)) == plain(texts.items())


def test_op13_awkward(spark, awkward, nothing):
    assert found(exact.exact_duplicates(awkward)) == plain(AWKWARD)
    assert found(exact.exact_duplicates(nothing)) == []
    kept = exact.one_of_each(awkward)
    assert kept.columns == awkward.columns
    assert kept.count() == sum(r[3] for r in plain(AWKWARD))


@pytest.mark.parametrize("digits", [0, 1])
def test_colliding_hashes_are_told_apart_by_bytes(spark, digits):
    rows = [(i, f"text {i % 7}  of\tseven" if i % 3 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    weak = lambda t: F.unhex(F.concat(F.lit("0"), F.substring(F.md5(t), 1, digits)))
    assert found(exact.exact_duplicates(df, digest=weak)) == plain(rows)


def test_hot_and_long_texts(spark):
    long = "passage " * 60_000
    rows = [(i, "the same text" if i % 2 else f"own {i}") for i in range(6000)] + [(9000, long), (8000, long.replace(" ", "\n\n"))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert found(exact.exact_duplicates(df)) == plain(rows)


def test_other_names(spark):
    df = spark.createDataFrame([(2, "a b", 1, 5), (1, "a  b", 2, 6)], "id long, body string, __hash int, kept int")
    got = exact.exact_duplicates(df, "id", "body")
    assert sorted(tuple(r)[:4] for r in got.collect()) == [(1, 1, 2, True), (2, 1, 2, False)]
    assert exact.one_of_each(df, "id", "body").collect()[0].asDict() == {"id": 1, "body": "a  b", "__hash": 2, "kept": 6}
