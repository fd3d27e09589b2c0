"""op4: what is rejected, from languages and scripts that were not learned."""

from __future__ import annotations

import random
import zlib

import pytest
from pyspark.sql import functions as F

from cartwheel.llm import langid

MID = "/root/testdata/sf0.01"


@pytest.mark.parametrize("left_out", ["en", "fr"])
def test_left_out_language_is_rejected(spark, left_out):
    """At least 95 % of the documents of a language without labelled documents."""
    docs = spark.read.parquet(f"{MID}/documents.parquet").select("doc_id", "text", "lang")
    unlabelled = docs.withColumn("lang", F.when(F.col("lang") != left_out, F.col("lang")))
    rows = langid.identify(unlabelled).join(docs.select("doc_id", F.col("lang").alias("label")), "doc_id").collect()
    unknown = [r for r in rows if r.label == left_out]
    assert len(unknown) > 100 and sum(r.rejected for r in unknown) >= 0.95 * len(unknown)
    known = [r for r in rows if r.label and r.label != left_out]
    assert sum(r.rejected for r in known) <= 0.01 * len(known)


def test_random_syllables_are_rejected(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet").select("doc_id", "text", "lang")
    rng = random.Random(3)
    noise = [(10_000_000 + i, "".join(rng.choice("aeiou" if k % 2 else "bcdfghjklmnprstvz") for k in range(30)), None) for i in range(50)]
    rows = langid.identify(docs.unionByName(spark.createDataFrame(noise, docs.schema))).where("doc_id >= 10000000").collect()
    assert len(rows) == 50 and sum(r.rejected for r in rows) >= 48


@pytest.mark.parametrize("rare", [1, 8])
def test_rare_label_has_a_limit(spark, rare):
    """A label with few documents attracts foreign scripts, which are rejected all the same; its own documents stay."""
    docs = spark.read.parquet(f"{MID}/documents.parquet").select("doc_id", "text", "lang")
    rng = random.Random(5)
    words = ["".join(rng.choice("αβγδεζηθικλμνξοπρστυφχψω") for _ in range(rng.randrange(2, 8))) for _ in range(40)]
    own = [i for i in range(10_000_000, 10_000_100) if zlib.crc32(str(i).encode()) % 4 != 2][:rare]
    added = [(i, " ".join(rng.choice(words) for _ in range(120)), "xx") for i in own]
    added += [(20_000_000 + i, "".join(chr(0x4E00 + rng.randrange(20000)) for _ in range(800)), None) for i in range(20)]
    rows = langid.identify(docs.unionByName(spark.createDataFrame(added, docs.schema))).where("doc_id >= 10000000").collect()
    foreign = [r for r in rows if r.doc_id >= 20_000_000]
    assert {r.lang_pred for r in foreign} == {"xx"}
    assert len(foreign) == 20 and all(r.rejected for r in foreign)
    assert [r.doc_id for r in rows if r.doc_id < 20_000_000 and r.rejected] == []


def test_every_label_and_every_gram_counts(spark):
    """More than 100 labels, and a label with more than 300,000 4-grams that mostly occur once."""
    rng = random.Random(7)
    blocks = [[chr(0x4E00 + 20 * k + j) for j in range(20)] for k in range(130)]
    rows = [(k, " ".join("".join(rng.choice(b) for _ in range(3)) for _ in range(30)), f"l{k:03}") for k, b in enumerate(blocks)]
    model, *without = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.langs == [r[2] for r in rows] and sum(len(m.langs) for m in without) == 130
    got = langid.predict(spark.createDataFrame(rows, "doc_id long, text string, lang string"), model).collect()
    assert all(r.lang_pred == r.lang for r in got)
    large = ["".join(chr(0x4E00 + rng.randrange(20000)) for _ in range(100)) for _ in range(3200)]
    model, *_ = langid.fit(spark.createDataFrame([(i, t, "zh") for i, t in enumerate(large)], "doc_id long, text string, lang string"))
    types = {s[i:i + 4] for t in large for s in ["   " + t + " "] for i in range(len(s) - 3)}
    assert len(types) > 300_000 and len(model.grams[3][0]) == len(types)
