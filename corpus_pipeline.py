"""Corpus pipeline: from the table documents to packed token sequences.

Each stage takes all that the one before kept, written as Parquet and read again, and returns the columns of
documents; the last returns the packed pieces.

1. language_id      documents whose text the language models reject are dropped
2. near_duplicates  of each class of near-duplicates the document with the least doc_id stays
3. repeated_strings bytes under 400-byte strings that occur elsewhere are cut out
4. secrets          secrets are replaced by a mark
5. packing          texts become tokens, packed into sequences of at most 2048

Stages 3 and 4 keep every row, and set n_chars (where there is one) to the new length; a text may be empty
afterwards.  SQL cannot express the stages; ``tests/llm/test_pipeline.py`` holds them against plain versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import langid, near, packing, secrets, suffix
from cartwheel.llm.common import materialize, table
from cartwheel.llm.tokens import vocabulary_path


def _measured(docs: DataFrame) -> DataFrame:
    """``docs`` with n_chars, if it has that column, equal to its text's length (null for a null text)."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near.one_of_each(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(suffix.deduplicate(docs)).select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = secrets.with_spans(docs)
    return _measured(found.withColumn("text", secrets.redacted(F.col("text"), F.col("__spans")))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, vocabulary_path())


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("secrets", redact_secrets),
    ("packing", pack),
]
#: No SQL can express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
