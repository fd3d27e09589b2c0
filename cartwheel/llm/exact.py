"""Exact duplicates by content hash, with the bytes compared.

Texts are put to one form of white space and grouped by a 128-bit hash; of a group the row with the least id
stays.  Whether a hash stands for one text only is settled by the bytes: rows are reduced to the distinct pairs
of hash and text, in the map tasks first, so that a text with any number of copies leaves each task once, and a
hash with several texts is split into one group per text.

No group is gathered.  Sizes and least ids are partial sums and minima; groups of more than a thousandth of all
rows, of which there are fewer than a thousand, reach their rows by a broadcast, the others by a join whose keys
have less than a thousandth of the rows each.

Null texts count as empty, and the empty text is a text like others.  Null ids come last: a group whose ids
are all null keeps one of its rows and has a null keep_id.  Of rows that repeat id and text one stays.  An empty
table gives an empty one; other columns of the input may have any names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import materialize, table

#: A group is hot above this share of all rows; at most as many groups as its inverse can be.
HOT_SHARE = 1000


def normalised(text: Column) -> Column:
    """``text`` with each stretch of ASCII white space as one space; null is the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def content_hash(text: Column) -> Column:
    """128 bits."""
    return F.unhex(F.md5(text))


def _versions(forms: DataFrame) -> DataFrame | None:
    """hash, text, version (from 0, in order of the texts) for each hash that stands for several texts; None if
    no hash does."""
    distinct = forms.select("__hash", "__text").distinct()
    several = materialize(distinct.groupBy("__hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("__hash"), "exact-collisions")
    if several.isEmpty():
        return None
    order = Window.partitionBy("__hash").orderBy("__text")
    return distinct.join(several, "__hash", "left_semi").withColumn("__version", F.row_number().over(order) - 1)


def grouped_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", carried: list[str] | None = None,
                       digest: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per row of ``docs``: __doc (a struct of the columns ``carried``, the key by default), __keep (the id
    that stays), __size (rows with an equal text), __kept, __sha (sha256 of the normalised text in lowercase hex)."""
    forms = docs.select(F.col(f"`{key}`").alias("__key"), F.struct(*[F.col(f"`{c}`") for c in carried or [key]]).alias("__doc"),
                        normalised(F.col(f"`{text}`")).alias("__text")).withColumn("__hash", digest(F.col("__text")))
    versions = _versions(forms)
    if versions is None:
        forms = forms.withColumn("__version", F.lit(0))
    else:
        forms = forms.join(versions, ["__hash", "__text"], "left").withColumn("__version", F.coalesce("__version", F.lit(0)))
    rows = materialize(forms.select(F.monotonically_increasing_id().alias("__row"), "__key", "__doc", "__hash", "__version",
                                    F.sha2("__text", 256).alias("__sha")), "exact-rows")
    groups = rows.groupBy("__hash", "__version").agg(
        F.count(F.lit(1)).alias("__size"), F.min("__key").alias("__keep"),
        F.coalesce(F.min_by("__row", "__key"), F.min("__row")).alias("__first")).where("__size > 1")
    groups = materialize(groups, "exact-groups")
    least = rows.count() // HOT_SHARE
    hot, rest = groups.where(F.col("__size") > least), groups.where(F.col("__size") <= least)
    both = ["__hash", "__version"]
    told = ["__doc", F.col("__keep"), F.col("__size"), (F.col("__row") == F.col("__first")).alias("__kept"), "__sha"]
    copies = rows.join(F.broadcast(hot), both).select(*told)
    others = rows.join(F.broadcast(hot.select(*both)), both, "left_anti").join(rest, both, "left")
    alone = F.col("__size").isNull()
    others = others.select("__doc", F.when(alone, F.col("__key")).otherwise(F.col("__keep")).alias("__keep"),
                           F.coalesce("__size", F.lit(1)).alias("__size"), (alone | (F.col("__row") == F.col("__first"))).alias("__kept"), "__sha")
    return copies.unionByName(others)


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = content_hash) -> DataFrame:
    """Per row of ``docs``: its id, keep_id, group_size, kept, text_sha256."""
    return grouped_duplicates(docs, key, text, digest=digest).select(
        F.col(f"__doc.`{key}`").alias(key), F.col("__keep").alias("keep_id"), F.col("__size").alias("group_size"),
        F.col("__kept").alias("kept"), F.col("__sha").alias("text_sha256"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    return grouped_duplicates(docs, key, text, docs.columns).where("__kept").select("__doc.*")


def op13_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op13_exact_duplicates": op13_exact_duplicates}
ORACLES = {
    "op13_exact_duplicates": r"""
WITH forms AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS form FROM documents
), groups AS (
  SELECT form, min(doc_id) AS keep_id, count(*) AS group_size FROM forms GROUP BY form
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(form) AS text_sha256
FROM forms JOIN groups USING (form)
""",
}
