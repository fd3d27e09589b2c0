"""Not-modified revisit resolution for web captures.

A crawler that sends a conditional request and gets "304 not modified" writes a revisit record without a
payload.  ``resolve_revisits`` finds, by an as-of join on the canonical URL, the latest full response that
was captured strictly earlier, checks the revisit's validator against it and merges the headers that a 304
may update.

The as-of join never gathers a URL in one task: captures are range-partitioned by (URL, time), each
(range, URL) piece is a window of its own, and the last response of a piece is handed to the later pieces
of the same URL as one extra row.  A URL holding a third of all captures therefore spreads over a third of
the ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartwheel.llm.common import materialize, table

#: Header fields that a 304 response may update in the stored one.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Query parameters that do not select another document.
TRACKING = r"^(utm_[a-z]+|ref)="
_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)"


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` and default port, path without closing slashes, sorted query
    parameters without tracking ones; scheme and fragment are dropped.  Null stays null."""
    u = F.regexp_replace(F.trim(url), "#.*$", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(u, _AUTHORITY, 1)), r"^www\.|:80$|:443$", "")
    path = F.regexp_replace(F.regexp_extract(u, _PATH, 1), "/+$", "")
    params = F.array_sort(F.filter(F.split(F.regexp_extract(u, r"\?(.*)$", 1), "&"),
                                   lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise(""))


def merge_headers(stored: Column, fresh: Column, permitted: tuple[str, ...] = PERMITTED) -> Column:
    """``stored`` with the permitted fields of ``fresh`` put over it."""
    taken = F.map_filter(fresh, lambda k, _: k.isin(*permitted))
    kept = F.map_filter(stored, lambda k, _: ~F.array_contains(F.map_keys(taken), k))
    return F.map_concat(kept, taken)


def validator_outcome(revisit: Column, response: Column) -> Column:
    """The first validator that the revisit carries decides: entity tag (weak comparison), payload digest,
    modification time.  A revisit without any stays unverified."""
    weak = lambda c: F.regexp_replace(c, "^W/", "")
    etag, digest, modified = revisit["headers"]["etag"], revisit["digest"], revisit["headers"]["last-modified"]
    same = (F.when(etag.isNotNull(), weak(etag).eqNullSafe(weak(response["headers"]["etag"])))
            .when(digest.isNotNull(), digest.eqNullSafe(response["digest"]))
            .when(modified.isNotNull(), modified.eqNullSafe(response["headers"]["last-modified"])))
    return (F.when(response.isNull(), "no_prior").when(same.isNull(), "unverified")
            .when(same, "resolved").otherwise("validator_mismatch"))


def resolve_revisits(captures: DataFrame, permitted: tuple[str, ...] = PERMITTED) -> DataFrame:
    """One row per revisit capture: record_id, url_key, ts, outcome, target_id, digest, headers.

    ``captures`` has record_id, url, ts (any ordered type), kind ('response' or 'revisit'), digest and
    headers (map of lower-case names); further columns are ignored.  ``target_id``, ``digest`` and
    ``headers`` are those of the stored response, headers merged, and null unless the outcome is
    'resolved'.  A response at the revisit's own time is not earlier; of several responses at one time the
    largest record_id counts.  A revisit with a null URL or time is 'no_prior', null headers count as
    empty, repeated rows are resolved each, records of any other kind are ignored, an empty table gives an empty one.
    """
    empty = F.expr("cast(map() as map<string,string>)")
    rows = captures.select(
        canonical_url(F.col("url")).alias("url_key"), F.col("ts"), (F.col("kind") == "response").alias("full"),
        F.struct("record_id", "digest", F.coalesce("headers", empty).alias("headers")).alias("rec"),
    ).where(F.col("kind").isin("response", "revisit"))
    rows = rows.where(~F.col("full") | (F.col("url_key").isNotNull() & F.col("ts").isNotNull()))
    order = ["ts", "full", "rec.record_id"]
    ranged = materialize(rows.repartitionByRange("url_key", *order).withColumn("piece", F.spark_partition_id()),
                         "captures")
    latest = F.max_by(F.struct("ts", "rec"), F.struct("ts", "rec.record_id"))
    tails = ranged.where("full").groupBy("url_key", "piece").agg(latest.alias("tail"))
    # each (URL, piece) meets the last response of the pieces before: at most one row per piece of a URL
    pieces = ranged.select("url_key", "piece").distinct().join(tails, ["url_key", "piece"], "left")
    before = W.partitionBy("url_key").orderBy("piece").rowsBetween(W.unboundedPreceding, -1)
    carried = (pieces.withColumn("tail", F.last("tail", ignorenulls=True).over(before)).where("tail is not null")
               .select("url_key", F.col("tail.ts").alias("ts"), F.lit(True).alias("full"), F.col("tail.rec").alias("rec"),
                       "piece", F.lit(True).alias("carried")))
    # rows without a place in the order need no neighbours: they go anywhere
    placed = F.col("url_key").isNotNull() & F.col("ts").isNotNull()
    both = ranged.withColumn("carried", F.lit(False)).where(placed).unionByName(carried)
    prior = W.partitionBy("url_key", "piece").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    found = both.withColumn("prior", F.last(F.when(F.col("full"), F.col("rec")), ignorenulls=True).over(prior))
    lone = ranged.where(~placed).withColumn("carried", F.lit(False)).withColumn(
        "prior", F.when(F.lit(False), F.col("rec")))
    out = found.unionByName(lone).where(~F.col("full") & ~F.col("carried")).withColumn(
        "outcome", validator_outcome(F.col("rec"), F.col("prior")))
    good = F.col("outcome") == "resolved"
    return out.select(
        F.col("rec.record_id").alias("record_id"), "url_key", "ts", "outcome",
        F.when(good, F.col("prior.record_id")).alias("target_id"), F.when(good, F.col("prior.digest")).alias("digest"),
        F.when(good, merge_headers(F.col("prior.headers"), F.col("rec.headers"), permitted)).alias("headers"))


def captures_from_pages(pages: DataFrame, gap: int = 5000) -> DataFrame:
    """Two captures per page: the full response at minute ``page_id`` and a conditional re-crawl.

    The re-crawl follows ``gap`` minutes later, or comes as much earlier where the payload has an odd
    length; it carries the payload's entity tag, its digest or nothing, by the payload's length.
    """
    n = F.length(F.coalesce("html", F.lit("")))
    digest, minute = F.md5(F.coalesce("html", F.lit(""))), F.col("page_id")
    tag = F.concat(F.lit('"'), F.substring(digest, 1, 16), F.lit('"'))
    text = lambda c: c.cast("string")
    full = pages.select(
        (minute * 2).alias("record_id"), "url", minute.alias("ts"), F.lit("response").alias("kind"), digest.alias("digest"),
        F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("content-length"), text(n), F.lit("date"), text(minute),
                     F.lit("etag"), tag, F.lit("cache-control"), F.lit("max-age=60")).alias("headers"))
    later = F.when(n % 2 == 0, minute + gap).otherwise(minute - gap)
    weak = F.concat(F.lit("W/"), tag)
    base = [F.lit("date"), text(later), F.lit("cache-control"), F.lit("max-age=600"), F.lit("set-cookie"), F.lit("s=1")]
    again = pages.select(
        (minute * 2 + 1).alias("record_id"), "url", later.alias("ts"), F.lit("revisit").alias("kind"),
        F.when(n % 5 < 4, digest).alias("digest"),
        F.when(n % 5 < 3, F.create_map(*base, F.lit("etag"), weak)).otherwise(F.create_map(*base)).alias("headers"))
    return full.unionByName(again)


def op7_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conditional re-crawl of ``pages``, resolved."""
    out = resolve_revisits(captures_from_pages(table(spark, sf_dir, "pages")))
    shown = F.array_join(F.transform(F.array_sort(F.map_entries("headers")),
                                     lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return out.select("record_id", "url_key", "ts", "outcome", "target_id", "digest", shown.alias("headers"))


ORACLE = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, length(coalesce(html, '')) AS n, md5(coalesce(html, '')) AS digest,
         regexp_replace(trim(url), '#.*$', '') AS u FROM pages),
k AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1)), '^www\.', ''), ':80$|:443$', '')
           || regexp_replace(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)', 1), '/+$', '') AS base,
         list_sort([x FOR x IN string_split(regexp_extract(u, '\?(.*)$', 1), '&')
                    IF x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref)=')]) AS params
  FROM p),
c AS (
  SELECT page_id, n, digest, base || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS url_key,
         '"' || substr(digest, 1, 16) || '"' AS tag FROM k),
r AS (SELECT page_id * 2 + 1 AS record_id, url_key, CASE WHEN n % 2 = 0 THEN page_id + 5000 ELSE page_id - 5000 END AS ts,
             CASE WHEN n % 5 < 3 THEN tag END AS tag, CASE WHEN n % 5 < 4 THEN digest END AS digest FROM c),
j AS (
  SELECT r.record_id, r.url_key, r.ts, r.tag AS rtag, r.digest AS rdigest, max(c.page_id) AS prior
  FROM r LEFT JOIN c ON c.url_key = r.url_key AND c.page_id < r.ts GROUP BY ALL),
v AS (
  SELECT j.*, c.n, c.digest AS pdigest, c.tag AS ptag,
         CASE WHEN j.prior IS NULL THEN 'no_prior'
              WHEN rtag IS NOT NULL THEN CASE WHEN rtag = c.tag THEN 'resolved' ELSE 'validator_mismatch' END
              WHEN rdigest IS NOT NULL THEN CASE WHEN rdigest = c.digest THEN 'resolved' ELSE 'validator_mismatch' END
              ELSE 'unverified' END AS outcome
  FROM j LEFT JOIN c ON c.page_id = j.prior)
SELECT record_id, url_key, ts, outcome,
       CASE WHEN outcome = 'resolved' THEN prior * 2 END AS target_id,
       CASE WHEN outcome = 'resolved' THEN pdigest END AS digest,
       CASE WHEN outcome = 'resolved' THEN 'cache-control=max-age=600;content-length=' || n || ';content-type=text/html;date=' || ts
            || ';etag=' || CASE WHEN rtag IS NOT NULL THEN 'W/' || rtag ELSE ptag END END AS headers
FROM v
"""

QUERIES = {"op7_revisits": op7_revisits}
ORACLES = {"op7_revisits": ORACLE}
