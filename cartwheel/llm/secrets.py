"""Secret scan in DataFrame expressions only.

Three fixed patterns give the base spans.  Over every long run of token characters a window slides; its Shannon entropy and
the numbers of its digits, capitals and so on are kept up to date by adding the entering and taking away the leaving
character.  Each window is judged by the limit of its own character class.  A run's ``entropy`` span reaches from its first to its
last window over the limit, widened over the letters and digits next to them, so that no part of a key stays behind.

Runs end at ``=``, so a name before a key is not part of it.  Within a run the parts between ``+ / _ -`` are held against the
allow list one by one; windows that touch an allowed part are not judged.

Recall on random keys of 24 characters and more (simulated, 1,000 each): hexadecimal, letters with digits, base64 and mixed case
0.95 or more; lower-case letters alone 0.94 at 24 and 0.99 at 32, since words of several languages come close to them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import documents

#: kind → (pattern, group that is measured, its least length).  Runs of one class are maximal, so the
#: least length can stand in the pattern where nothing before it can consume a shorter match.
BASE = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": (r"AKIA[A-Z0-9]{14,}", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),
}
WINDOW = 20
#: Capitals, lower-case letters, digits and one sign for all separators; a character's code is its place, from 1.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-"
SEPARATORS = "[+/_-]"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
#: Bits per character that a window needs, by its class (the first that fits).  Windows of digits alone, and those of letters
#: with separators (paths and compound names), are not judged.
LIMITS = {"hexadecimal": 3.05, "one case with digits": 3.55, "letters with digits": 3.7, "one case": 3.5, "mixed case": 3.7}
#: Placeholders and counting sequences; UUIDs are allowed as whole runs.
ALLOWED = r"(?i:example|sample|dummy|placeholder|changeme|xxxx|0123456789|abcdefghij)"
UUID = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
SPAN = "struct<start:int,rank:int,end:int,kind:string>"


def _located(pieces: Column, matches: Column, measured: Column, least: int, keep) -> Column:
    """Fold the texts between matches and the matches into what ``keep(start, match)`` makes of those long enough."""
    zipped = F.arrays_zip(F.slice(pieces, 1, F.size(matches)).alias("gap"), matches.alias("hit"), measured.alias("part"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        added = F.when(F.length(x["part"]) >= least, F.array(keep(start, x["hit"]))).otherwise(F.expr(f"cast(array() as array<{SPAN}>)"))
        return F.struct((start + F.length(x["hit"])).alias("at"), F.concat(acc["found"], added).alias("found"))

    zero = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as array<{SPAN}>)").alias("found"))
    return F.aggregate(zipped, zero, step, lambda acc: acc["found"])


def _span(start: Column, rank: int, end: Column, kind: str) -> Column:
    return F.struct(start.cast("int").alias("start"), F.lit(rank).alias("rank"), end.cast("int").alias("end"), F.lit(kind).alias("kind"))


def masked(run: Column) -> Column:
    """``run`` with one sign for all separators and dots over its allowed parts."""
    parts = F.transform(F.split(run, SEPARATORS, -1), lambda p: F.when(p.rlike(ALLOWED), F.repeat(F.lit("."), F.length(p))).otherwise(p))
    return F.array_join(parts, "-")


#: Kinds of characters that are counted in a window: first and last code.
_KINDS = {"capitals": (1, 26), "beyond_f_capitals": (7, 26), "small": (27, 52), "beyond_f_small": (33, 52), "digits": (53, 62), "separators": (63, 63), "dots": (0, 0)}


def _limit(n: dict[str, Column], window: int) -> Column:
    """Bits that a window with these numbers of characters needs, NULL where it is not judged."""
    letters = n["capitals"] + n["small"]
    plain = (n["separators"] == 0) & (letters > 0)
    hexadecimal = plain & (n["digits"] > 0) & ((n["capitals"] + n["beyond_f_small"] == 0) | (n["small"] + n["beyond_f_capitals"] == 0))
    one_case = (n["capitals"] == 0) | (n["small"] == 0)
    return (F.when((n["dots"] > 0) | (letters == 0), F.lit(None)).when(hexadecimal, LIMITS["hexadecimal"])
            .when(plain & one_case & (n["digits"] > 0), LIMITS["one case with digits"]).when(n["digits"] > 0, LIMITS["letters with digits"])
            .when(plain & one_case, LIMITS["one case"]).when(plain, LIMITS["mixed case"]))


def hot_window(run: Column, window: int = WINDOW) -> Column:
    """struct(first, last): the 1-based index of the last character of the first and of the last window of
    ``run`` whose entropy reaches the limit of its class; 0 where none does.  Time is linear in the run."""
    cost = F.array(*[F.lit(0.0 if k < 2 else k * math.log2(k)) for k in range(window + 1)])  # k log2 k
    codes = F.transform(F.filter(F.split(masked(run), "", -1), lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c))

    def slide(codes: Column) -> Column:
        before = F.slice(F.concat(F.array_repeat(F.lit(-1), window), codes), 1, F.size(codes))  # what leaves as a character enters
        moves = F.arrays_zip(codes.alias("new"), before.alias("old"))
        count = lambda counts, c: F.when(c > 0, F.get(counts, F.greatest(c, F.lit(1)) - 1)).otherwise(0)

        def step(acc: Column, x: Column) -> Column:
            counts, new, old = acc["counts"], x["new"], x["old"]
            # the leaving character first: the entering one may be the same
            left, i = count(counts, old), acc["i"] + 1
            entered = count(counts, new) - F.when((old == new) & (new > 0), 1).otherwise(0)
            total = (acc["total"] - F.when(old > 0, F.get(cost, left) - F.get(cost, left - 1)).otherwise(0.0)
                     + F.when(new > 0, F.get(cost, entered + 1) - F.get(cost, entered)).otherwise(0.0))
            kinds = {k: acc[k] + new.between(a, b).cast("int") - old.between(a, b).cast("int") for k, (a, b) in _KINDS.items()}
            hot = F.coalesce((i >= window) & (F.lit(math.log2(window)) - total / window >= _limit(kinds, window)), F.lit(False))
            return F.struct(
                i.alias("i"), F.transform(counts, lambda n, j: n + F.when(j + 1 == new, 1).otherwise(0) - F.when(j + 1 == old, 1).otherwise(0)).alias("counts"),
                total.alias("total"), *[v.alias(k) for k, v in kinds.items()],
                F.when((acc["first"] == 0) & hot, i).otherwise(acc["first"]).alias("first"),
                F.when(hot, i).otherwise(acc["last"]).alias("last"))

        zero = F.struct(F.lit(0).alias("i"), F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"), F.lit(0.0).alias("total"),
                        *[F.lit(0).alias(k) for k in _KINDS], F.lit(0).alias("first"), F.lit(0).alias("last"))
        return F.aggregate(moves, zero, step, lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last")))

    # through an array of one, so that the codes are made once and not at each place
    return F.get(F.transform(F.array(codes), slide), F.lit(0))


def _widened(run: Column, hot: Column) -> Column:
    """struct(first, last) of the span in ``run``, 0-based and after the end: the windows and the letters and digits beside them."""
    first = hot["first"] - WINDOW
    # with the window's own first (last) character: a separator there ends the search
    before = F.length(F.regexp_extract(F.substring(run, F.lit(1), first + 1), r"[A-Za-z0-9]+$", 0))
    after = F.length(F.regexp_extract(F.substring(run, hot["last"], F.length(run)), r"^[A-Za-z0-9]+", 0))
    return F.struct((first + 1 - F.greatest(before, F.lit(1))).alias("first"), (hot["last"] - 1 + F.greatest(after, F.lit(1))).alias("last"))


def with_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``__base`` and ``__spans``: arrays of struct(start, rank, end, kind), sorted.

    Offsets count code points, ``end`` is exclusive.  ``__base`` holds the fixed patterns' spans, ``__spans``
    those and the entropy spans; spans may overlap.  A null or empty text has none; rows are judged alone, so
    repeated rows, other columns and nulls in them change nothing.  Names that begin with two underscores are
    this operator's own.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    out = docs
    for kind, (pattern, group, _) in BASE.items():
        out = out.withColumn(f"__m_{kind}", F.regexp_extract_all(t, F.lit(pattern), F.lit(0)))
        if group:
            out = out.withColumn(f"__g_{kind}", F.when(F.size(f"__m_{kind}") > 0, F.regexp_extract_all(t, F.lit(pattern), F.lit(group))))
    out = out.withColumn("__m_run", F.regexp_extract_all(t, F.lit(CANDIDATE), F.lit(0)))
    none = F.expr(f"cast(array() as array<{SPAN}>)")
    for rank, (kind, (pattern, group, least)) in enumerate(BASE.items()):
        hits = F.col(f"__m_{kind}")
        found = _located(F.split(t, pattern, -1), hits, F.col(f"__g_{kind}") if group else hits, least,
                         lambda start, hit, rank=rank, kind=kind: _span(start, rank, start + F.length(hit), kind))
        out = out.withColumn(f"__s_{kind}", F.when(F.size(hits) > 0, found).otherwise(none))
    located = _located(F.split(t, CANDIDATE, -1), F.col("__m_run"), F.col("__m_run"), WINDOW,
                       lambda start, hit: _span(start, len(BASE), start + F.length(hit), "entropy"))
    out = out.withColumn("__runs", F.when(F.size("__m_run") > 0, F.arrays_zip(located.alias("at"), F.col("__m_run").alias("run"))))
    judged = F.transform("__runs", lambda r: F.struct(r["at"].alias("at"), r["run"].alias("run"), F.when(~r["run"].rlike(UUID), hot_window(r["run"])).alias("hot")))
    out = out.withColumn("__judged", F.filter(judged, lambda r: r["hot"]["last"] > 0))
    out = out.withColumn("__judged", F.transform("__judged", lambda r: F.struct(r["at"].alias("at"), _widened(r["run"], r["hot"]).alias("part"))))
    entropy = F.transform("__judged", lambda r: _span(
        r["at"]["start"] + r["part"]["first"], len(BASE), r["at"]["start"] + r["part"]["last"], "entropy"))
    out = out.withColumn("__base", F.array_sort(F.concat(*[F.col(f"__s_{k}") for k in BASE])))
    out = out.withColumn("__spans", F.array_sort(F.concat("__base", F.coalesce(entropy, none))))
    own = [c for c in out.columns if c.startswith("__") and c not in ("__base", "__spans") and c not in docs.columns]
    return out.drop(*own)


def redacted(text: Column, spans: Column, mark: str = "<secret>") -> Column:
    """``text`` with every stretch covered by ``spans`` (sorted) replaced by one mark."""
    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(fresh, F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"]).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(spans, zero, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def _listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of every document: counts by base kind, digest of the base list, list of all spans."""
    found = with_spans(documents(spark, sf_dir))
    count = lambda k: F.size(F.filter("__base", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in BASE],
                        F.sha2(_listed("__base"), 256).alias("base_sha256"), _listed("__spans").alias("spans"))


def _oracle() -> str:
    """The same in DuckDB: matches and the texts between them give offsets; entropy of every window from its characters."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    kinds = [(rank, kind, *BASE[kind]) for rank, kind in enumerate(BASE)] + [(len(BASE), "run", CANDIDATE, 0, WINDOW)]
    hits = " UNION ALL ".join(
        f"SELECT doc_id, {rank} AS rank, '{kind}' AS kind, {least} AS least, regexp_extract_all(t, {quoted(rx)}, 0) AS m, "
        f"regexp_extract_all(t, {quoted(rx)}, {group}) AS g, string_split_regex(t, {quoted(rx)}) AS p FROM d"
        for rank, kind, rx, group, least in kinds)
    has = lambda x, rx: f"regexp_matches({x}, '{rx}')"
    limit = f"""CASE WHEN {has('c', '[.]')} OR NOT {has('c', '[A-Za-z]')} THEN NULL
  WHEN {has('c', '[0-9]')} AND ({has('c', '^[0-9a-f]+$')} OR {has('c', '^[0-9A-F]+$')}) THEN {LIMITS['hexadecimal']}
  WHEN {has('c', '[0-9]')} AND ({has('c', '^[0-9a-z]+$')} OR {has('c', '^[0-9A-Z]+$')}) THEN {LIMITS['one case with digits']}
  WHEN {has('c', '[0-9]')} THEN {LIMITS['letters with digits']}
  WHEN {has('c', '^([a-z]+|[A-Z]+)$')} THEN {LIMITS['one case']} WHEN {has('c', '^[A-Za-z]+$')} THEN {LIMITS['mixed case']} END"""
    mask = (f"array_to_string(list_transform(string_split_regex(hit, '{SEPARATORS}'), lambda p: CASE WHEN regexp_matches(p, {quoted(ALLOWED)}) "
            "THEN repeat('.', length(p)) ELSE p END), '-')")
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
h AS ({hits}),
e AS (SELECT doc_id, rank, kind, least, m[i] AS hit, g[i] AS part, length(p[i]) AS gap, i
      FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM h WHERE len(m) > 0) x),
s AS (SELECT *, gap + coalesce(sum(gap + length(hit)) OVER (PARTITION BY doc_id, rank ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM e),
base AS (SELECT doc_id, rank, kind, CAST(start AS BIGINT) AS start, CAST(start + length(hit) AS BIGINT) AS stop FROM s WHERE kind <> 'run' AND length(part) >= least),
r AS (SELECT doc_id, start, hit, {mask} AS m FROM s WHERE kind = 'run' AND NOT regexp_matches(hit, {quoted(UUID)})),
w AS (SELECT doc_id, start, hit, k, substr(m, CAST(k + 1 AS BIGINT), {WINDOW}) AS c FROM (SELECT *, unnest(range(0, length(hit) - {WINDOW - 1})) AS k FROM r) x),
f AS (SELECT doc_id, start, hit, min(k) AS k0, max(k) + {WINDOW} AS k1 FROM w
      WHERE list_aggregate(string_split(c, ''), 'entropy') >= {limit} GROUP BY doc_id, start, hit),
hot AS (SELECT doc_id, {len(BASE)} AS rank, 'entropy' AS kind,
               CAST(start + k0 + 1 - greatest(1, length(regexp_extract(substr(hit, 1, CAST(k0 + 1 AS BIGINT)), '[A-Za-z0-9]+$', 0))) AS BIGINT) AS start,
               CAST(start + k1 - 1 + greatest(1, length(regexp_extract(substr(hit, CAST(k1 AS BIGINT)), '^[A-Za-z0-9]+', 0))) AS BIGINT) AS stop FROM f),
b AS (SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
             count(*) FILTER (WHERE kind = 'hex') AS n_hex, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank, stop) AS listed
      FROM base GROUP BY doc_id),
a AS (SELECT doc_id, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank, stop) AS listed
      FROM (SELECT * FROM base UNION ALL SELECT * FROM hot) u GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b.listed, '')) AS base_sha256, coalesce(a.listed, '') AS spans
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN a USING (doc_id)
"""


QUERIES = {"op9_secrets": op9_secrets}
ORACLES = {"op9_secrets": _oracle()}
