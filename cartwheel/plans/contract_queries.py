"""Contract queries (B) with DuckDB oracles, on the dirty-row and request fixtures."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cartwheel.operators import contract as C
from cartwheel.schema import (
    CODE_COLUMNS, EXPECTED_COLUMNS, FEATURE_COLUMNS, INTEGER_COLUMNS, LABEL, MONTH_ORDER, NON_NEGATIVE_COLUMNS,
    NUMERIC_INPUT_COLUMNS, RATE_COLUMNS, VISITOR_TYPES,
)
from cartwheel.session import ensure_checkpoint_dir
from cartwheel.sources.csv_sessions import load_sessions_csv, session_lines, write_lines
from cartwheel.sources.sessions import load_sessions, with_sessions

SPARK = {}
SQL = {}
KEYS = ("user_id", "session_date")


def _annotated(spark, sf):
    return C.annotate(C.dirty_sessions(load_sessions(spark, sf)), KEYS)


def _valid(spark, sf):
    return C.split_valid(_annotated(spark, sf), KEYS)[0]


SPARK["contract_violations"] = lambda spark, sf: C.violations_long(_annotated(spark, sf), KEYS)
SPARK["contract_rule_summary"] = lambda spark, sf: C.rule_summary(_annotated(spark, sf))
SPARK["contract_valid_rows"] = _valid
SPARK["contract_dataset_rules"] = lambda spark, sf: C.dataset_rules(_annotated(spark, sf))
SPARK["request_violations"] = lambda spark, sf: C.request_violations(C.request_bodies(load_sessions(spark, sf)))
SPARK["request_violations_coerce"] = lambda spark, sf: C.request_violations(
    C.request_bodies(load_sessions(spark, sf)), coerce=True)

# ---------------------------------------------------------------- oracle text

_FAULTS = {"Administrative": (0, "'-1'"), "BounceRates": (1, "'1.1'"), "Month": (2, "'Jan'"),
           "VisitorType": (3, "'Robot'"), "Browser": (4, "'0'"), "ProductRelated": (5, "'1.5'"),
           "PageValues": (6, "'abc'"), "Weekend": (7, "'yes'"), "SpecialDay": (8, "'NaN'"),
           "Region": (9, "CAST(NULL AS VARCHAR)"), "OperatingSystems": (10, "'1e30'"), "TrafficType": (11, "'Infinity'"),
           "Informational": (12, "'NaN'"), "ProductRelated_Duration": (13, "'Infinity'")}


def _dirty_cte():
    cols = []
    for c in EXPECTED_COLUMNS:
        if c == "Weekend":
            t = "CASE WHEN Weekend THEN ' true' ELSE 'FALSE ' END"
        elif c == LABEL:
            t = "CASE WHEN Revenue THEN 'True' ELSE ' false' END"
        else:
            t = f"CAST({c} AS VARCHAR)"
        if c in _FAULTS:
            s, v = _FAULTS[c]
            t = f"CASE WHEN (user_id * 31 + day(session_date)) % 50 = {s} THEN {v} ELSE {t} END"
        cols.append(f"{t} AS {c}")
    return "dirty AS (SELECT user_id, session_date, " + ", ".join(cols) + " FROM sessions)"


def _num(c):
    return f"TRY_CAST(trim({c}) AS DOUBLE)"


def _missing(c):
    if c in NUMERIC_INPUT_COLUMNS:
        return f"({c} IS NULL OR trim({c}) = '' OR coalesce(isnan({_num(c)}), false))"
    if c in ("Weekend", LABEL):
        return f"({c} IS NULL OR trim({c}) = '')"
    return f"({c} IS NULL)"


def _checks():
    out = []
    for c in EXPECTED_COLUMNS:
        m = _missing(c)
        out.append((c, "null", m))
        if c in ("Weekend", LABEL):
            out.append((c, "boolean", f"NOT {m} AND upper(trim({c})) NOT IN ('TRUE', 'FALSE')"))
        elif c in NUMERIC_INPUT_COLUMNS:
            ok = f"NOT {m} AND {_num(c)} IS NOT NULL"
            out.append((c, "numeric", f"NOT {m} AND {_num(c)} IS NULL"))
            if c in NON_NEGATIVE_COLUMNS:
                out.append((c, "non_negative", f"{ok} AND {_num(c)} < 0"))
            if c in RATE_COLUMNS:
                out.append((c, "range_0_1", f"{ok} AND NOT ({_num(c)} BETWEEN 0 AND 1)"))
            if c in INTEGER_COLUMNS:
                out.append((c, "integer", f"{ok} AND ({_num(c)} % 1 <> 0 OR TRY_CAST({_num(c)} AS BIGINT) IS NULL)"))
            if c in CODE_COLUMNS:
                out.append((c, "positive_code", f"{ok} AND {_num(c)} < 1"))
        else:
            dom = MONTH_ORDER if c == "Month" else VISITOR_TYPES
            lst = ", ".join(f"'{x}'" for x in dom)
            out.append((c, "unknown_category", f"NOT {m} AND {c} NOT IN ({lst})"))
    return out


_VIOL = "viol AS (" + "\nUNION ALL\n".join(
    f"SELECT user_id, session_date, '{c}' AS \"column\", '{r}' AS rule, "
    + (f"{c} AS raw_value" if c in ("Month", "VisitorType") else "CAST(NULL AS VARCHAR) AS raw_value")
    + f" FROM dirty WHERE {cond}"
    for c, r, cond in _checks()) + ")"

SQL["contract_violations"] = with_sessions(
    'SELECT user_id, session_date, "column", rule FROM viol', _dirty_cte(), _VIOL)
SQL["contract_rule_summary"] = with_sessions(
    """SELECT rule, "column", count(*) AS rows,
       count(DISTINCT raw_value) FILTER (WHERE rule = 'unknown_category') AS distinct_values
FROM viol GROUP BY rule, "column\"""", _dirty_cte(), _VIOL)


SQL["contract_dataset_rules"] = with_sessions(
    f"""SELECT 'empty' AS rule, count(*) AS found, count(*) = 0 AS broken FROM dirty
UNION ALL
SELECT 'two_classes', count(DISTINCT label), count(DISTINCT label) <> 2
FROM (SELECT CASE upper(trim({LABEL})) WHEN 'TRUE' THEN true WHEN 'FALSE' THEN false END AS label FROM dirty) t""", _dirty_cte())


def _typed(c):
    if c in ("Weekend", LABEL):
        return f"(upper(trim({c})) = 'TRUE') AS {c}"
    if c in INTEGER_COLUMNS:
        return f"TRY_CAST({_num(c)} AS BIGINT) AS {c}"
    if c in NUMERIC_INPUT_COLUMNS:
        return f"{_num(c)} AS {c}"
    return c


SQL["contract_valid_rows"] = with_sessions(
    "SELECT user_id, session_date, " + ", ".join(_typed(c) for c in EXPECTED_COLUMNS)
    + " FROM dirty d WHERE NOT EXISTS (SELECT 1 FROM viol v WHERE v.user_id = d.user_id AND v.session_date = d.session_date)",
    _dirty_cte(), _VIOL)

# ---- request contract oracle


def _req_cte():
    def sub(f, new):
        return f"regexp_replace(b, '\"{f}\":[^,}}]*', '\"{f}\":{new}')"
    edits = [
        (0, sub("Administrative", "-1")), (1, sub("BounceRates", "1.01")), (2, sub("Browser", "0")),
        (3, sub("Month", '"Jan"')), (4, sub("VisitorType", '"Robot"')),
        (5, "regexp_replace(b, '\"Month\":\"[^\"]*\",', '')"),
        (6, "regexp_replace(b, '}$', ',\"SessionId\":\"x\"}')"), (7, sub("Administrative", "2.0")),
        (8, sub("Weekend", '"true"')), (9, sub("ProductRelated", "null")), (10, sub("PageValues", "1e999")),
        (11, "'bad'"), (12, "regexp_replace(b, '\"Month\":', '\"month\":')"),
    ]
    case = "CASE " + " ".join(f"WHEN slot = {s} THEN {e}" for s, e in edits) + " ELSE b END"
    struct = "{" + ", ".join(f"'{f}': {f}" for f in FEATURE_COLUMNS) + "}"
    return (
        "rb AS (SELECT user_id, session_date, (user_id * 31 + day(session_date)) % 20 AS slot, "
        f"CAST(to_json({struct}) AS VARCHAR) AS b FROM sessions),\n"
        "requests AS (SELECT CAST(user_id AS VARCHAR) || '-' || strftime(session_date, '%Y%m%d') AS request_id, "
        f"{case} AS body FROM rb)"
    )


def _req_sql(coerce=False):
    allowed = ", ".join(f"'{x}'" for x in [*FEATURE_COLUMNS, *[C.snake_name(f) for f in FEATURE_COLUMNS]])
    parts = ["SELECT request_id, 'body' AS field, 'invalid_json' AS rule FROM requests WHERE NOT json_valid(body)"]
    vals = []
    for f in FEATURE_COLUMNS:
        vals.append(f"coalesce(json_extract(body, '$.{f}'), json_extract(body, '$.{C.snake_name(f)}')) AS v_{f}")
    kinds = "p AS (SELECT request_id, " + ", ".join(vals) + " FROM requests WHERE json_valid(body)),\n"
    kind_cols = []
    for f in FEATURE_COLUMNS:
        t = f"json_type(v_{f})"
        kind_cols.append(
            f"CASE WHEN v_{f} IS NULL THEN NULL WHEN {t} IN ('UBIGINT', 'BIGINT') THEN 'int' "
            f"WHEN {t} = 'DOUBLE' THEN 'float' WHEN {t} = 'BOOLEAN' THEN 'bool' WHEN {t} = 'VARCHAR' THEN 'string' "
            f"WHEN {t} = 'NULL' THEN 'null' ELSE 'other' END AS k_{f}")
        num = f"TRY_CAST(v_{f} AS DOUBLE)"
        if coerce:
            num = f"coalesce({num}, TRY_CAST(json_extract_string(v_{f}, '$') AS DOUBLE))"
        kind_cols.append(f"{num} AS n_{f}")
        kind_cols.append(f"json_extract_string(v_{f}, '$') AS s_{f}")
    kinds += "k AS (SELECT request_id, " + ", ".join(kind_cols) + " FROM p)"
    for f in FEATURE_COLUMNS:
        k, n, s = f"k_{f}", f"n_{f}", f"s_{f}"
        parts.append(f"SELECT request_id, '{f}', 'missing' FROM k WHERE {k} IS NULL")
        pres = f"{k} IS NOT NULL"
        if f in (*C.INT_FIELDS, *C.CODE_FIELDS):
            ok = f"{k} = 'int'" if not coerce else f"({n} IS NOT NULL AND {n} % 1 = 0 AND {k} <> 'bool')"
            lo = 1 if f in C.CODE_FIELDS else 0
            parts.append(f"SELECT request_id, '{f}', 'type' FROM k WHERE {pres} AND NOT coalesce({ok}, false)")
            parts.append(f"SELECT request_id, '{f}', 'range' FROM k WHERE {pres} AND coalesce({ok}, false) AND {n} < {lo}")
        elif f in (*C.FLOAT_FIELDS, *C.RATE_FIELDS):
            ok = f"{k} IN ('int', 'float')" if not coerce else f"({n} IS NOT NULL AND {k} <> 'bool')"
            fin = f"(NOT isnan({n}) AND abs({n}) <> 'inf'::DOUBLE)"
            rng = f"({n} < 0 OR {n} > 1)" if f in C.RATE_FIELDS else f"{n} < 0"
            parts.append(f"SELECT request_id, '{f}', 'type' FROM k WHERE {pres} AND NOT coalesce({ok}, false)")
            parts.append(f"SELECT request_id, '{f}', 'not_finite' FROM k WHERE {pres} AND coalesce({ok}, false) AND NOT {fin}")
            parts.append(f"SELECT request_id, '{f}', 'range' FROM k WHERE {pres} AND coalesce({ok}, false) AND {fin} AND {rng}")
        elif f in C.BOOL_FIELDS:
            ok = f"{k} = 'bool'" if not coerce else f"({k} = 'bool' OR lower({s}) IN ('true', 'false'))"
            parts.append(f"SELECT request_id, '{f}', 'type' FROM k WHERE {pres} AND NOT coalesce({ok}, false)")
        else:
            dom = ", ".join(f"'{x}'" for x in C.ENUM_FIELDS[f])
            parts.append(f"SELECT request_id, '{f}', 'type' FROM k WHERE {pres} AND {k} <> 'string'")
            parts.append(f"SELECT request_id, '{f}', 'enum' FROM k WHERE {pres} AND {k} = 'string' AND {s} NOT IN ({dom})")
    parts.append(
        "SELECT request_id, key, 'extra' FROM (SELECT request_id, unnest(json_keys(body)) AS key FROM requests "
        f"WHERE json_valid(body)) x WHERE key NOT IN ({allowed})")
    return with_sessions("SELECT request_id, field, rule FROM (" + "\nUNION ALL\n".join(parts)
                         + ") u(request_id, field, rule)", _req_cte(), kinds)


SQL["request_violations"] = _req_sql(False)
SQL["request_violations_coerce"] = _req_sql(True)


# ---- CSV source (A1): the sessions written as CSV lines, some broken, and read back


def _csv(spark, sf):
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cartwheel-tables/csv-{uuid.uuid4().hex}"
    write_lines(session_lines(load_sessions(spark, sf)).select("line"), path)
    return load_sessions_csv(spark, path)


SPARK["csv_sessions"] = lambda spark, sf: C.split_valid(C.annotate(_csv(spark, sf).rows))[0]
SQL["csv_sessions"] = with_sessions(
    "SELECT " + ", ".join(EXPECTED_COLUMNS) + " FROM sessions WHERE (user_id * 31 + day(session_date)) % 40 > 2")

SPARK["csv_quarantine"] = lambda spark, sf: _csv(spark, sf).quarantine.groupBy("reason").agg(
    F.count(F.lit(1)).alias("lines"), F.count_if(F.col("line").startswith('"')).alias("open_quotes"))
SQL["csv_quarantine"] = with_sessions("""
SELECT 'malformed' AS reason, count(*) AS lines, count(*) FILTER (WHERE (user_id * 31 + day(session_date)) % 40 = 2) AS open_quotes
FROM sessions WHERE (user_id * 31 + day(session_date)) % 40 <= 2 HAVING count(*) > 0""")

# ---- the two contracts on the same infinite values


def _infinity(spark, sf):
    """Rows whose durations and page values are infinite, judged as a data row and as a request body."""
    return C.infinity_verdicts(C.infinite_sessions(load_sessions(spark, sf)), KEYS)


SPARK["contract_infinity_rules"] = _infinity
SQL["contract_infinity_rules"] = with_sessions("""
SELECT user_id, session_date, rule_set, c."column",
       CASE WHEN NOT isinf(v) AND v >= 0 THEN 'passes'
            WHEN isinf(v) AND rule_set = 'request' THEN 'not_finite'
            WHEN v < 0 THEN CASE rule_set WHEN 'dataset' THEN 'non_negative' ELSE 'range' END
            ELSE 'passes' END AS verdict
FROM (SELECT user_id, session_date, 'ProductRelated_Duration' AS "column", CASE (user_id * 31 + day(session_date)) % 4
         WHEN 0 THEN 'inf'::DOUBLE WHEN 1 THEN -1e0 ELSE ProductRelated_Duration END AS v FROM sessions
      UNION ALL SELECT user_id, session_date, 'PageValues', CASE (user_id * 31 + day(session_date)) % 4
         WHEN 2 THEN 'inf'::DOUBLE ELSE PageValues END FROM sessions) c,
     (VALUES ('dataset'), ('request')) r(rule_set)""")
