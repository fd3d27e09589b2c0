"""Session contract (B1–B17): per-row violations, quarantine and strict mode.

One pass over the input yields a ``violations`` array per row; dataset-level
rules (columns present, non-empty, two label classes) are one aggregation.
``strict=True`` raises on the first broken rule in the fixed rule order;
``strict=False`` returns the typed valid rows and a quarantine table.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.expr import parse_bool
from cartwheel.schema import (
    CODE_COLUMNS,
    COUNT_COLUMNS,
    DURATION_COLUMNS,
    EXPECTED_COLUMNS,
    FEATURE_COLUMNS,
    INTEGER_COLUMNS,
    LABEL,
    MONTH_ORDER,
    NON_NEGATIVE_COLUMNS,
    NUMERIC_INPUT_COLUMNS,
    RATE_COLUMNS,
    VISITOR_TYPES,
)

# Fixed rule order of the dataset contract (first broken rule is reported in strict mode).
RULE_ORDER = (
    "missing_columns", "unexpected_columns", "empty", "null", "boolean", "numeric", "non_negative",
    "range_0_1", "integer", "positive_code", "unknown_category", "two_classes",
)
BOOLEAN_COLUMNS = ("Weekend", LABEL)
DOMAINS = {"Month": MONTH_ORDER, "VisitorType": VISITOR_TYPES}


class ContractError(ValueError):
    """Raised by strict validation on the first broken rule."""


def column_check(columns: Sequence[str], expected: Sequence[str] = EXPECTED_COLUMNS) -> tuple[list, list]:
    """B1 / L1: (missing, unexpected) column names, sorted.  Metadata only, no job."""
    actual, exp = set(columns), set(expected)
    return sorted(exp - actual), sorted(actual - exp)


def _violation(cond: Column, rule: str, column: str) -> Column:
    return F.when(cond, F.struct(F.lit(column).alias("column"), F.lit(rule).alias("rule")))


def annotate(raw: DataFrame, key_columns: Sequence[str] = ()) -> DataFrame:
    """Add typed columns and a ``violations`` array<struct<column, rule>> to raw (string) rows.

    Typed values are NULL where the cell is invalid.  Rows keep any key columns.
    """
    checks: list[Column] = []
    typed: dict[str, Column] = {}
    for c in EXPECTED_COLUMNS:
        text = F.trim(F.col(c).cast("string"))
        if c in BOOLEAN_COLUMNS:
            missing = F.col(c).isNull() | (text == "")
            val = parse_bool(text)
            checks.append(_violation(missing, "null", c))
            checks.append(_violation(~missing & val.isNull(), "boolean", c))
            typed[c] = val
        elif c in NUMERIC_INPUT_COLUMNS:
            num = text.try_cast("double")
            missing = F.col(c).isNull() | (text == "") | F.isnan(F.coalesce(num, F.lit(0.0)))
            ok_num = ~missing & num.isNotNull()
            checks.append(_violation(missing, "null", c))
            checks.append(_violation(~missing & num.isNull(), "numeric", c))
            if c in NON_NEGATIVE_COLUMNS:
                checks.append(_violation(ok_num & (num < 0), "non_negative", c))
            if c in RATE_COLUMNS:
                checks.append(_violation(ok_num & ~num.between(0, 1), "range_0_1", c))
            if c in INTEGER_COLUMNS:
                # beyond BIGINT (1e30, inf) a number is no integer either
                checks.append(_violation(ok_num & ((num % 1 != 0) | num.try_cast("bigint").isNull()), "integer", c))
            if c in CODE_COLUMNS:
                checks.append(_violation(ok_num & (num < 1), "positive_code", c))
            typed[c] = num.try_cast("bigint") if c in INTEGER_COLUMNS else num
        else:
            missing = F.col(c).isNull()
            checks.append(_violation(missing, "null", c))
            checks.append(_violation(~missing & ~F.col(c).isin(*DOMAINS[c]), "unknown_category", c))
            typed[c] = F.col(c)
    violations = F.filter(F.array(*checks), lambda x: x.isNotNull())
    # One struct per row, generated: later filters and joins see plain columns, so the optimizer neither copies
    # the rules into them nor derives constraints from every cell's expression (minutes for a join otherwise).
    judged = F.struct(*[v.alias(c) for c, v in typed.items()], violations.alias("violations"))
    return raw.select(*key_columns, *[F.col(c).alias(f"raw_{c}") for c in EXPECTED_COLUMNS], F.inline(F.array(judged)))


def violations_long(annotated: DataFrame, key_columns: Sequence[str]) -> DataFrame:
    """One row per (row key, column, rule) — the quarantine reason list."""
    return annotated.select(*key_columns, F.explode("violations").alias("v")).select(
        *key_columns, F.col("v.column").alias("column"), F.col("v.rule").alias("rule")
    )


def split_valid(annotated: DataFrame, key_columns: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(typed valid rows in canonical order, quarantined raw rows with their violations)."""
    ok = F.size("violations") == 0
    valid = annotated.filter(ok).select(*key_columns, *EXPECTED_COLUMNS)
    bad = annotated.filter(~ok).select(*key_columns, *[f"raw_{c}" for c in EXPECTED_COLUMNS], "violations")
    return valid, bad


def rule_summary(annotated: DataFrame) -> DataFrame:
    """Per (rule, column): rows breaking it, and how many distinct unknown values there are (B12; the values
    themselves are rows of ``unknown_categories``) — nothing here grows with the number of values."""
    v = annotated.select(F.explode("violations").alias("v"), *[F.col(f"raw_{c}") for c in DOMAINS])
    unknown_value = F.coalesce(*[F.when(F.col("v.column") == c, F.col(f"raw_{c}")) for c in DOMAINS])
    return v.groupBy(F.col("v.rule").alias("rule"), F.col("v.column").alias("column")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(F.when(F.col("v.rule") == "unknown_category", unknown_value)).alias("distinct_values"),
    )


def dataset_rules(annotated: DataFrame) -> DataFrame:
    """B3 / B13 as rows: (rule, found, broken) for 'empty' (rows) and 'two_classes' (distinct valid labels)."""
    stats = annotated.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(F.col(LABEL)).alias("classes"))
    row = lambda rule, found, broken: F.struct(F.lit(rule).alias("rule"), F.col(found).alias("found"), broken.alias("broken"))
    return stats.select(F.inline(F.array(row("empty", "rows", F.col("rows") == 0),
                                         row("two_classes", "classes", F.col("classes") != 2))))


@dataclass
class Validation:
    valid: DataFrame
    quarantine: DataFrame
    summary: DataFrame
    dataset_rules: DataFrame


def validate(raw: DataFrame, *, strict: bool = True, key_columns: Sequence[str] = (),
             materialize: bool = False) -> Validation:
    """Validate raw session rows.

    strict=True raises ContractError on the first broken rule (reference
    order); otherwise bad rows go to ``quarantine`` and only the valid rows
    continue.  The strict check runs one aggregation job (small result).
    ``materialize=True`` writes the valid and quarantine tables once under the
    shared checkpoint folder and returns readers of them — what a production
    job does, and it keeps later plans from re-deriving the rule expressions.
    """
    missing, unexpected = column_check([c for c in raw.columns if c not in key_columns])
    if missing:
        raise ContractError(f"rule missing_columns: {missing}")
    if unexpected:
        raise ContractError(f"rule unexpected_columns: {unexpected}")
    ann = annotate(raw, key_columns)
    valid, bad = split_valid(ann, key_columns)
    summary = rule_summary(ann)
    if strict:
        stats = ann.agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_distinct(F.col(LABEL)).alias("classes"),
        ).first()
        if stats["rows"] == 0:
            raise ContractError("rule empty: the input has no rows")
        broken = {(r["rule"], r["column"]): r for r in summary.collect()}  # ≤ rules × columns rows
        for rule in RULE_ORDER:
            cols = sorted(c for (ru, c) in broken if ru == rule)
            if not cols:
                continue
            if rule == "null":
                raise ContractError(f"rule null broken in {cols}")
            c = next((x for x in DOMAINS if x in cols), cols[0]) if rule == "unknown_category" else cols[0]
            r = broken[(rule, c)]
            values = f", {r['distinct_values']} distinct values" if rule == "unknown_category" else ""
            raise ContractError(f"rule {rule} broken in {c}: {r['rows']} rows{values}")
        if stats["classes"] != 2:
            raise ContractError(f"rule two_classes: {LABEL} has {stats['classes']} distinct values")
    if materialize:
        from cartwheel.session import materialize as _write

        valid, bad = _write(valid, "valid_sessions"), _write(bad, "quarantine_sessions")
    return Validation(valid, bad, summary, dataset_rules(ann))


# ---------------------------------------------------------------- fixtures


def dirty_sessions(sessions: DataFrame) -> DataFrame:
    """FIXTURES §7: sessions as text with one injected fault per fault slot.

    Slot = (user_id * 31 + day) % 50, a pure function of the row key (no
    global row numbering).  Fixed fault values: Administrative '-1',
    BounceRates '1.1', Month 'Jan', VisitorType 'Robot', Browser '0',
    ProductRelated '1.5', PageValues 'abc', Weekend 'yes', SpecialDay 'NaN', OperatingSystems '1e30',
    TrafficType 'Infinity', Informational 'NaN', ProductRelated_Duration 'Infinity',
    Region NULL; booleans as mixed-case text with blanks.
    """
    slot = (F.col("user_id") * 31 + F.dayofmonth("session_date")) % 50
    faults = {
        "Administrative": (0, F.lit("-1")), "BounceRates": (1, F.lit("1.1")), "Month": (2, F.lit("Jan")),
        "VisitorType": (3, F.lit("Robot")), "Browser": (4, F.lit("0")), "ProductRelated": (5, F.lit("1.5")),
        "PageValues": (6, F.lit("abc")), "Weekend": (7, F.lit("yes")), "SpecialDay": (8, F.lit("NaN")),
        "Region": (9, F.lit(None).cast("string")), "OperatingSystems": (10, F.lit("1e30")),
        "TrafficType": (11, F.lit("Infinity")), "Informational": (12, F.lit("NaN")),
        "ProductRelated_Duration": (13, F.lit("Infinity")),
    }
    cols = []
    for c in EXPECTED_COLUMNS:
        if c == "Weekend":
            text = F.when(F.col(c), F.lit(" true")).otherwise(F.lit("FALSE "))
        elif c == LABEL:
            text = F.when(F.col(c), F.lit("True")).otherwise(F.lit(" false"))
        else:
            text = F.col(c).cast("string")
        if c in faults:
            s, v = faults[c]
            text = F.when(slot == s, v).otherwise(text)
        cols.append(text.alias(c))
    return sessions.select("user_id", "session_date", *cols)


# ---------------------------------------------------------------- request contract

# Field kinds of the 17-field request contract.
INT_FIELDS = COUNT_COLUMNS
FLOAT_FIELDS = (*DURATION_COLUMNS, "PageValues")
RATE_FIELDS = RATE_COLUMNS
CODE_FIELDS = CODE_COLUMNS
ENUM_FIELDS = DOMAINS
BOOL_FIELDS = ("Weekend",)


def snake_name(wire: str) -> str:
    """Accepted alternative field name: CamelCase → snake_case ('ProductRelated_Duration' → 'product_related_duration')."""
    return re.sub(r"([a-z])([A-Z])", r"\1_\2", wire).lower()


def _json_kind(v: Column) -> Column:
    """int / float / bool / string / null / NULL(missing) from a VARIANT value."""
    t = F.schema_of_variant(v)
    return (
        F.when(v.isNull(), F.lit(None))
        .when(t.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "int")
        .when(t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT"), "float")
        .when(t == "BOOLEAN", "bool")
        .when(t == "STRING", "string")
        .when(t == "VOID", "null")
        .otherwise("other")
    )


def _request_rule(wire: Column, kind: Column, num: Column, text: Column, coerce: bool) -> Column:
    """The rule that a field's value breaks, or NULL."""
    finite = ~F.isnan(num) & (F.abs(num) != F.lit(float("inf")))
    if coerce:
        int_ok = num.isNotNull() & (num % 1 == 0) & (kind != "bool")
        float_ok = num.isNotNull() & (kind != "bool")
        bool_ok = (kind == "bool") | F.lower(text).isin("true", "false")
    else:
        int_ok, float_ok, bool_ok = kind == "int", kind.isin("int", "float"), kind == "bool"
    # One branch per field class (looked up from the wire name), not one per field.
    classes = {**{f: "count" for f in INT_FIELDS}, **{f: "code" for f in CODE_FIELDS},
               **{f: "amount" for f in FLOAT_FIELDS}, **{f: "rate" for f in RATE_FIELDS},
               **{f: "bool" for f in BOOL_FIELDS}, **{f: "enum" for f in ENUM_FIELDS}}
    cls = F.try_element_at(F.create_map(*[x for f, c in classes.items() for x in (F.lit(f), F.lit(c))]), wire)
    domain = F.try_element_at(F.create_map(*[x for f, vals in ENUM_FIELDS.items()
                                             for x in (F.lit(f), F.array(*[F.lit(v) for v in vals]))]), wire)
    return (
        F.when(cls.isin("count", "code"),
               F.when(~int_ok, "type").when(num < F.when(cls == "code", 1).otherwise(0), "range"))
        .when(cls.isin("amount", "rate"),
              F.when(~float_ok, "type").when(~finite, "not_finite")
              .when((num < 0) | ((cls == "rate") & (num > 1)), "range"))
        .when(cls == "bool", F.when(~bool_ok, "type"))
        .when(cls == "enum", F.when(kind != "string", "type").when(~F.array_contains(domain, text), "enum"))
    )


def request_violations(requests: DataFrame, *, id_column: str = "request_id", body: str = "body",
                       coerce: bool = False) -> DataFrame:
    """B14 (strict) / B15 (coerce=True): one row per (request id, field, rule) for bad requests.

    Bodies are parsed with ``from_json`` into MAP<STRING, VARIANT>, so JSON types stay
    visible; text that is not a JSON object gives rule ``invalid_json`` on field ``body``.
    """
    # Long form: one row per (request, JSON key) from ``from_json`` into MAP<STRING, VARIANT>
    # (VARIANT keeps the JSON type: 2 → BIGINT, 2.0 → DECIMAL, "2" → STRING).  Each value
    # is inspected once; missing fields come from one array difference per request.
    names = F.create_map(*[x for f in FEATURE_COLUMNS for x in (F.lit(f), F.lit(f), F.lit(snake_name(f)), F.lit(f))])
    parsed = requests.select(F.col(id_column), F.from_json(F.col(body), "map<string,variant>").alias("_m"))
    pairs = parsed.select(id_column, "_m", F.explode_outer("_m").alias("key", "val"))
    # Per-value facts (wire name, JSON kind, number, text) as columns; the rule below branches
    # once per field class, so each fact appears only a few times in the final expression.
    num0 = F.try_variant_get(F.col("val"), "$", "double")
    text0 = F.try_variant_get(F.col("val"), "$", "string")
    pairs = pairs.select(
        id_column, F.col("_m").isNull().alias("_bad_json"), "key",
        F.try_element_at(names, F.col("key")).alias("_wire"), _json_kind(F.col("val")).alias("_kind"),
        (F.coalesce(num0, text0.try_cast("double")) if coerce else num0).alias("_num"), text0.alias("_text"),
    )
    rule = _request_rule(F.col("_wire"), F.col("_kind"), F.col("_num"), F.col("_text"), coerce)
    wire = F.col("_wire")
    per_key = pairs.select(
        id_column,
        F.when(F.col("_bad_json"), "body").otherwise(F.coalesce(wire, F.col("key"))).alias("field"),
        F.when(F.col("_bad_json"), "invalid_json").when(wire.isNull(), "extra").otherwise(rule).alias("rule"),
    ).filter(F.col("rule").isNotNull())
    present = F.transform(F.map_keys("_m"), lambda k: F.coalesce(F.try_element_at(names, k), k))
    missing = parsed.filter(F.col("_m").isNotNull()).select(
        id_column, F.explode(F.array_except(F.array(*[F.lit(f) for f in FEATURE_COLUMNS]), present)).alias("field")
    ).select(id_column, "field", F.lit("missing").alias("rule"))
    return per_key.unionByName(missing)


def with_request_findings(requests: DataFrame, body: str = "body") -> DataFrame:
    """``requests`` with ``found``: what ``request_violations`` (strict) lists for each row's body, as an array beside the
    row, so that nothing is shuffled; of an empty object only the missing fields."""
    names = F.create_map(*[x for f in FEATURE_COLUMNS for x in (F.lit(f), F.lit(f), F.lit(snake_name(f)), F.lit(f))])

    def fact(e: Column) -> Column:
        key, val = e["key"], e["value"]
        return F.struct(key.alias("key"), F.try_element_at(names, key).alias("wire"), _json_kind(val).alias("kind"),
                        F.try_variant_get(val, "$", "double").alias("num"), F.try_variant_get(val, "$", "string").alias("text"))

    def judged(f: Column) -> Column:
        rule = _request_rule(f["wire"], f["kind"], f["num"], f["text"], coerce=False)
        return F.struct(F.coalesce(f["wire"], f["key"]).alias("column"), F.when(f["wire"].isNull(), "extra").otherwise(rule).alias("rule"))

    facts = requests.withColumn("_facts", F.transform(F.map_entries(F.from_json(body, "map<string,variant>")), fact))
    present = F.transform("_facts", lambda f: F.coalesce(f["wire"], f["key"]))
    missing = F.transform(F.array_except(F.array(*[F.lit(f) for f in FEATURE_COLUMNS]), present),
                          lambda f: F.struct(f.alias("column"), F.lit("missing").alias("rule")))
    found = F.concat(F.filter(F.transform("_facts", judged), lambda v: v["rule"].isNotNull()), missing)
    bad = F.array(F.struct(F.lit("body").alias("column"), F.lit("invalid_json").alias("rule")))
    return facts.withColumn("found", F.when(F.col("_facts").isNull(), bad).otherwise(found)).drop("_facts")


def request_bodies(sessions: DataFrame) -> DataFrame:
    """FIXTURES §5: (request_id, body) — JSON of the 17 features, with faults by slot.

    Slot = (user_id * 31 + day) % 20.  Faults (fixed): 0 Administrative -1,
    1 BounceRates 1.01, 2 Browser 0, 3 Month "Jan", 4 VisitorType "Robot",
    5 Month removed, 6 extra "SessionId", 7 Administrative 2.0, 8 Weekend "true",
    9 ProductRelated null, 10 PageValues 1e999, 11 text `bad`, 12 Month under
    its snake_case name (valid).
    """
    slot = (F.col("user_id") * 31 + F.dayofmonth("session_date")) % 20
    body = F.to_json(F.struct(*FEATURE_COLUMNS))

    def sub(field, new):
        return F.regexp_replace(body, f'"{field}":[^,}}]*', f'"{field}":{new}')

    edited = (
        F.when(slot == 0, sub("Administrative", "-1"))
        .when(slot == 1, sub("BounceRates", "1.01"))
        .when(slot == 2, sub("Browser", "0"))
        .when(slot == 3, sub("Month", '"Jan"'))
        .when(slot == 4, sub("VisitorType", '"Robot"'))
        .when(slot == 5, F.regexp_replace(body, '"Month":"[^"]*",', ""))
        .when(slot == 6, F.regexp_replace(body, "}$", ',"SessionId":"x"}'))
        .when(slot == 7, sub("Administrative", "2.0"))
        .when(slot == 8, sub("Weekend", '"true"'))
        .when(slot == 9, sub("ProductRelated", "null"))
        .when(slot == 10, sub("PageValues", "1e999"))
        .when(slot == 11, F.lit("bad"))
        .when(slot == 12, F.regexp_replace(body, '"Month":', '"month":'))
        .otherwise(body)
    )
    rid = F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("session_date", "yyyyMMdd"))
    return sessions.select(rid.alias("request_id"), edited.alias("body"))


def prediction_contract(scored: DataFrame, prob: str = "purchase_probability", threshold: str = "threshold",
                        version: str = "model_version") -> DataFrame:
    """Assertion columns on a scored table (probability and threshold in [0,1], non-empty version)."""
    return scored.withColumn(
        "output_valid",
        F.col(prob).between(0, 1) & F.col(threshold).between(0, 1) & (F.length(F.trim(F.col(version))) > 0),
    )


def dataset_vs_request_rules() -> dict[str, tuple[str, ...]]:
    """The names of the two rule sets, which stay separate."""
    return {
        "dataset": ("null", "boolean", "numeric", "non_negative", "range_0_1", "integer", "positive_code",
                    "unknown_category", "two_classes"),
        "request": ("invalid_json", "missing", "extra", "type", "not_finite", "range", "enum"),
    }


def infinite_sessions(sessions: DataFrame) -> DataFrame:
    """Sessions with infinite values: by slot = (user_id * 31 + day) % 4, ProductRelated_Duration infinite (0) or -1 (1), PageValues infinite (2)."""
    slot = (F.col("user_id") * 31 + F.dayofmonth("session_date")) % 4
    return sessions.withColumns({
        "ProductRelated_Duration": F.when(slot == 0, float("inf")).when(slot == 1, -1.0).otherwise(F.col("ProductRelated_Duration")),
        "PageValues": F.when(slot == 2, float("inf")).otherwise(F.col("PageValues"))})


def infinity_verdicts(sessions: DataFrame, keys: Sequence[str], columns: Sequence[str] = ("ProductRelated_Duration", "PageValues")) -> DataFrame:
    """The same values under both rule sets — (keys…, rule_set, column, verdict), the broken rule or ``passes``.

    As a data row an infinite duration passes (the rule there is only ``< 0``); as a request body (JSON has no
    infinity: 1e999 is read as one) it is ``not_finite``.
    """
    def member(c: str) -> Column:
        plain = F.regexp_replace(F.to_json(F.struct(c)), r"^\{|\}$", "")
        return F.when(F.col(c) == float("inf"), F.lit(f'"{c}":1e999')).otherwise(plain) if c in columns else plain

    body = F.concat(F.lit("{"), F.concat_ws(",", *[member(c) for c in FEATURE_COLUMNS]), F.lit("}"))
    # both rule sets judge a row where it is: one pass over the sessions, no join
    asked = with_request_findings(sessions.withColumn("_body", body), "_body").withColumnRenamed("found", "_asked")
    text = asked.select(*keys, "_asked", *[F.col(c).cast("string").alias(c) for c in EXPECTED_COLUMNS])
    judged = annotate(text, [*keys, "_asked"])
    sets = F.array(*[F.struct(F.lit(name).alias("rule_set"), F.col(found).alias("found")) for name, found in (("dataset", "violations"), ("request", "_asked"))])
    both = judged.select(*keys, F.explode(sets).alias("s")).select(*keys, "s.rule_set", F.explode(F.lit([*columns])).alias("column"), "s.found")
    met = F.get(F.filter("found", lambda v: v["column"] == F.col("column")), F.lit(0))["rule"]
    return both.select(*keys, "rule_set", "column", F.coalesce(met, F.lit("passes")).alias("verdict"))


def unknown_categories(raw: DataFrame, domains: dict[str, Sequence[str]] = DOMAINS) -> DataFrame:
    """(column, value) of category values outside the domain — distinct values
    anti-joined with the domain table (a fixed, tiny table: broadcast)."""
    spark = raw.sparkSession
    dom = spark.createDataFrame([(c, v) for c, vals in domains.items() for v in vals], "column string, value string")
    seen = None
    for c in domains:
        d = raw.select(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")).filter(
            F.col("value").isNotNull()).distinct()
        seen = d if seen is None else seen.unionByName(d)
    return seen.join(F.broadcast(dom), ["column", "value"], "left_anti")
