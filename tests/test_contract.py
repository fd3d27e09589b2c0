import pytest
from pyspark.sql import functions as F

from cartwheel.functions.expr import parse_bool
from cartwheel.operators import contract as C
from cartwheel.schema import EXPECTED_COLUMNS, KEY_COLUMNS
from cartwheel.sources.sessions import load_sessions
from tests.conftest import SF_SMALL

VALID_A = dict(Administrative="1", Administrative_Duration="1.0", Informational="1", Informational_Duration="1.0",
               ProductRelated="1", ProductRelated_Duration="1.0", BounceRates="0.2", ExitRates="0.2",
               PageValues="0.0", SpecialDay="0.0", Month="Feb", OperatingSystems="1", Browser="1", Region="1",
               TrafficType="1", VisitorType="Returning_Visitor", Weekend="FALSE", Revenue="FALSE")
VALID_B = dict(VALID_A, Month="Nov", VisitorType="New_Visitor", OperatingSystems="2", Browser="2", Region="2",
               TrafficType="3", PageValues="20", Weekend="TRUE", Revenue="TRUE")


def frame(spark, rows, columns=EXPECTED_COLUMNS):
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows],
                                 ", ".join(f"{c} string" for c in columns))


def test_parse_bool_is_strict(spark):
    df = spark.createDataFrame([("TRUE",), (" false ",), ("True",), ("yes",), ("1",), ("",)], "v string")
    got = [r[0] for r in df.select(parse_bool("v")).collect()]
    assert got == [True, False, True, None, None, None]


def test_valid_frame_is_typed(spark):
    v = C.validate(frame(spark, [VALID_A, VALID_B]), strict=True)
    rows = v.valid.collect()
    assert len(rows) == 2 and rows[1]["Revenue"] is True and rows[0]["Administrative"] == 1
    assert dict(v.valid.dtypes)["Administrative"] == "bigint"


@pytest.mark.parametrize("drop,extra,msg", [("Revenue", None, "missing_columns"), ("Month", None, "missing_columns"),
                                            (None, "SessionId", "unexpected_columns")])
def test_missing_and_extra_columns(spark, drop, extra, msg):
    cols = [c for c in EXPECTED_COLUMNS if c != drop] + ([extra] if extra else [])
    rows = [dict(VALID_A, SessionId="x"), dict(VALID_B, SessionId="y")]
    with pytest.raises(C.ContractError, match=msg):
        C.validate(frame(spark, rows, cols), strict=True)


@pytest.mark.parametrize("column,value,msg", [
    ("Administrative", "-1", "non_negative"),
    ("BounceRates", "1.1", "range_0_1"),
    ("SpecialDay", "-0.1", "range_0_1"),
    ("Month", "Jan", "unknown_category broken in .* 1 distinct"),
    ("VisitorType", "Robot", "unknown_category broken in .* 1 distinct"),
    ("ProductRelated", "1.5", "integer broken in ProductRelated"),
    ("Browser", "0", "positive_code"),
    ("PageValues", "abc", "numeric broken"),
    ("Weekend", "yes", "boolean"),
    ("Region", None, "rule null"),
])
def test_bad_values_raise_first_rule(spark, column, value, msg):
    with pytest.raises(C.ContractError, match=msg):
        C.validate(frame(spark, [dict(VALID_A, **{column: value}), VALID_B]), strict=True)


def test_single_class_raises(spark):
    with pytest.raises(C.ContractError, match="two_classes"):
        C.validate(frame(spark, [VALID_A, dict(VALID_B, Revenue="FALSE")]), strict=True)


def test_empty_raises(spark):
    with pytest.raises(C.ContractError, match="rule empty"):
        C.validate(frame(spark, [VALID_A]).limit(0), strict=True)


def test_quarantine_agrees_with_strict(spark):
    dirty = C.dirty_sessions(load_sessions(spark, SF_SMALL))
    v = C.validate(dirty, strict=False, key_columns=KEY_COLUMNS, materialize=True)
    n, good, bad = dirty.count(), v.valid.count(), v.quarantine.count()
    assert good + bad == n and bad > 0
    # every quarantined row has a reason; valid rows pass strict validation on their own
    assert v.quarantine.filter(F.size("violations") == 0).count() == 0
    typed_again = v.valid.select(*KEY_COLUMNS, *[F.col(c).cast("string").alias(c) for c in EXPECTED_COLUMNS])
    assert C.validate(typed_again, strict=True, key_columns=KEY_COLUMNS).valid.count() == good
    with pytest.raises(C.ContractError):
        C.validate(dirty, strict=True, key_columns=KEY_COLUMNS)


PAYLOAD = ('{"Administrative": 2, "Administrative_Duration": 35.5, "Informational": 1, '
           '"Informational_Duration": 12.0, "ProductRelated": 12, "ProductRelated_Duration": 420.0, '
           '"BounceRates": 0.01, "ExitRates": 0.03, "PageValues": 18.5, "SpecialDay": 0.0, "Month": "Nov", '
           '"OperatingSystems": 2, "Browser": 2, "Region": 1, "TrafficType": 3, '
           '"VisitorType": "Returning_Visitor", "Weekend": false}')


def _rules(spark, bodies):
    df = spark.createDataFrame([(str(i), b) for i, b in enumerate(bodies)], "request_id string, body string")
    out = {}
    for r in C.request_violations(df).collect():
        out.setdefault(int(r["request_id"]), set()).add((r["field"], r["rule"]))
    return [out.get(i, set()) for i in range(len(bodies))]


def test_request_contract_accepts_valid_and_snake_case(spark):
    snake = PAYLOAD.replace('"ProductRelated_Duration"', '"product_related_duration"')
    assert _rules(spark, [PAYLOAD, snake]) == [set(), set()]


@pytest.mark.parametrize("old,new,expected", [
    ('"Administrative": 2', '"Administrative": -1', ("Administrative", "range")),
    ('"Administrative_Duration": 35.5', '"Administrative_Duration": -0.1', ("Administrative_Duration", "range")),
    ('"BounceRates": 0.01', '"BounceRates": 1.01', ("BounceRates", "range")),
    ('"SpecialDay": 0.0', '"SpecialDay": 1e999', ("SpecialDay", "not_finite")),
    ('"OperatingSystems": 2', '"OperatingSystems": 0', ("OperatingSystems", "range")),
    ('"Month": "Nov"', '"Month": "Jan"', ("Month", "enum")),
    ('"VisitorType": "Returning_Visitor"', '"VisitorType": "Robot"', ("VisitorType", "enum")),
    ('"Administrative": 2', '"Administrative": 2.0', ("Administrative", "type")),
    ('"Weekend": false', '"Weekend": "false"', ("Weekend", "type")),
    ('"Month": "Nov", ', '', ("Month", "missing")),
    ('"Weekend": false}', '"Weekend": false, "SessionId": "x"}', ("SessionId", "extra")),
])
def test_request_contract_rejects(spark, old, new, expected):
    body = PAYLOAD.replace(old, new)
    assert body != PAYLOAD
    assert _rules(spark, [body]) == [{expected}]


def test_invalid_json(spark):
    assert _rules(spark, ["bad"]) == [{("body", "invalid_json")}]


def test_coerce_mode_accepts_text_numbers(spark):
    df = spark.createDataFrame([("0", PAYLOAD.replace('"Administrative": 2', '"Administrative": "2"')
                                 .replace('"Weekend": false', '"Weekend": "true"'))], "request_id string, body string")
    assert C.request_violations(df, coerce=True).count() == 0
    assert C.request_violations(df, coerce=False).count() == 2


def test_valid_rows_plan_in_joins_and_set_operations(spark):
    """The rules are not copied into what is built on the valid rows, so that planning stays short."""
    import time

    raw = C.dirty_sessions(load_sessions(spark, SF_SMALL))
    valid = C.validate(raw, strict=False, key_columns=KEY_COLUMNS).valid
    for out in (valid.exceptAll(valid.limit(0)), valid.join(valid.select(*KEY_COLUMNS), list(KEY_COLUMNS)), valid.intersect(valid)):
        begun = time.time()
        out._jdf.queryExecution().executedPlan()
        assert time.time() - begun < 5
