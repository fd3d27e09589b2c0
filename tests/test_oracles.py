"""Every registered query of the library (those of the optional parts are tested in tests/llm) with an oracle agrees with DuckDB on the small fixture (driver-style check)."""

import math

import duckdb
import pytest

import __spark_entry__
from cartwheel.plans import registry as E
from cartwheel.sources.tables import TABLES
from tests.conftest import SF_SMALL

NAMES = sorted(E.oracle_sql())


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_oracle_or_is_rows_only():
    rows_only = set(E.queries()) - set(E.oracle_sql())
    assert rows_only <= {"production_candidates_validation", "engineered_sweep_validation", "calibrated_scores_check",
                         "stacking_validation", "cv_search_validation", "focal_refit_validation"}


@pytest.mark.parametrize("name", NAMES)
def test_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = [c.lower() for c in df.columns]
    got = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    ocols = [c.lower() for c in rel.columns]
    exp = rel.fetchall()
    assert sorted(cols) == sorted(ocols)
    def canon(cs, rows):
        order = sorted(range(len(cs)), key=lambda i: cs[i])
        return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)
    assert canon(cols, got) == canon(ocols, exp)


def test_entry_smoke(spark):
    df = __spark_entry__.entry(spark)
    assert df.count() > 0
