"""The same statistics computed by pandas / numpy on the collected sessions (the reference's own
libraries' semantics) agree with the Spark operators."""

import numpy as np
import pandas as pd
import pytest

from cartwheel.operators import evaluate as H
from cartwheel.operators import quality as Q
from cartwheel.plans.eval_queries import scored_sessions
from cartwheel.schema import EXPECTED_COLUMNS
from cartwheel.sources.sessions import load_sessions
from tests.conftest import SF_MID


@pytest.fixture(scope="module")
def sessions(spark):
    s = load_sessions(spark, SF_MID).select(*EXPECTED_COLUMNS)
    return s, s.toPandas()


def test_describe_matches_pandas(sessions):
    s, pdf = sessions
    got = {r["column"]: r for r in Q.describe_numeric(s).collect()}
    for c in Q.NUMERIC_DESCRIBE_COLUMNS:
        d = pdf[c].astype("float64").describe()
        r = got[c]
        assert r["count"] == d["count"] and r["min"] == d["min"] and r["max"] == d["max"]
        for mine, theirs in (("mean", "mean"), ("std", "std"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%")):
            assert r[mine] == pytest.approx(round(d[theirs], 6), abs=1.5e-6), (c, mine)


def test_tail_quantiles_match_pandas(sessions):
    s, pdf = sessions
    cols = ("Administrative_Duration", "ProductRelated_Duration")
    got = {r["column"]: r for r in Q.tail_quantiles(s, cols).collect()}
    for c in cols:
        p99 = pdf[c].quantile(0.99)
        assert got[c]["p99"] == pytest.approx(round(p99, 6), abs=1.5e-6)
        assert got[c]["p999"] == pytest.approx(round(pdf[c].quantile(0.999), 6), abs=1.5e-6)
        assert got[c]["above_p99"] == int((pdf[c] > p99).sum())


def test_value_counts_duplicates_and_rates_match_pandas(sessions):
    s, pdf = sessions
    vc = pdf["TrafficType"].value_counts(normalize=True)
    got = {r["value"]: r["share"] for r in Q.value_counts(s, "TrafficType").collect()}
    assert all(got[k] == pytest.approx(v, abs=1e-6) for k, v in vc.items())
    summ = Q.dataset_summary(s).first()
    assert summ["duplicate_rows"] == int(pdf.duplicated().sum())
    for rep, proj in ((Q.duplicate_report(s).first(), list(Q.EXPECTED_COLUMNS)),
                      (Q.duplicate_report(s, Q.DUPLICATE_COLUMNS).first(), list(Q.DUPLICATE_COLUMNS))):
        assert rep["extra_copies"] == int(pdf[proj].duplicated().sum())
        assert rep["rows_in_groups"] == int(pdf[proj].duplicated(keep=False).sum())
    conv = {(r["section"], r["key"]): r["conversion_rate"] for r in Q.conversion_by_context(s).collect()}
    for k, v in pdf.groupby("Month")["Revenue"].mean().items():
        assert conv[("Month", k)] == pytest.approx(v, abs=1e-6)
    for k, v in pdf.groupby("Weekend")["Revenue"].mean().items():
        assert conv[("Weekend", str(k).lower())] == pytest.approx(v, abs=1e-6)


def test_reliability_matches_numpy_quantile_bins(spark):
    s = scored_sessions(spark, SF_MID, split=False, prior=False)
    pdf = s.select("label", "score").toPandas()
    y, p = pdf["label"].to_numpy().astype(float), pdf["score"].to_numpy()
    edges = np.percentile(p, np.linspace(0, 1, 11) * 100)
    ids = np.searchsorted(edges[1:-1], p)
    got = {r["bin"]: r for r in H.reliability_curve(s).collect()}
    for b in np.unique(ids):
        m = ids == b
        assert got[int(b)]["rows"] == int(m.sum())
        assert got[int(b)]["fraction_positive"] == pytest.approx(y[m].mean(), abs=1e-6)
        assert got[int(b)]["mean_predicted"] == pytest.approx(p[m].mean(), abs=1e-6)
    assert len(got) == len(np.unique(ids))


def test_box_whiskers_match_numpy(sessions):
    s, pdf = sessions
    got = {(r["column"], r["label"]): r for r in Q.box_summary(s, ("ExitRates",)).collect()}
    for lab, grp in pdf.groupby("Revenue"):
        v = grp["ExitRates"].to_numpy()
        q1, q3 = np.percentile(v, [25, 75])
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = v[(v >= lo) & (v <= hi)]
        r = got[("ExitRates", str(lab).lower())]
        assert r["whisker_low"] == inside.min() and r["whisker_high"] == inside.max()
        assert r["q1"] == pytest.approx(round(q1, 6), abs=1.5e-6)
