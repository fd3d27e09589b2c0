"""Property-based checks (hypothesis): evaluation vs brute force; approximate vs exact paths."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartwheel.operators import evaluate as H
from cartwheel.operators import monitor as MON
from cartwheel.operators import quality as Q
from cartwheel.sources.sessions import load_sessions
from cartwheel.sources.tables import read_table
from tests.conftest import SF_SMALL
from tests.test_evaluate import brute, scored

rows = st.lists(st.tuples(st.booleans(), st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0])),
                min_size=4, max_size=60).filter(lambda r: 0 < sum(y for y, _ in r) < len(r))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows)
def test_metric_record_matches_brute_force(spark, data):
    labels = [y for y, _ in data]
    scores = [s for _, s in data]
    ap, auc, (th, f1) = brute(labels, scores)
    rec = H.metric_record(scored(spark, labels, scores)).first()
    assert rec["pr_auc"] == pytest.approx(ap, abs=1e-6)
    assert rec["roc_auc"] == pytest.approx(auc, abs=1e-6)
    assert rec["threshold"] == pytest.approx(th) and rec["f1"] == pytest.approx(f1, abs=1e-6)
    assert rec["true_positive"] + rec["false_negative"] == sum(labels)


def test_approximate_paths_close_to_exact(spark):
    s = load_sessions(spark, SF_SMALL)
    ex = {r["column"]: r for r in Q.describe_numeric(s).collect()}
    ap = {r["column"]: r for r in Q.describe_numeric(s, exact=False).collect()}
    for c in ex:
        lo, hi = ex[c]["min"], ex[c]["max"]
        for k in ("p25", "p50", "p75"):
            assert abs(ex[c][k] - ap[c][k]) <= 0.02 * (hi - lo) + 1e-9, (c, k)
    log = MON.access_log_from_events(read_table(spark, SF_SMALL, "events"))
    a = {(r["route"], r["status"]): r["p95_ms"] for r in MON.route_latency(log).collect()}
    b = {(r["route"], r["status"]): r["p95_ms"] for r in MON.route_latency(log, exact=False).collect()}
    spread = log.agg(F.max("duration_ms") - F.min("duration_ms")).first()[0]
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) <= 0.05 * spread for k in a)
    d1 = {r["column"]: r["n_distinct"] for r in Q.distinct_counts(s).collect()}
    d2 = {r["column"]: r["n_distinct"] for r in Q.distinct_counts(s, exact=False).collect()}
    assert all(abs(d1[c] - d2[c]) <= max(1, 0.1 * d1[c]) for c in d1)
