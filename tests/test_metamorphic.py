"""Metamorphic checks: duplicating every row, shuffling or repartitioning leaves rates and curve metrics unchanged."""

from pyspark.sql import functions as F

from cartwheel.operators import evaluate as H
from cartwheel.operators import quality as Q
from cartwheel.plans.eval_queries import scored_sessions
from cartwheel.sources.sessions import load_sessions
from tests.conftest import SF_SMALL


def _rates(df):
    return sorted((r["section"], r["key"], r["conversion_rate"]) for r in Q.conversion_by_context(df).collect())


def test_duplicating_rows_keeps_rates(spark):
    s = load_sessions(spark, SF_SMALL)
    assert _rates(s) == _rates(s.unionByName(s))


def test_duplicating_and_repartitioning_keeps_curve_metrics(spark):
    s = scored_sessions(spark, SF_SMALL)
    a = H.metric_record(s).first().asDict()
    b = H.metric_record(s.unionByName(s).repartition(17)).first().asDict()
    c = H.metric_record(s.repartition(1).orderBy(F.rand(3))).first().asDict()
    for k in ("threshold", "roc_auc", "pr_auc", "precision", "recall", "f1", "brier_score"):
        assert a[k] == b[k] == c[k], k
    assert b["true_positive"] == 2 * a["true_positive"]
