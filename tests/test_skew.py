"""Hot keys: one value holding a third (or more) of all rows must not change results."""

from pyspark.sql import functions as F

from cartwheel.operators import evaluate as H
from cartwheel.operators import quality as Q
from cartwheel.operators import split as G
from cartwheel.plans.eval_queries import scored_sessions
from cartwheel.schema import KEY_COLUMNS
from cartwheel.sources.sessions import load_sessions, sessions_from_events
from cartwheel.sources.tables import read_table
from tests.conftest import SF_SMALL


def test_hot_duplicate_group(spark):
    s = load_sessions(spark, SF_SMALL)
    n = s.count()
    hot = s.limit(1).select("*", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("_c")).drop("_c")
    both = s.unionByName(hot)  # one identical row now holds more than half of all rows
    r = Q.duplicate_report(both).first()
    assert r["rows"] == 2 * n and r["extra_copies"] >= n and r["rows_in_groups"] >= n + 1
    d = Q.dataset_summary(both.drop(*KEY_COLUMNS)).first()
    assert d["rows"] == 2 * n and d["duplicate_rows"] >= n


def test_hot_score_value(spark):
    s = scored_sessions(spark, SF_SMALL, split=False, prior=False)
    n = s.count()
    # a third of the rows share one score
    hot = s.withColumn("score", F.when(F.col("user_id") % 3 == 0, F.lit(0.5)).otherwise(F.col("score")))
    rec = H.metric_record(hot).first()
    pts = H.pr_points(hot).agg(F.max("tp").alias("tp"), F.max("fp").alias("fp")).first()
    assert pts["tp"] + pts["fp"] == n
    assert 0.0 <= rec["roc_auc"] <= 1.0 and rec["true_positive"] + rec["false_negative"] == hot.filter("label").count()


def test_hot_user_events(spark):
    ev = read_table(spark, SF_SMALL, "events")
    n = ev.count()
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("user_id")))
    s = sessions_from_events(hot)
    # the hot user has at most one session per day; every event is counted exactly once
    assert s.filter(F.col("user_id") == 7).count() <= 31
    tot = s.agg(F.sum(F.col("Administrative") + F.col("Informational") + F.col("ProductRelated")).alias("t")).first()
    per_type = hot.filter(F.col("event_type").isin("signup", "error", "view", "click")).count()
    assert tot["t"] == per_type and n > 0


def test_hot_label_split_quotas(spark):
    s = load_sessions(spark, SF_SMALL)
    many = s.withColumn("Revenue", F.col("user_id") % 10 != 0)  # 90% one class
    sp = G.stratified_split(many)
    c = {(r["split"], r["Revenue"]): r["n"] for r in sp.groupBy("split", "Revenue").agg(F.count("*").alias("n")).collect()}
    for lab in (True, False):
        tot = sum(v for (x, y), v in c.items() if y == lab)
        assert abs(c[("train", lab)] - 0.6 * tot) <= 1
    assert sp.select(*KEY_COLUMNS).distinct().count() == s.count()
