import pytest
from pyspark.sql import functions as F

from cartwheel.operators import quality as Q
from cartwheel.operators import ranking as K
from cartwheel.schema import MONTH_ORDER
from cartwheel.sources import reports


def test_duplicates_reported_not_dropped(spark):
    rows = [(1, "Feb", True), (2, "Nov", False), (1, "Feb", True)]
    df = spark.createDataFrame(rows, "a long, Month string, Revenue boolean")
    s = Q.dataset_summary(df, columns=df.columns).first()
    assert (s["rows"], s["duplicate_rows"], s["positive_count"]) == (3, 1, 2)
    assert s["positive_rate"] == pytest.approx(2 / 3, abs=1e-6)
    assert df.count() == 3


def test_conversion_rates_and_boolean_keys(spark):
    rows = [("Nov", "New_Visitor", False, 1, False), ("Nov", "Returning_Visitor", True, 2, True),
            ("Feb", "Returning_Visitor", False, 2, True)]
    df = spark.createDataFrame(rows, "Month string, VisitorType string, Weekend boolean, TrafficType long, "
                                     "Revenue boolean")
    got = {(r["section"], r["key"]): r["conversion_rate"] for r in Q.conversion_by_context(df).collect()}
    assert got[("Month", "Nov")] == 0.5 and got[("VisitorType", "New_Visitor")] == 0.0
    assert got[("Weekend", "false")] == 0.5 and got[("Weekend", "true")] == 1.0
    m = {r["Month"]: r["sessions"] for r in Q.conversion_by_month(df, MONTH_ORDER).collect()}
    assert len(m) == 10 and m["Mar"] is None and m["Nov"] == 2


def test_signal_means_and_missing(spark):
    rows = [(0.1, 0.2, 0.0, False), (0.1, 0.2, 0.0, False), (0.0, 0.1, 20.0, True)]
    df = spark.createDataFrame(rows, "BounceRates double, ExitRates double, PageValues double, Revenue boolean")
    got = {(r["column"], r["label"]): r["mean"] for r in Q.signal_means_by_label(df).collect()}
    assert got[("PageValues", "true")] == 20.0 and got[("BounceRates", "false")] == 0.1
    assert all(r["missing"] == 0 for r in Q.missing_counts(df).collect())


def test_champion_tie_goes_to_name(spark):
    runs = spark.createDataFrame([("random_forest", 0.7, 0.8), ("logistic_regression", 0.7, 0.8),
                                  ("dummy", 0.1, 0.5)], "run_name string, f1 double, pr_auc double")
    assert K.champion(runs).first()["run_name"] == "logistic_regression"
    with pytest.raises(ValueError):
        K.champion(runs.drop("f1"))


def test_report_is_one_sorted_document(spark, tmpdir_path):
    """Byte for byte what the reference's own test expects of its report writer."""
    path = f"{tmpdir_path}/deep/summary.json"
    df = spark.createDataFrame([("z", 1), ("a", 2)], "path string, value long").repartition(2)
    reports.write_report(df, path)
    assert open(path).read() == '{\n  "a": 2,\n  "z": 1\n}\n'
    assert reports.read_report(spark, path).collect()[0].asDict() == {"a": 2, "z": 1}
    nested = spark.createDataFrame([("test.f1", 0.5), ("validation.f1", 0.75), ("test.auc", None)], "path string, value double")
    reports.write_report(nested, f"file:{path}")
    assert open(path).read() == '{\n  "test": {\n    "auc": null,\n    "f1": 0.5\n  },\n  "validation": {\n    "f1": 0.75\n  }\n}\n'
    assert reports.read_report(spark, path).select("validation.f1").first()[0] == 0.75


@pytest.mark.parametrize("rows", [[("a", 1), ("a", 2)], [("a", 1), ("a.b", 2)], [("x.y", 1), ("x", 2)]])
def test_failed_report_leaves_the_old_document(spark, tmpdir_path, rows):
    import os

    path = f"{tmpdir_path}/r.json"
    reports.write_report(spark.createDataFrame([("a", 7)], "path string, value long"), path)
    with pytest.raises(Exception, match="twice|through a value"):
        reports.write_report(spark.createDataFrame(rows, "path string, value long"), path)
    assert open(path).read() == '{\n  "a": 7\n}\n' and os.listdir(tmpdir_path) == ["r.json"]


def test_failing_task_aborts_the_report(spark, tmpdir_path):
    import os

    from pyspark.sql import functions as F

    path = f"{tmpdir_path}/r.json"
    bad = spark.range(4).select(F.col("id").cast("string").alias("path"), F.when(F.col("id") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("value"))
    with pytest.raises(Exception, match="broken"):
        reports.write_report(bad, path)
    assert os.listdir(tmpdir_path) == []


def test_value_counts_order(spark):
    df = spark.createDataFrame([(x,) for x in [1, 2, 2, 3, 3, 3]], "TrafficType long")
    r = Q.value_counts(df, "TrafficType").collect()
    assert [x["value"] for x in r] == [3, 2, 1] and r[0]["share"] == 0.5


def test_histogram_matches_numpy(spark):
    import numpy as np

    from cartwheel.sources.sessions import load_sessions
    from tests.conftest import SF_MID

    s = load_sessions(spark, SF_MID)
    got = {(r["column"], r["bin"]): r["count"] for r in Q.equal_width_histogram(s).collect()}
    pdf = s.select(*Q.HISTOGRAM_COLUMNS).toPandas()
    for c in Q.HISTOGRAM_COLUMNS:
        counts, _ = np.histogram(pdf[c].to_numpy(), bins=30)
        assert [got.get((c, k), 0) for k in range(30)] == list(counts), c
