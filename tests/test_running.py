import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwheel.operators.running import hex_prefix_bucket, quantile_bucket, row_numbers, running_sums


def test_running_sums_equal_plain_window(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice("ab"), i, rnd.random(), rnd.randint(0, 5)) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, id long, s double, x long").repartition(7)
    out = running_sums(df, bucket=quantile_bucket(df, "s", 9, descending=True), order=[F.desc("s"), F.col("id")],
                       sums=["x"], partition_by=["g"])
    w = Window.partitionBy("g").orderBy(F.desc("s"), "id").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.withColumn("ref", F.sum("x").over(w))
    j = out.join(ref, ["g", "id"])
    assert j.count() == 500
    assert j.filter(F.col("x_cum") != F.col("ref")).count() == 0


def test_row_numbers_dense_and_repartition_invariant(spark):
    df = spark.range(0, 1000).withColumn("h", F.md5(F.col("id").cast("string")))
    a = row_numbers(df.repartition(1), bucket=hex_prefix_bucket(F.col("h")), order=[F.col("h")])
    b = row_numbers(df.repartition(17), bucket=hex_prefix_bucket(F.col("h")), order=[F.col("h")])
    assert sorted(r["rn"] for r in a.collect()) == list(range(1, 1001))
    assert a.join(b, ["id", "h", "rn"]).count() == 1000


def test_materialised_tables_can_be_deleted(spark):
    import os

    from cartwheel import session

    one, two = (session.materialize(spark.range(n), "t") for n in (3, 0))
    folder = os.path.dirname(one.inputFiles()[0]).removeprefix("file://").removeprefix("file:")
    assert (one.count(), two.count(), two.columns) == (3, 0, ["id"]) and os.path.isdir(folder)
    session.discard(one)
    assert not os.path.exists(folder)
    top = session._tables_folder(spark).removeprefix("file:")
    assert os.listdir(top)
    session.release_tables(spark)
    assert not os.path.exists(top)


def test_jobs_run_concurrently_in_order(spark):
    from cartwheel.session import concurrently

    assert concurrently([lambda n=n: spark.range(n).count() for n in (5, 1, 3)], 3) == [5, 1, 3]
