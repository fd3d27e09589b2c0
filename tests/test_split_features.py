from pyspark.sql import functions as F

from cartwheel.operators import features as FE
from cartwheel.operators import split as G
from cartwheel.schema import KEY_COLUMNS
from cartwheel.sources.sessions import load_sessions
from tests.conftest import SF_MID


def test_split_sizes_disjoint_deterministic_stratified(spark):
    s = load_sessions(spark, SF_MID)
    a = G.stratified_split(s).select(*KEY_COLUMNS, "split", "Revenue")
    b = G.stratified_split(s.repartition(13)).select(*KEY_COLUMNS, "split", "Revenue")
    assert a.exceptAll(b).count() == 0
    sizes = {(r["split"], r["Revenue"]): r["n"] for r in a.groupBy("split", "Revenue").agg(F.count("*").alias("n")).collect()}
    for label in (True, False):
        n = sum(v for (sp, lab), v in sizes.items() if lab == label)
        assert abs(sizes[("train", label)] - 0.6 * n) <= 1
        assert abs(sizes[("validation", label)] - 0.2 * n) <= 1
    fr = G.split_frames(a.select(*KEY_COLUMNS, "split"))
    assert fr["train"].intersect(fr["test"]).count() == 0
    assert fr["validation"].intersect(fr["test"]).count() == 0


def test_feature_sets_shapes():
    shapes = {k: (len(v["numeric"]), len(v["categorical"])) for k, v in FE.FEATURE_SETS.items()}
    assert shapes == {"base_with_page_values": (10, 7), "base_without_page_values": (9, 7),
                      "engineered_full": (20, 10), "engineered_reduced": (20, 7),
                      "engineered_without_page_values": (18, 10)}
    assert "PageValues" not in FE.columns_without("PageValues")


def test_safe_ratios_and_unknown_codes(spark):
    s = load_sessions(spark, SF_MID)
    freq = spark.createDataFrame([(1,)], "TrafficType long")
    e = FE.engineer(s, freq)
    zero = e.filter(F.col("total_pageviews") == 0)
    assert zero.count() > 0
    assert zero.filter(F.col("avg_duration_per_page") != 0).count() == 0
    codes = {r[0] for r in e.select("traffic_type_grouped").distinct().collect()}
    assert codes == {"1", "-1"}
    assert {r[0] for r in e.select("is_weekend_returning").distinct().collect()} <= {"True", "False"}


def test_hash_mode_split_is_map_only_and_close(spark):
    s = load_sessions(spark, SF_MID)
    h = G.stratified_split(s, mode="hash")
    plan = h._jdf.queryExecution().executedPlan().toString()
    assert "Window [row_number" not in plan and "_bucket" not in plan
    n = s.count()
    counts = {r["split"]: r["n"] for r in h.groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert abs(counts["train"] / n - 0.6) < 0.03 and abs(counts["test"] / n - 0.2) < 0.03
    again = G.stratified_split(s.repartition(5), mode="hash").select(*KEY_COLUMNS, "split")
    assert h.select(*KEY_COLUMNS, "split").exceptAll(again).count() == 0


def test_join_on_keeps_null_keys(spark):
    from cartwheel.operators.joins import join_on

    a = spark.createDataFrame([(1, "x"), (None, "y")], "k int, a string")
    b = spark.createDataFrame([(None, 9), (1, 7)], "k int, b int")
    assert sorted((r.a, r.b) for r in join_on(a, b, "k", "inner").collect()) == [("x", 7), ("y", 9)]


def _by_rank(df, seed, fractions, label, keys):
    """Plain version: rank inside the class over the order hash."""
    from pyspark.sql import Window

    w = Window.partitionBy(label)
    ranked = df.withColumn("_rn", F.row_number().over(w.orderBy(G.order_hash(seed, keys), *keys))).withColumn("_n", F.count("*").over(w))
    return ranked.withColumn("want", sum((F.col("_rn") > F.floor(F.lit(f) * F.col("_n") + 0.5)).cast("int") for f in fractions))


def test_cut_hashes_equal_ranks_at_every_depth(spark, monkeypatch):
    df = spark.range(3000).select("id", F.when(F.col("id") % 50 == 0, None).when(F.col("id") % 3 == 0, "rare").when(F.col("id") == 1, "one").otherwise("hot").alias("y"))
    fractions = [0.0, 0.1, 0.6, 0.8, 1.0]
    for digits, fits in ((4, 100_000), (1, 5), (2, 1)):
        monkeypatch.setattr(G, "PREFIX_DIGITS", digits)
        monkeypatch.setattr(G, "PREFIX_FITS", fits)
        cuts = G.class_cuts(df, fractions, 7, "y", ["id"])
        assert set(cuts) == {None, "rare", "one", "hot"}
        got = _by_rank(df, 7, fractions, "y", ["id"])
        got = got.withColumn("got", sum((~G._before(cuts, i, G.order_hash(7, ["id"]), "y")).cast("int") for i in range(len(fractions))))
        assert got.where("got <> want").count() == 0


def test_rows_with_equal_keys_go_together(spark):
    df = spark.createDataFrame([(i // 10, True) for i in range(200)], "id long, y boolean")
    got = G.stratified_split(df, label="y", key_columns=["id"]).groupBy("id").agg(F.count_distinct("split").alias("n"))
    assert got.where("n <> 1").count() == 0
    assert G.halves(df.limit(0), label="y", key_columns=["id"]).collect() == []


def test_quota_split_moves_no_row(spark, tmp_path):
    load_sessions(spark, SF_MID).write.parquet(f"{tmp_path}/s")
    s = spark.read.parquet(f"{tmp_path}/s")
    for out in (G.stratified_split(s), G.halves(s)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Sort" not in plan and "Window" not in plan
