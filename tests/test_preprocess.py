from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cartwheel.operators import preprocess as P
from cartwheel.operators.features import FEATURE_SETS
from cartwheel.plans.feature_queries import split_sessions
from tests.conftest import SF_SMALL


def test_unknown_category_is_zero_vector_with_same_width(spark):
    s = split_sessions(spark, SF_SMALL)
    train = s.filter(F.col("split") == "train")
    num, cat = FEATURE_SETS["base_with_page_values"].values()
    model = Pipeline(stages=P.ml_preprocessor(num, cat)).fit(train)
    known = model.transform(train.limit(1)).select(vector_to_array("features").alias("v")).first()["v"]
    odd = train.limit(1).withColumn("OperatingSystems", F.lit(99)).withColumn("VisitorType", F.lit("Unknown_Visitor"))
    out = model.transform(odd)
    v = out.select(vector_to_array("OperatingSystems__oh").alias("v")).first()["v"]
    assert len(v) > 0 and sum(v) == 0.0
    assert len(out.select(vector_to_array("features").alias("v")).first()["v"]) == len(known)


def test_without_page_values_drops_the_column():
    num, cat = FEATURE_SETS["base_without_page_values"].values()
    assert "PageValues" not in num and len(num) == 9 and len(cat) == 7


def test_class_weights_balanced(spark):
    df = spark.createDataFrame([(True,), (False,), (False,), (False,)], "Revenue boolean")
    w = {r["label"]: (r["balanced_weight"], r["scale_pos_weight"]) for r in P.class_weights(df).collect()}
    assert w["true"][0] == 2.0 and abs(w["false"][0] - 4 / 6) < 1e-6 and w["true"][1] == 3.0
