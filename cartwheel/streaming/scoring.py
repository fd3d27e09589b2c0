"""Request scoring on a stream.

JSON-lines request files ``{request_id, body}`` arrive in a folder; each
micro-batch is validated with the request contract (B14), valid rows are
typed and scored, invalid rows go to a reject sink with their reasons.  With
no model every row is rejected as ``model is unavailable``.  Writes are
idempotent per batch (dynamic partition overwrite on ``batch_id``), so a
replayed batch after a failure replaces its own output.

Requests that carry a time are told apart by request id within a watermark:
a repeated id is scored once, also across batches.  The model is either given
or looked up before each batch in a folder whose manifest names the current
artifact (``ModelSlot``): a new manifest takes effect with the next batch, one
that fails its gates leaves the model in use.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.operators.contract import request_violations, snake_name
from cartwheel.schema import FEATURE_COLUMNS, SESSION_SCHEMA

REQUEST_SCHEMA = "request_id string, body string"
TIMED_REQUEST_SCHEMA = "request_id string, body string, ts timestamp"
UNAVAILABLE = "model is unavailable"

Scorer = Callable[[DataFrame], Column]


def typed_requests(requests: DataFrame) -> DataFrame:
    """Valid request bodies → the 17 typed feature columns (wire or snake_case names)."""
    m = F.from_json(F.col("body"), "map<string,variant>")
    base = requests.select("request_id", m.alias("_m"))
    cols = []
    for f in FEATURE_COLUMNS:
        t = SESSION_SCHEMA[f].dataType.simpleString()
        v = F.coalesce(F.try_element_at(F.col("_m"), F.lit(f)), F.try_element_at(F.col("_m"), F.lit(snake_name(f))))
        cols.append(F.try_variant_get(v, "$", t).alias(f))
    return base.select("request_id", *cols)


_ROW = "__row"


def _verdicts(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows without a violation, rejected rows with reasons): every row gets its own verdict, whatever its
    request_id is.  ``batch`` carries ``_ROW``, a number of its own per row."""
    v = request_violations(batch, id_column=_ROW)
    reasons = v.groupBy(_ROW).agg(  # one row's violations: as many as it has fields
        F.sort_array(F.collect_list(F.concat_ws(":", "field", "rule"))).alias("reasons"))
    rejected = batch.join(reasons, _ROW, "inner").select("request_id", "body", "reasons")
    return batch.join(reasons, _ROW, "left_anti"), rejected


def numbered(batch: DataFrame) -> DataFrame:
    return batch.withColumn(_ROW, F.monotonically_increasing_id())


def score_batch(batch: DataFrame, scorer: Scorer | None, threshold: float, version: str) -> tuple[DataFrame, DataFrame]:
    """(accepted scored rows, rejected rows with reasons) for one batch of requests."""
    if scorer is None:
        rejected = batch.select("request_id", "body", F.array(F.lit(UNAVAILABLE)).alias("reasons"))
        return batch.limit(0).select("request_id"), rejected
    ok, rejected = _verdicts(batch if _ROW in batch.columns else numbered(batch))
    typed = typed_requests(ok)
    p = scorer(typed)
    accepted = typed.select(
        "request_id", (p >= F.lit(threshold)).alias("will_purchase"), p.alias("purchase_probability"),
        F.lit(threshold).alias("threshold"), F.lit(version).alias("model_version"))
    return accepted, rejected


def _write(df: DataFrame, path: str, batch_id: int) -> None:
    (df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def once_per_request(requests: DataFrame, watermark: str) -> DataFrame:
    """Each request id once within the watermark; requests without an id are told apart by time and body."""
    own = F.sha2(F.concat_ws("|", F.col("ts").cast("string"), "body"), 256)
    known = requests.withColumn("__id", F.coalesce(F.concat(F.lit("id:"), "request_id"), own))
    return known.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["__id"]).select("request_id", "body")


def publish_model(spark: SparkSession, folder: str, artifact: str) -> None:
    """Name ``artifact`` as the folder's current model: one small JSON document, replaced by a rename."""
    from cartwheel.sources.reports import write_report

    write_report(spark.createDataFrame([("artifact", artifact)], "path string, value string"), f"{folder}/current.json")


class ModelSlot:
    """The current model of a folder, looked up anew before each batch.

    ``current`` gives (model or None, threshold, version).  The artifact named by ``current.json`` is loaded through its
    gates when the name changes; if it cannot be, the model in use stays, and ``problem`` says why.
    """

    def __init__(self, spark: SparkSession, folder: str, expected_features=None):
        self.spark, self.folder, self.expected = spark, folder, expected_features
        self.name, self.model, self.manifest, self.problem = None, None, {}, None

    def current(self) -> tuple[object | None, float, str]:
        from cartwheel.sources import artifacts

        try:
            name = self.spark.read.option("multiLine", True).json(f"{self.folder}/current.json").first()["artifact"]
            if name != self.name:
                self.model, self.manifest = artifacts.load_artifact(self.spark, name, self.expected)
                self.name = name
            self.problem = None
        except Exception as error:  # noqa: BLE001 - a broken publication must not stop the stream
            self.problem = f"{type(error).__name__}: {str(error)[:200]}"
        return self.model, float(self.manifest.get("threshold") or 0.0), str(self.manifest.get("model_version") or "none")


def start_scoring_stream(spark: SparkSession, source_dir: str, accepted_dir: str, rejected_dir: str,
                         checkpoint_dir: str, scorer, threshold: float = 0.0, version: str = "none",
                         *, available_now: bool = True, max_files_per_trigger: int | None = None,
                         feature_names=FEATURE_COLUMNS, watermark: str | None = None):
    """Start the scoring query; returns the ``StreamingQuery``.

    ``scorer``: a fitted ``PipelineModel`` (scored on ``feature_names``), a Column scorer
    (typed features → probability Column), a ``ModelSlot`` (its manifest gives threshold, version and features),
    or None (no model: every request rejected).  With ``watermark`` requests carry ``ts`` and repeated ids are dropped.
    """
    reader = spark.readStream.schema(TIMED_REQUEST_SCHEMA if watermark else REQUEST_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.json(source_dir)
    if watermark:
        stream = once_per_request(stream, watermark)

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = numbered(batch).persist()  # the same numbers for both sinks
        model, limit, named, features = scorer, threshold, version, feature_names
        try:
            if isinstance(scorer, ModelSlot):
                model, limit, named = scorer.current()
                features = scorer.manifest.get("feature_names") or feature_names
            if model is not None and hasattr(model, "transform"):
                accepted, rejected = score_batch_with_model(batch, model, features, limit, named)
            else:
                accepted, rejected = score_batch(batch, model, limit, named)
            _write(accepted, accepted_dir, batch_id)
            _write(rejected, rejected_dir, batch_id)
        finally:
            batch.unpersist()

    w = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def closed_form_scorer(df: DataFrame) -> Column:
    """A model-free scorer (PageValues / (PageValues + 20)) for tests and demos."""
    return F.round(F.col("PageValues") / (F.col("PageValues") + 20.0), 4)


def score_batch_with_model(batch: DataFrame, model, feature_names, threshold: float,
                           version: str) -> tuple[DataFrame, DataFrame]:
    """Model-based variant of ``score_batch`` (N2 with a saved PipelineModel)."""
    from pyspark.ml.functions import vector_to_array

    ok, rejected = _verdicts(batch if _ROW in batch.columns else numbered(batch))
    typed = typed_requests(ok)
    out = model.transform(typed.select("request_id", *feature_names))
    p = vector_to_array("probability")[1]
    accepted = out.select("request_id", (p >= F.lit(threshold)).alias("will_purchase"),
                          p.alias("purchase_probability"), F.lit(threshold).alias("threshold"),
                          F.lit(version).alias("model_version"))
    return accepted, rejected
