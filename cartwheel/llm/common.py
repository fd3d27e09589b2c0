"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import shutil
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.session import ensure_checkpoint_dir

__all__ = ["discard", "documents", "files_for", "mapped", "materialize", "partitions", "range_bounds", "release", "serve", "ship", "slices", "table", "worker_cache"]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's source files to the executors once per application, so that tasks can import it
    wherever the driver was started."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        folder = tempfile.mkdtemp(prefix="cartwheel-ship-")
        shutil.copytree(os.path.join(root, "cartwheel"), os.path.join(folder, "cartwheel"),
                        ignore=shutil.ignore_patterns("__pycache__", "*.pyc"))
        sc.addPyFile(shutil.make_archive(os.path.join(folder, "cartwheel-src"), "zip", folder, "cartwheel"))
        _shipped.add(sc.applicationId)


def mapped(df: DataFrame, f: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow`` with the package at hand in the tasks.  A worker gives back the memory that a task has used, so
    that idle workers of an executor stay small, and forgets what it has learnt when it turns to another operator."""
    ship(df.sparkSession)
    operator = f.__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serve(operator)
        try:
            yield from f(batches)
        finally:
            _give_back()

    return df.mapInArrow(run, schema)


_learnt: list[dict] = []
_served: list[str] = []


def worker_cache() -> dict:
    """A dictionary that a worker keeps from task to task, as long as they are of one operator."""
    _learnt.append({})
    return _learnt[-1]


def serve(operator: str) -> None:
    if _served != [operator]:
        _served[:] = [operator]
        for kept in _learnt:
            kept.clear()


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # of the C library; others keep what they have
        ctypes.CDLL(None).malloc_trim(0)


#: Bytes of text behind a file of a small table.
FILE_BYTES = 4 << 20
#: While a table is written: rows may hold large binaries, so batches are bounded by bytes rather than rows.
_SMALL = {"spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20), "spark.sql.parquet.columnarReaderBatchSize": "256"}


def files_for(spark: SparkSession, size: int) -> int:
    """Files in which a table made from ``size`` bytes of text is written: two a core at least, and one per ``FILE_BYTES``."""
    return max(2 * spark.sparkContext.defaultParallelism, size // FILE_BYTES)


def materialize(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """``df``, written as Parquet in the cluster's shared folder and read again: lineage ends here, and a lost
    executor costs at most a read.  Shuffle files of the plan just written are released.  With ``files``, no more
    than that many tasks write, however many partitions ``df`` has: local file systems start a process or more for each file."""
    spark = df.sparkSession
    if files:
        df = df.coalesce(files)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cartwheel-llm/{name}-{uuid.uuid4().hex}"
    before = {k: spark.conf.get(k) for k in _SMALL}
    try:
        for k, v in _SMALL.items():
            spark.conf.set(k, v)
        df.write.option("parquet.block.size", 32 << 20).parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    schema = df.schema
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()  # Spark's cleaner drops shuffles whose plans are garbage
    return spark.read.schema(schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Wait until the driver has let go of finished plans, so that Spark's cleaner deletes their shuffle files: used
    after steps whose shuffle is as large as the input."""
    for _ in range(2):
        gc.collect()
        time.sleep(0.4)  # listeners hold a finished plan until its last event is handled
        spark.sparkContext._jvm.System.gc()


def discard(*tables: DataFrame) -> None:
    """Delete materialised tables that nothing will read again."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        for folder in {os.path.dirname(f) for f in df.inputFiles()}:
            if "/cartwheel-llm/" in folder:
                path = sc._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and whole text of every document; a null text becomes the empty one."""
    return table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 4 << 20, rows: int = 1 << 30) -> Iterator[pa.RecordBatch]:
    """Cut record batches into runs of at most ``rows`` rows with at most ``most`` bytes in ``column`` (one row at least),
    so that the arrays made from a run stay small whatever the batch size is."""
    for batch in batches:
        n, start = batch.num_rows, 0
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        total = 0
        for i, size in enumerate(sizes):
            if i > start and (total + size > most or i - start >= rows):
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < n:
            yield batch.slice(start, n - start)


def range_bounds(df: DataFrame, column: str, parts: int) -> list[int]:
    """At most ``parts - 1`` cut points that split the non-null values of a long column about evenly.

    Only the column is read; the cut points are a quantile sketch of all its values.  They decide where
    rows are worked on, never the result.
    """
    probs = [i / parts for i in range(1, parts)]
    if not probs:
        return []
    found = df.select(column).stat.approxQuantile(column, probs, min(0.01, 0.25 / parts))
    return sorted({int(x) for x in found})


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
