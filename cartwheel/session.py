"""SparkSession helpers shared by tests, bench and the entry module."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "cartwheel") -> SparkSession:
    """Create (or reuse) a session configured for AQE and Arrow.

    On a cluster the caller passes its own builder settings; this helper is
    for local runs and tests.
    """
    master = master or os.environ.get("CARTWHEEL_MASTER", "local[8]")
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CARTWHEEL_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` is read from the session; a private folder is set
    only when it is unset (local runs and tests).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="cartwheel-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def _tables_folder(spark: SparkSession) -> str:
    """Where this application's materialised tables lie in the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/cartwheel-tables/{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own among the materialised tables."""
    import uuid

    return f"{_tables_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df, name: str):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts lineage like ``checkpoint()`` (the table lives in the cluster's shared
    ``spark.checkpoint.dir``, so it survives executor loss) and keeps the
    downstream plans small.  Each call writes a new folder; ``discard`` deletes
    one that nothing reads any more, ``release_tables`` all that are left.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def discard(*tables) -> None:
    """Delete tables of ``materialize`` that nothing will read again."""
    for df in tables:
        for folder in {os.path.dirname(f) for f in df.inputFiles()}:
            if "/cartwheel-tables/" in folder:
                _delete(df.sparkSession, folder)


def release_tables(spark: SparkSession) -> None:
    """Delete every table that this application has materialised, at the end of a job: results must be written by then."""
    _delete(spark, _tables_folder(spark))


def cores(spark: SparkSession) -> int:
    """Tasks that the application runs at a time, 4 at least."""
    return max(4, spark.sparkContext.defaultParallelism)


def concurrently(jobs, parallelism: int = 4) -> list:
    """Results of argument-less functions that launch Spark jobs, in order, a few at a time."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]
