"""Session helpers shared by tests, the benchmark and the entry points."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from rostrum.functions.blas import single_thread

# Settings every job of this library relies on: AQE for runtime re-planning
# (partition coalescing, skew-join splitting), UTC so dates agree with the
# DuckDB oracle, Arrow for the few pandas-backed steps.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


# One BLAS thread per Python worker: Spark already runs one task per core, and
# a multi-threaded BLAS inside forked workers can deadlock.
BLAS_ENV = {"OPENBLAS_NUM_THREADS": "1", "OMP_NUM_THREADS": "1", "MKL_NUM_THREADS": "1"}


def get_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "rostrum") -> SparkSession:
    """Local session for tests and the benchmark; on a cluster use the
    session the platform hands out and only apply ``BASE_CONF``."""
    for k, v in BLAS_ENV.items():
        os.environ.setdefault(k, v)
    single_thread()
    builder = SparkSession.builder.appName(app)
    for k, v in BLAS_ENV.items():
        builder = builder.config(f"spark.executorEnv.{k}", v)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    # The test tables are single-row-group files; a real table arrives in many splits.
    builder = builder.config("spark.rostrum.inputPartitions", str(shuffle_partitions))
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    builder = builder.config("spark.driver.memory", os.environ.get("ROSTRUM_DRIVER_MEMORY", "16g"))
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_code(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins; a folder of our own is only chosen when
    the session has none (local tests)."""
    sc = spark.sparkContext
    path = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="rostrum-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared checkpoint folder and read again: computed
    once, of known size for the planner, and safe from lost executors."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Make this package importable on executors: zip it once and register
    it with ``addPyFile`` (Spark's file server copies it to every executor).
    Needed whenever functions of the package run in Python workers
    (``applyInPandas``, ``mapPartitions``)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import zipfile

    root = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="rostrum-code-"), "rostrum.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    p = os.path.join(d, f)
                    z.write(p, os.path.relpath(p, os.path.dirname(root)))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)
