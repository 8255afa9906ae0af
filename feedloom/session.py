"""Session helpers: configuration, checkpoint location, timestamp literals."""

from __future__ import annotations

import datetime as _dt
import os
import tempfile
import uuid

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def get_session(master: str | None = None, partitions: int | None = None,
                app: str = "feedloom") -> SparkSession:
    """Session with AQE, UTC and Arrow on.  Existing sessions are reused."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    partitions = partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("FEEDLOOM_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    The setting is read from the session; only when it is unset (local
    tests) a scratch folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="feedloom-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession) -> str:
    """A new path in the cluster's shared checkpoint folder, removed when the application ends."""
    path = f"{checkpoint_dir(spark)}/feedloom-{uuid.uuid4().hex}"
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return path


def reliable_checkpoint(df):
    """Eager reliable checkpoint into the cluster's checkpoint folder (never a
    local checkpoint): cuts lineage and survives lost executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ts_lit(value) -> Column:
    """A ``timestamp_ntz`` literal from a datetime or ISO text (session zone free)."""
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(value)).cast("timestamp_ntz")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``feedloom`` importable in Python workers (executors).

    Stages that run Python (``mapInPandas``, ``applyInPandasWithState``)
    unpickle functions by module reference, so the package is zipped once
    per application and distributed with ``addPyFile``.
    """
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import zipfile

    import feedloom

    root = os.path.dirname(os.path.dirname(os.path.abspath(feedloom.__file__)))
    staging = tempfile.mkdtemp(prefix="feedloom-pkg-")  # driver-side staging only; Spark copies it out
    path = os.path.join(staging, "feedloom.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _dirs, files in os.walk(os.path.join(root, "feedloom")):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(key)
