"""Spark session helpers.

Cluster jobs get their session (and ``spark.checkpoint.dir``) from the
launcher; ``build_session`` is for local runs and tests only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC for TIMESTAMP_NTZ casts,
# AQE for runtime coalescing and skew-join splitting.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Arrow batches to the Python stages: pages can be tens of KB each, so keep
    # a batch to about 1000 rows (the default 10000 risks hundreds of MB).
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def build_session(master: str = "local[*]", app: str = "newsflow",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("NEWSFLOW_DRIVER_MEM", "8g")))
    for k, v in {**JOB_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def apply_job_conf(spark: SparkSession) -> None:
    """Session-level settings the operators assume (safe to call repeatedly)."""
    for k, v in JOB_CONF.items():
        spark.conf.set(k, v)
    ship_package(spark)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``newsflow`` importable in the Python workers: the functions run by
    ``mapInPandas`` are pickled by module reference. The package is zipped in
    memory, written to the shared folder through the Hadoop FileSystem API and
    distributed by Spark (``addPyFile``), once per application."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import io
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    target = f"{shared_dir(spark)}/newsflow/pkg-{uuid.uuid4().hex[:12]}/newsflow.zip"
    jvm = sc._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    out = fs.create(path, True)
    try:
        out.write(bytearray(buf.getvalue()))
    finally:
        out.close()
    sc.addPyFile(str(fs.makeQualified(path).toString()))
    _SHIPPED.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the launcher and is read, never replaced; if it
    is missing there, this raises, since a private folder of the driver is none
    that executors see. Only a local session (tests) gets one of its own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="newsflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/newsflow/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path for one intermediate table, in the application's
    own part of the shared folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def clean_scratch(spark: SparkSession) -> None:
    """Deletes the application's intermediate tables. Call it when no result
    that was read from them is needed any more; the command line does at its end."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df, name: str):
    """Cut lineage by writing ``df`` to a fresh table in the shared folder and
    reading it back. Later stages restart from the table, not from the
    upstream job, so a lost executor costs only the tasks of its stage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)
