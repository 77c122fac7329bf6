"""Table sinks: the document-store insert becomes an append to a
Parquet table partitioned by source.

``append_mentions`` is a plain append: running a job again appends again.
``append_once`` counts each run once, however often it is started: the rows are
staged in a folder of the attempt, and a manifest named after the run is then
created, which only the first attempt to come that far can do (a file system
creates a name once). Readers (``read_committed``) follow the manifests, so the
rows of an attempt that died while writing, died before or within its manifest,
or came second are never seen; ``sweep`` deletes them. A run id is retried after
the attempt before has ended.

Defined results: a run without rows is committed too; a table without rows needs
a schema to be read; repeated rows of a run are kept; columns that only some
runs have are null in the others.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MANIFESTS, DATA = "_manifests", "data"
ATTEMPT = "run_attempt"      # the attempts' folders are partitions, so one scan reads many


def append_mentions(df: DataFrame, path: str, partition_by: str = "art_source") -> None:
    df.write.mode("append").partitionBy(partition_by).parquet(path)


class _Files:
    """The few file operations of the commit, by the Hadoop FileSystem API."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark.sparkContext._jvm, root.rstrip("/")
        self.fs = self.at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))

    def names(self, folder: str) -> list[str]:
        p = self.at(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> bool:
        """Creates ``name``; False if it is there already."""
        try:
            out = self.fs.create(self.at(name), False)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        return True


def _run_file(run_id: str) -> str:
    if not run_id or any(not (c.isalnum() or c in "-_.") for c in run_id) or run_id.startswith((".", "_")):
        raise ValueError(f"a run id is made of letters, digits, '-', '_' and '.': {run_id!r}")
    return f"{run_id}.json"


def _manifest(files: _Files, name: str) -> dict | None:
    """What a manifest says; None without one, or if its writer died in it."""
    if name not in files.names(MANIFESTS):
        return None
    try:
        return json.loads(files.read(f"{MANIFESTS}/{name}"))
    except ValueError:
        return None


def committed_runs(spark: SparkSession, path: str) -> dict[str, dict]:
    """What the manifests say, by run id."""
    files = _Files(spark, path)
    found = {n.removesuffix(".json"): _manifest(files, n) for n in files.names(MANIFESTS)}
    return {k: m for k, m in found.items() if m is not None}


def append_once(df: DataFrame, path: str, run_id: str, partition_by: str = "art_source") -> bool:
    """Appends ``df`` as the run ``run_id``; False if that run is committed
    already (nothing is written then, or what was written is never read)."""
    files, name = _Files(df.sparkSession, path), _run_file(run_id)
    if _manifest(files, name) is not None:
        return False
    attempt = f"{DATA}/{ATTEMPT}={run_id}-{uuid.uuid4().hex}"
    df.write.partitionBy(partition_by).parquet(f"{files.root}/{attempt}")
    return commit(df.sparkSession, path, run_id, attempt)


def commit(spark: SparkSession, path: str, run_id: str, attempt: str) -> bool:
    """Makes a staged attempt the rows of its run."""
    files, name = _Files(spark, path), _run_file(run_id)
    if name in files.names(MANIFESTS) and _manifest(files, name) is None:
        files.fs.delete(files.at(f"{MANIFESTS}/{name}"), False)      # its writer died in it
    has_rows = any("=" in n for n in files.names(attempt))
    return files.publish(f"{MANIFESTS}/{name}", json.dumps({"attempt": attempt, "rows": has_rows}))


def read_committed(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The rows of all committed runs, in one scan."""
    folders = [f"{path.rstrip('/')}/{m['attempt']}" for m in committed_runs(spark, path).values() if m["rows"]]
    if folders:
        reader = spark.read.option("basePath", f"{path.rstrip('/')}/{DATA}")
        return (reader.schema(schema) if schema else reader.option("mergeSchema", True)).parquet(*folders).drop(ATTEMPT)
    if schema is None:
        raise ValueError(f"no committed rows at {path}: give a schema")
    return spark.createDataFrame([], schema)


def sweep(spark: SparkSession, path: str) -> list[str]:
    """Deletes the attempts that no manifest names. Only while no run writes."""
    files = _Files(spark, path)
    kept = {m["attempt"].rpartition("/")[2] for m in committed_runs(spark, path).values()}
    dead = [n for n in files.names(DATA) if n not in kept]
    for n in dead:
        files.fs.delete(files.at(f"{DATA}/{n}"), True)
    return dead
