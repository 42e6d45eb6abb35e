"""Session helpers: the shared folder for landed files and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Everything this library lands (captures, Arrow fragments, JSON files,
    stream checkpoints) goes below it, so every executor can see it.  A
    private folder is only made when the setting is absent *and* the
    master is local (tests); on a cluster that is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder")
        d = tempfile.mkdtemp(prefix="feedloom-")
        spark.sparkContext.setCheckpointDir(d)
    return _qualified(spark, d).rstrip("/")


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with its filesystem scheme (``hdfs://``, ``s3a://``,
    ``file:``), as Hadoop resolves it.  Python-side writers (pyarrow) then
    open the same shared folder the JVM does, never a task-local disk."""
    try:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(path)
        return str(p.getFileSystem(conf).makeQualified(p).toString())
    except Exception:  # noqa: BLE001 - no JVM access (e.g. Spark Connect)
        return path


def fresh_dir(spark: SparkSession, *parts: str) -> str:
    """A new, unique folder under the shared root (never reused)."""
    return "/".join([shared_root(spark), "feedloom", *parts, uuid.uuid4().hex])


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python file APIs accept the path."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def ensure_dir(path: str) -> str:
    p = local_path(path)
    if "://" not in p:
        os.makedirs(p, exist_ok=True)
    return path
