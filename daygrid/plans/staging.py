"""Intermediate results as tables in the shared scratch folder.

A staged result is read by several later branches, cuts their lineage and
outlives lost executors, because it is a plain table in the folder that
``spark.checkpoint.dir`` names.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_scratch: tempfile.TemporaryDirectory | None = None
_staged: list[str] = []


def scratch_dir(spark: SparkSession) -> str:
    """The shared scratch folder; a temporary one only where a local master has none set."""
    global _local_scratch
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if _local_scratch is None:
        _local_scratch = tempfile.TemporaryDirectory(prefix="daygrid-")
    return _local_scratch.name


def new_scratch_path(spark: SparkSession, label: str, owned: list[str] | None = None) -> str:
    """A new path below the scratch folder, noted in ``owned`` or for ``drop_staged``."""
    path = f"{scratch_dir(spark)}/daygrid/{label}-{uuid.uuid4().hex}"
    (_staged if owned is None else owned).append(path)
    return path


def stage(frame: DataFrame, label: str, owned: list[str] | None = None) -> DataFrame:
    """Writes ``frame`` once and returns the written table."""
    path = new_scratch_path(frame.sparkSession, label, owned)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def drop_staged(spark: SparkSession, owned: list[str] | None = None) -> None:
    """Deletes what is noted in ``owned``, or what this process staged without an owner;
    call it once the results are written."""
    paths = _staged if owned is None else owned
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while paths:
        path = jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(conf).delete(path, True)
