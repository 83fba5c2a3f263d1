"""Shared scratch space for results that have to be fixed before they are used twice."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_job: ContextVar[str | None] = ContextVar("job", default=None)


def _root(spark: SparkSession) -> str:
    root = spark.conf.get(_SETTING, None)
    if not root:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise RuntimeError(f"set {_SETTING} to a folder all executors share")
        root = tempfile.mkdtemp(prefix="veilspark-")
        spark.conf.set(_SETTING, root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the folder that `spark.checkpoint.dir` names, or under that of the job.

    Only a local session without that setting gets a folder of its own; on a
    cluster a machine-local folder would be lost with its machine.
    """
    return f"{_job.get() or _root(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_job(spark: SparkSession, label: str) -> Iterator[str]:
    """One folder for all scratch that is written within, deleted at the end.

    Whatever a job returns reads from it, so results are stored or released within. The folder
    goes as well if the job fails, as it may hold names and identifiers.
    """
    folder = scratch_path(spark, label)
    token = _job.set(folder)
    try:
        yield folder
    finally:
        _job.reset(token)
        make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        make(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(make(folder), True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once and read it back, cutting its lineage.

    The copy survives the loss of executors, is read with column pruning, and
    gives the optimizer true sizes for the joins that follow.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
