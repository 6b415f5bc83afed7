"""Shared-folder stages: write an intermediate table once, read it back."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Names of stages under the work folder, so that owners can delete what they wrote.
_open_scopes: list[list[str]] = []


def work_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, or set on the context.

    Only a session that runs in one process may go without: it gets a folder of
    its own, set on the context. Any other session must name a shared one.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="kindred-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


def _hadoop_path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a stage from whatever file system it lies on."""
    where, files = _hadoop_path(spark, path)
    files.delete(where, True)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the work folder, deleted when the application ends or its owner does."""
    path = f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"
    where, files = _hadoop_path(spark, path)
    files.deleteOnExit(where)
    if _open_scopes:
        _open_scopes[-1].append(path)
    return path


@contextmanager
def owned_stages(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end every stage written inside; results must have been read by then."""
    _open_scopes.append([])
    try:
        yield
    finally:
        for path in _open_scopes.pop():
            remove(spark, path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the stored table.

    The stored copy survives lost executors, ends the lineage, and gives the
    planner true sizes for its join choices.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_observed(df: DataFrame, name: str, **totals: Column) -> tuple[DataFrame, dict]:
    """The same, with aggregates over all its rows worked out while they are written.

    Totals come from the tasks whose files are kept, each counted once, so no second pass is needed.
    """
    observed = Observation(f"{name}-{uuid.uuid4().hex}")
    stored = staged(df.observe(observed, *[total.alias(key) for key, total in totals.items()]), name)
    return stored, observed.get


def free_shuffles(spark: SparkSession) -> None:
    """Have the driver give up shuffle files of tables that nothing refers to any more.

    Spark deletes them when the driver's garbage is collected, which on a driver with little
    to do may come hours after a stage has been stored.
    """
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.2)
