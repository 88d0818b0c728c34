"""Intermediate tables that must be computed once.

A staged table cuts lineage: later steps read files instead of recomputing the
plan, and a lost executor costs only the tasks that ran on it.
"""

from __future__ import annotations

import itertools
import tempfile
import threading
import uuid
from collections.abc import Callable, Hashable
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def staging_root(spark: SparkSession) -> str:
    """The shared folder of the cluster; a temporary one only in local mode."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="plumbline-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def forget_shuffles(spark: SparkSession) -> None:
    """Spark deletes shuffle files once the driver has collected what refers to them; here that does not wait until the driver is short of memory."""
    spark.sparkContext._jvm.System.gc()


class Staging:
    """A folder of staged parquet tables, private to one run."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{staging_root(spark)}/plumbline-{uuid.uuid4().hex}"
        self._numbers = itertools.count(1)
        self._lock, self._shared = threading.Lock(), {}

    def put(self, df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
        """Write ``df`` and return the DataFrame that reads the files; these are compressed as the session has it, or as told."""
        path = f"{self.path}/{next(self._numbers):04d}-{label}"
        df.write.mode("errorifexists").parquet(path, compression=compression)
        return self.spark.read.schema(df.schema).parquet(path)

    def once(self, key: Hashable, make: Callable[[], Any]) -> Any:
        """What ``make`` gives for a key, made once in a run, whoever of several threads asks first."""
        with self._lock:
            lock, _ = self._shared.setdefault(key, (threading.Lock(), []))
        with lock:
            held = self._shared[key][1]
            if not held:
                held.append(make())
            return held[0]

    def clear(self) -> None:
        """Delete the folder; DataFrames that still read it become invalid."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
