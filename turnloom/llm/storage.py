"""Intermediate tables in the folder that all executors share.

``spark.checkpoint.dir`` names that folder.  Only a ``local`` master may fall back to a temporary folder of this machine.
"""

from __future__ import annotations

import gc
import re
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from turnloom.llm import kernel

#: seconds between two calls of ``release`` by ``ease``
RELEASE_S = 2.0
_LOCAL: dict[str, str] = {}
_RELEASED: dict[str, float] = {}


def shared_dir(spark: SparkSession) -> str:
    """Return the shared folder of this session, creating one only for local masters."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if path:
        return path.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):  # local-cluster has executors of its own
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _LOCAL.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="turnloom-"))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and return a reader of it: lineage ends here and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/turnloom/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    # operators write dozens of tables: without this, plans and shuffle files of all before would stay until the driver's memory is full
    ease(spark)
    table = spark.read.schema(df.schema).parquet(path)
    table._stored_at = path
    return table


def ease(spark: SparkSession) -> None:
    """``release``, if the last one was more than ``RELEASE_S`` ago: for steps of which there may be many."""
    if time.monotonic() - _RELEASED.setdefault(spark.sparkContext.applicationId, time.monotonic()) > RELEASE_S:
        release(spark)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished queries now, and the driver the code it made for them.

    Both happen when the driver's objects of a query are collected, which a driver with enough memory puts off.  What the driver's
    Python has freed goes back to the system.
    """
    _RELEASED[spark.sparkContext.applicationId] = time.monotonic()
    gc.collect()
    kernel.trim()
    spark._jvm.System.gc()


def free_name(df: DataFrame, name: str) -> str:
    """Return ``name``, lengthened until ``df`` has no such column."""
    while name.lower() in map(str.lower, df.columns):
        name += "_"
    return name


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote and that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table._stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    """Return the session's number of shuffle partitions, which its owner sets to fit the data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
