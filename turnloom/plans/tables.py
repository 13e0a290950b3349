"""Stage tables in a folder that the driver and all executors share: writing with counts, telling what changed, and removing calls.

A stage table is partitioned by a bucket of its calls, so that removing some calls rewrites their buckets alone.
"""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

BUCKETS = 64
_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; a temporary one of this machine for plain local masters only."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if path:
        return path.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _LOCAL.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="turnloom-"))


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{shared_dir(spark)}/turnloom/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str, metrics: Mapping[str, Column] | None = None, partition_by: tuple[str, ...] = ()) -> tuple[DataFrame, dict[str, int]]:
    """Write a table and return a reader of it with its number of ``rows`` and the other metrics, all counted by the job that wrote it."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(name) for name, c in (metrics or {}).items()])
    counted.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), {k: v for k, v in seen.get.items()}


def stored(df: DataFrame, name: str) -> DataFrame:
    """A frame as a table in the shared folder: what it cost is paid once, and a lost executor doesn't lose it."""
    return written(df, new_path(df.sparkSession, name))[0]


def files_under(spark: SparkSession, path: str) -> DataFrame | None:
    """Path, length and time of all files below a path, their contents unread; None where nothing is."""
    try:
        return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def snapshot(spark: SparkSession, path: str) -> str | None:
    """A digest of the names, lengths and times of the files below a path; None where nothing is."""
    files = files_under(spark, path)
    if files is None:
        return None
    row = files.agg(F.count("*"), F.sum("length"), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first()
    return hashlib.sha256(repr(tuple(row)).encode()).hexdigest()


def bucket_of(call_id: Column, buckets: int = BUCKETS) -> Column:
    """The bucket of a call."""
    return F.pmod(F.xxhash64(call_id.cast("string")), F.lit(buckets)).cast("int")


def write_bucketed(df: DataFrame, path: str, buckets: int = BUCKETS, metrics: Mapping[str, Column] | None = None) -> dict[str, int]:
    """Write a stage table by buckets of its calls; return its counts."""
    placed = df.withColumn("bucket", bucket_of(F.col("call_id"), buckets))
    return written(placed.repartition("bucket", F.pmod(F.xxhash64(*df.columns), F.lit(4))), path, metrics, ("bucket",))[1]


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A stage table without its bucket."""
    return spark.read.parquet(path).drop("bucket")


def removal(spark: SparkSession, paths: Mapping[str, str], ids: DataFrame) -> DataFrame:
    """What removing calls from stage tables would take away: stage, bucket, rows, gone.  Nothing is changed.

    Only the buckets of the calls are read, and of them the calls' ids.
    """
    wanted = ids.select(F.col("call_id").cast("string").alias("call_id")).distinct()
    parts = []
    for stage, path in paths.items():
        table = spark.read.parquet(path).select(F.col("call_id").cast("string").alias("call_id"), "bucket")
        found = table.join(wanted.withColumn("_gone", F.lit(1)), "call_id", "left")
        parts.append(found.groupBy("bucket").agg(F.count("*").alias("rows"), F.count("_gone").alias("gone")).where("gone > 0").select(F.lit(stage).alias("stage"), "bucket", "rows", "gone"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def remove_calls(spark: SparkSession, paths: Mapping[str, str], ids: DataFrame) -> dict[str, int]:
    """Remove calls from stage tables and return how many rows went from each.

    Buckets that keep rows are replaced together by one dynamic partition overwrite a table, whose commit leaves the old files until the new
    ones are there; buckets of which nothing is left are deleted after that.  The driver holds one row a table and bucket.  A removal that
    breaks off can be run again.
    """
    plan = removal(spark, paths, ids).collect()  # at most one row a table and bucket
    wanted = ids.select(F.col("call_id").cast("string").alias("_id")).distinct()
    for stage, path in paths.items():
        kept = [r.bucket for r in plan if r.stage == stage and r.rows > r.gone]
        if kept:
            table = spark.read.parquet(path).where(F.col("bucket").isin(kept))
            rest = table.join(wanted, F.col("call_id").cast("string") == F.col("_id"), "left_anti")
            stored(rest, f"removal-{stage}").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
        for bucket in (r.bucket for r in plan if r.stage == stage and r.rows == r.gone):
            delete(spark, f"{path}/bucket={bucket}")
    return {stage: sum(r.gone for r in plan if r.stage == stage) for stage in paths}


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder in any store that Spark reaches."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
