"""Range layouts of documents by id."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnloom.llm.storage import partitions


def range_buckets(keyed: DataFrame, per_partition: int = 4) -> DataFrame:
    """Add ``bucket``: ranges of the bigint column ``key``, cut at its quantiles; equal keys share a bucket.

    Only the key column is read for the cuts, and the driver holds one cut a bucket.
    """
    n = per_partition * partitions(keyed.sparkSession)
    cuts = sorted(set(keyed.select(F.col("key").cast("double").alias("key")).approxQuantile("key", [i / n for i in range(1, n)], 1 / (4 * n))))
    if not cuts:
        return keyed.withColumn("bucket", F.lit(0))
    cut = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="_position", outputCol="_place")
    return cut.transform(keyed.withColumn("_position", F.col("key").cast("double"))).withColumn("bucket", F.col("_place").cast("int")).drop("_position", "_place")
