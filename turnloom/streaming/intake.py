"""Incremental intake: process what is new, once.

A stage table may be filled by a stream over its input folder; the checkpoint remembers what was read, and each trigger ends when all that
is there has been read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def new_files(spark: SparkSession, path: str, schema: str, format: str = "parquet", **options: str) -> DataFrame:
    """A stream of the rows of new files."""
    return spark.readStream.format(format).schema(schema).options(**options).load(path)


def run_available(stream: DataFrame, out: str, checkpoint: str, stage: Callable[[DataFrame], DataFrame] = lambda df: df, key: str | None = None) -> int:
    """Write the stage's rows for all that is new under ``out``, a folder for each batch, and return the number of batches.

    A batch that is repeated after a failure replaces its own folder.  With ``key``, rows whose key another batch has written already are
    left out; only that column is read for it.
    """
    spark, seen = stream.sparkSession, []

    def write(batch: DataFrame, number: int) -> None:
        made = stage(batch)
        if key is not None:
            path = spark._jvm.org.apache.hadoop.fs.Path(out)
            if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
                known = spark.read.schema(f"{key} {made.schema[key].dataType.simpleString()}, batch bigint").parquet(out).where(F.col("batch") != number)
                made = made.join(known.select(key).distinct(), key, "left_anti")
        made.write.mode("overwrite").parquet(f"{out}/batch={number}")
        seen.append(number)

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return len(set(seen))


def talk_sessions(turns: DataFrame, gap: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Sessions of each call over arriving turns (call_id, at, text): turns exactly ``gap`` apart are one session."""
    w = turns.withWatermark("at", late).groupBy("call_id", F.session_window("at", gap).alias("session"))
    return w.agg(F.count("*").alias("turns"), F.sum(F.length("text")).alias("chars")).select("call_id", F.col("session.start").alias("start"), F.col("session.end").alias("end"), "turns", "chars")
