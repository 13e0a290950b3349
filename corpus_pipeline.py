"""The training-data pipeline: raw documents to compressed token ids, stage by stage.

Each stage takes all that its predecessor kept; what a stage returns is written as Parquet in the shared folder and read again.

Defined results, in every stage: a null or empty text is kept unless its score says otherwise (it has no copies, no leaks, and is never taken
by the mix, whose sizes are words); rows without doc_id are documents of their own and have no copies; rows that repeat are scored, searched
and mixed alike, and one row of a doc_id is left by near-dedup; extra columns of any name are carried along; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnloom.llm import decontamination, mixing, near_dedup, quality, token_output
from turnloom.llm.storage import free_name, materialize


#: bytes of rows that go to a Python worker at once; else it is 10,000 texts, 35 MB of the sample documents
BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def small_batches(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``stage``, in a session that sends rows to Python in batches of ``BATCH``, if its owner has not set their size."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(BATCH[0], None) is None:
            spark.conf.set(*BATCH)
        return stage(spark, docs, sf_dir)

    return run


@small_batches
def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the quality classifier, trained on the labels of those present, does not reject."""
    model, name = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), free_name(docs, "_quality")
    return quality.with_quality(docs, model, name).where(F.col(name) >= 0.5).drop(name)


@small_batches
def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near duplicates: that of the least doc_id, and of its rows the one with the least text."""
    judged = materialize(near_dedup.near_duplicates(docs).select("doc_id", "kept"), "near-verdicts").where("doc_id IS NOT NULL")
    dropped = judged.where("NOT kept").select("doc_id").distinct()
    repeated = judged.where("kept").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    left = docs.join(dropped, "doc_id", "left_anti")
    if repeated.isEmpty():
        return left.select(docs.columns)
    rank = free_name(docs, "_rank")
    again = left.join(repeated, "doc_id", "left_semi").withColumn(rank, F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))).where(F.col(rank) == 1)
    return left.join(repeated, "doc_id", "left_anti").select(docs.columns).unionByName(again.select(docs.columns))


@small_batches
def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item."""
    name = free_name(docs, "_leaks")
    marked = decontamination.with_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), name=name)
    return marked.where(F.size(name) == 0).drop(name)


@small_batches
def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that the sources come to their target weights; equal rows share their copies evenly."""
    key, copies, rows, rank = (free_name(docs, x) for x in ("_key", "_copies", "_rows", "_rank"))
    plan = mixing.mix(docs).groupBy(F.col("row_key").alias(key)).agg(F.sum("copies").alias(copies), F.count("*").alias(rows)).where(F.col(copies) > 0)
    joined = docs.withColumn(key, mixing.row_key()).join(plan, key).withColumn(rank, F.row_number().over(Window.partitionBy(key).orderBy(key)))
    own = F.floor(F.col(copies) / F.col(rows)) + (F.col(rank) <= F.col(copies) % F.col(rows)).cast("int")
    return joined.where(own > 0).withColumn(rank, F.explode(F.sequence(F.lit(1), own.cast("int")))).select(docs.columns)


@small_batches
def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write token ids, read them back and return a digest of each written document."""
    return token_output.read_tokens(token_output.write_tokens(docs), digest=True)


STAGES = [
    ("quality classifier", good_documents),
    ("MinHash near-dedup", distinct_documents),
    ("benchmark decontamination", clean_documents),
    ("mixing sources to target weights", mixed_documents),
    ("token-ID output", token_files),
]

#: SQL cannot express the classifier, the latent index or the coder; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict:
    """Return the pipeline as a query."""
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    """Return the pipeline's SQL, if there is any."""
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
