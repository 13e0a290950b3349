"""Transcripts, manifests and stage tables on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from turnloom import failures
from turnloom.schemas import CALL_DOCUMENT, CLOUD_RESULT, MANIFEST


def read_documents(spark: SparkSession, path: str, schema: str = CALL_DOCUMENT, lines: bool = False) -> tuple[DataFrame, DataFrame]:
    """Sound JSON documents with their file (``source``), and the failures: one (stage, item, error) for each that does not parse.

    One document a file, or with ``lines`` one a line.  A document fails alone, by its file and the beginning of its text.
    """
    raw = spark.read.schema(f"{schema}, _corrupt string").option("multiLine", not lines).option("columnNameOfCorruptRecord", "_corrupt").json(path)
    raw = raw.withColumn("source", F.col("_metadata.file_path"))
    first = F.col(schema.split()[0]).cast("string")  # what was understood before it broke, if anything
    broken = F.concat(F.lit("not a document"), F.coalesce(F.concat(F.lit(" of "), first), F.lit("")), F.lit(": "), F.substring("_corrupt", 1, 80))
    return raw.where("_corrupt IS NULL").drop("_corrupt"), failures.of_rows(raw.select(F.when(F.col("_corrupt").isNotNull(), broken).alias("error"), "source"), "read", "source")


def read_calls(spark: SparkSession, path: str, schema: str = CALL_DOCUMENT) -> DataFrame:
    """Call documents, one JSON file a call; ``source`` is the file.  Broken ones are left out; ``read_documents`` tells them too."""
    return read_documents(spark, path, schema)[0]


def read_json(spark: SparkSession, path: str, schema: str, default: DataFrame | None = None) -> DataFrame:
    """JSON documents; where no file is there, the default."""
    try:
        return spark.read.schema(schema).option("multiLine", True).json(path)
    except AnalysisException as e:
        if default is None or e.getCondition() != "PATH_NOT_FOUND":
            raise
        return default


def read_lines(spark: SparkSession, path: str, schema: str = MANIFEST) -> DataFrame:
    """JSON lines; blank lines are skipped."""
    return spark.read.schema(schema).json(path).where(F.coalesce(*[F.col(c).cast("string") for c in [f.split()[0] for f in schema.split(", ")]]).isNotNull())


def read_cloud_result(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Words and speaker labels of word-level transcripts; times stay text, because labels are found by them."""
    raw = spark.read.schema(CLOUD_RESULT).option("multiLine", True).json(path)
    named = raw.withColumn("call_id", F.regexp_replace(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1), r"\.[^.]*$", ""))
    items = named.select("call_id", F.posexplode("results.items").alias("ord", "i"))
    words = items.select("call_id", "ord", F.col("i.type").alias("kind"), F.col("i.start_time").alias("start_time"), F.col("i.end_time").alias("end_time"), F.col("i.alternatives")[0]["content"].alias("content"))
    segments = named.select("call_id", F.posexplode("results.speaker_labels.segments").alias("ord", "s"))
    labels = segments.select("call_id", "ord", F.col("s.speaker_label").alias("speaker"), F.explode("s.items.start_time").alias("start_time"))
    return words, labels


def long_turns(calls: DataFrame) -> DataFrame:
    """Turns of call documents as rows."""
    rows = calls.select("call_id", F.posexplode("turns").alias("idx", "t"))
    return rows.select("call_id", "idx", F.col("t.speaker").alias("speaker"), F.col("t.start").alias("start_s"), F.col("t.end").alias("end_s"), F.col("t.text").alias("text"))


def nested_calls(calls: DataFrame, turns: DataFrame) -> DataFrame:
    """Call documents from the two long tables."""
    packed = turns.groupBy("call_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", "speaker", F.col("start_s").alias("start"), F.col("end_s").alias("end"), "text"))), lambda t: t.dropFields("idx")).alias("turns"))
    return calls.join(packed, "call_id", "left").withColumn("turns", F.coalesce("turns", F.array().cast("array<struct<speaker:string,start:double,end:double,text:string>>")))


def write_documents(calls: DataFrame, path: str, pretty: bool = False) -> None:
    """Call documents as JSON, one folder a call (``call_id=...``), committed as a whole."""
    body = calls.select("call_id", F.to_json(F.struct(*calls.columns), {"pretty": str(pretty).lower()}).alias("value"))
    body.write.mode("overwrite").partitionBy("call_id").text(path)


def read_manifests(spark: SparkSession, train: str, val: str) -> DataFrame:
    """Both manifests of a data set as one, with ``split``; one that is not there is empty."""
    nothing = spark.createDataFrame([], MANIFEST)
    parts = [read_json_lines(spark, p, nothing).withColumn("split", F.lit(name)) for p, name in ((train, "train"), (val, "val"))]
    return parts[0].unionByName(parts[1])


def read_json_lines(spark: SparkSession, path: str, default: DataFrame, schema: str = MANIFEST) -> DataFrame:
    """JSON lines; where no file is there, the default."""
    try:
        return read_lines(spark, path, schema)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return default


def write_lines(rows: DataFrame, path: str, files: int | None = None) -> None:
    """JSON lines as Spark writes them: committed as a whole, not escaped to ASCII, nulls left out."""
    (rows if files is None else rows.coalesce(files)).write.mode("overwrite").json(path)


def write_stage(rows: DataFrame, path: str) -> None:
    """A stage table; the commit protocol makes it appear whole or not at all."""
    rows.write.mode("overwrite").parquet(path)
