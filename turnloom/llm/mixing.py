"""Mix sources to target weights by entropy balancing, in DataFrame and SQL functions only.

Each source gets a token target (weights, capped at ``cap`` times the source).  Document rates minimise the entropy
``sum c_i (r_i ln r_i - r_i)`` under ``sum r_i size_i = target`` for each source and ``0 <= r_i <= cap``.  The cost ``c_i = size_i / x_i``
with ``x_i = (size_i / m) ** tilt`` (m: the source's mean size) lies between counting words (tilt 0) and counting documents (tilt 1).
The dual has one multiplier a source, and its solution is the exponential tilt ``r_i = min(cap, exp(lambda_s x_i))``; distributed Newton
iterations find the multipliers.  Rates become whole copies by error feedback from long to short documents in salted groups of bounded
size, so that each source's words come within about its shortest documents of the target, and reruns agree.

Defined results: a null text has size 0 and is never taken; a null source is a source of its own and comes last; rows that repeat are
documents of their own; rows without doc_id are dealt to groups by their place in the input, so they never gather in one group; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnloom.llm.storage import discard, materialize, release

WORD = r"[^\x20\x09-\x0D]+"
GROUP = 400
SPREAD = 64


def n_words(text: Column) -> Column:
    """Number of words; 0 for null.  Every word is replaced by one mark, and the marks are counted."""
    return F.coalesce(F.length(F.regexp_replace(F.regexp_replace(text, WORD, "x"), r"[\x20\x09-\x0D]+", "")), F.lit(0)).cast("bigint")


def row_key(id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> Column:
    """A key of a row's id, source and text."""
    return F.xxhash64(id_col, source_col, text_col)


def source_targets(sources: DataFrame, weights: tuple[float, ...], cap: float) -> DataFrame:
    """Add the weight and the token target of each source (columns key, source, source_size).

    Sharing and resharing the excess until no source is above its cap ends at the level where capped sources, those with the least
    ``cap * size / weight``, hold their cap and all others ``weight * level``; running sums find that level at once.  There is one row a
    source here, never one a document.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = sources.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(float(cap)))
    order = Window.orderBy(F.col("limit") / F.col("weight"), "key")
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = (
        ranked.withColumn("total", F.sum("source_size").over(whole))
        .withColumn("full", F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        .withColumn("rest", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("full")) / F.col("rest"))
        .withColumn("holds", F.col("level") * F.col("weight") <= F.col("limit"))
    )
    level = F.min_by(F.when(F.col("holds"), F.col("level")), F.when(F.col("holds"), F.struct(F.col("limit") / F.col("weight"), F.col("key")))).over(whole)
    return levels.withColumn("target", F.least(F.col("limit"), F.col("weight") * F.coalesce(level, F.lit(float("inf"))))).select("key", "source", "source_size", "documents", "mean_size", "weight", "target")


def balance(sizes: DataFrame, targets: DataFrame, cap: float, tilt: float, rounds: int = 40, tolerance: float = 1e-9) -> DataFrame:
    """Return the multiplier ``lam`` of each source (null: all documents at the cap).

    One Newton step a round: two weighted sums a source over the distinct (source, size) pairs, kept in a bracket that a step may not
    leave.  The state is a table of one row a source in the shared folder.
    """
    spread = materialize(sizes.where("size > 0").groupBy("key", "size").agg(F.count("*").alias("n")), "mix-sizes")
    top = F.log(F.lit(float(cap)))
    state = targets.select("key", "target", "mean_size", "source_size", F.lit(0.0).alias("lam"), F.lit(-1e30).alias("low"), F.lit(1e30).alias("high"), (F.col("target") >= F.col("source_size") * cap * (1 - 1e-12)).alias("full"))
    state = materialize(state, "mix-state")
    for _ in range(rounds):
        x = F.pow(F.col("size") / F.col("mean_size"), F.lit(tilt))
        tilted = F.col("lam") * x
        words = F.col("n") * F.col("size")
        sums = (
            spread.join(state.where("NOT full").select("key", "lam", "mean_size"), "key")
            .groupBy("key")
            .agg(F.sum(words * F.least(F.lit(float(cap)), F.exp(F.least(tilted, F.lit(50.0))))).alias("got"), F.sum(F.when(tilted < top, words * x * F.exp(tilted)).otherwise(0.0)).alias("slope"))
        )
        miss = F.col("got") - F.col("target")
        stepped = (
            state.join(sums, "key", "left")
            .withColumn("high", F.when(miss > 0, F.col("lam")).otherwise(F.col("high")))
            .withColumn("low", F.when(miss < 0, F.col("lam")).otherwise(F.col("low")))
            .withColumn("newton", F.col("lam") - F.greatest(F.lit(-2.0), F.least(F.lit(2.0), miss / F.greatest(F.col("slope"), F.lit(1e-300)))))
            .withColumn("inside", (F.col("newton") > F.col("low")) & (F.col("newton") < F.col("high")))
            .withColumn("error", F.coalesce(F.abs(miss) / F.greatest(F.col("target"), F.lit(1.0)), F.lit(0.0)))
            .withColumn("lam", F.when(F.col("error") <= tolerance, F.col("lam")).when(F.col("inside"), F.col("newton")).otherwise((F.col("low") + F.col("high")) / 2))
        )
        before, state = state, materialize(stepped.select("key", "target", "mean_size", "source_size", F.coalesce("lam", F.lit(0.0)).alias("lam"), "low", "high", "full", "error"), "mix-state")
        discard(before)
        if (state.agg(F.max("error")).first()[0] or 0.0) <= tolerance:
            break
    discard(spread)
    release(targets.sparkSession)
    return state.select("key", F.when(~F.col("full"), F.col("lam")).alias("lam"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), cap: int = 3, tilt: float = 0.5, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Return doc_id, source, row_key, size, source_size, target, rate, copies and taken of every document.

    row_key is ``row_key`` of the document's row, which tells rows of one doc_id with different texts apart.
    """
    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), row_key(id_col, source_col, text_col).alias("row_key"), n_words(F.col(text_col)).alias("size"))
    sized = sized.withColumn("tie", F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).otherwise(F.col("row_key")))
    sized = materialize(sized.withColumn("key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))), "mix-documents")
    sources = sized.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"), F.count("*").alias("documents"), F.greatest(F.avg("size"), F.lit(1e-9)).alias("mean_size"))
    targets = materialize(source_targets(sources, weights, cap), "mix-targets")
    lam = balance(sized, targets, cap, tilt)
    # a hot source's rows meet SPREAD copies of its one plan row, so no join task holds more than a share of them
    plan = targets.join(lam, "key").drop("source").withColumn("spread", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    x = F.pow(F.col("size") / F.col("mean_size"), F.lit(tilt))
    rated = sized.withColumn("spread", F.pmod(F.xxhash64("doc_id", "size", "tie"), F.lit(SPREAD)).cast("int")).join(plan, ["key", "spread"]).withColumn("rate", F.when(F.col("lam").isNull(), F.lit(float(cap))).otherwise(F.least(F.lit(float(cap)), F.exp(F.least(F.col("lam") * x, F.lit(50.0))))))
    salt = F.pmod(F.xxhash64("size", "doc_id", "tie"), F.greatest(F.lit(1), F.ceil(F.col("documents") / GROUP)))
    grouped = rated.groupBy("key", salt.alias("salt")).agg(
        F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.sort_array(F.collect_list(F.struct("size", "doc_id", "source", "row_key", "rate")), asc=False).alias("rows")
    )
    start = F.struct(F.array().cast("array<bigint>").alias("out"), F.lit(0.0).alias("want"), F.lit(0).cast("bigint").alias("got"))

    def step(acc: Column, row: Column) -> Column:
        want = acc["want"] + row["rate"] * row["size"]
        n = F.when(row["size"] > 0, F.greatest(F.lit(0), F.least(F.lit(cap), F.round((want - acc["got"]) / row["size"])))).otherwise(0).cast("bigint")
        return F.struct(F.concat(acc["out"], F.array(n)).alias("out"), want.alias("want"), (acc["got"] + n * row["size"]).alias("got"))

    copies = F.aggregate("rows", start, step, lambda acc: acc["out"])
    each = grouped.select("source_size", "target", F.explode(F.arrays_zip(F.col("rows").alias("row"), copies.alias("copies"))).alias("z"))
    return each.select(
        F.col("z.row.doc_id").alias("doc_id"), F.col("z.row.source").alias("source"), F.col("z.row.row_key").alias("row_key"), F.col("z.row.size").alias("size"), "source_size", "target", F.col("z.row.rate").alias("rate"), F.col("z.copies").alias("copies"),
        (F.col("z.copies") * F.col("z.row.size")).alias("taken"),
    )


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all documents with weights 5, 2, 1 and at most three times each source."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")


def l10_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can say of the mix of all documents: sizes and targets."""
    return op10_mixing(spark, sf_dir).select("doc_id", "size", "source_size", F.round("target", 3).alias("target"))


ORACLE = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS weight FROM d GROUP BY source),
o AS (SELECT *, 3.0 * source_size / weight AS reach, sum(source_size) OVER () AS total,
  coalesce(sum(3.0 * source_size) OVER (ORDER BY 3.0 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
  sum(weight) OVER (ORDER BY 3.0 * source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free FROM s),
l AS (SELECT arg_min((total - held) / free, reach) FILTER ((total - held) / free <= reach) AS level FROM o)
SELECT d.doc_id, d.size, o.source_size, round(CAST(least(3.0 * o.source_size, o.weight * coalesce(l.level, 1e300)) AS DOUBLE), 3) AS target FROM d JOIN o ON d.source IS NOT DISTINCT FROM o.source, l
"""
