"""URL filter: host and path rules, then logistic regression on hashed character n-grams.

Everything here is DataFrame and SQL functions.  Nothing is shuffled when pages are judged by up to ``LITERAL_RULES`` rules: rules and weights
are literals.  More rules are a table, which is joined on the suffixes of the distinct hosts.

The labelled table that the model learns from is small; ``seed_urls`` makes a neutral one from lists of words that often stand in hosts and
paths of advertising, gambling, pharmacy spam and the like, and of words from ordinary sites.  It knows nothing of the pages that are judged.

Defined results: a null url, or one without ``://``, has an empty host and path and is judged by the bias alone; repeated rows are judged
alike; an empty table gives an empty result.  Only the id and url columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LITERAL_RULES = 1000
GRAMS = (3, 4, 5)
BUCKETS = 4096

# Words of the labelled table, blocked and allowed.
BLOCKED = "casino poker slots betting jackpot lottery bingo pills viagra pharmacy-discount replica-watches payday-loans adult webcams escorts adserver banner-ads popunder clicktracker spam doorway warez keygen torrents".split()
ALLOWED = "university library museum recipes gardening weather history science council hospital school journal archive music travel cooking astronomy railway village theatre orchestra chemistry physics engineering".split()
SHAPES = ["http://{w}.example/{p}/1", "https://www.{w}-{v}.example/index.html", "https://{v}.example/{w}/7?ref=a", "http://m.{w}{v}.test/{p}"]


def seed_urls(step: int = 1) -> list[tuple[str, int]]:
    """Labelled urls (1: block) made from the lists: word k with word k + ``step`` of its own list, in each shape."""
    out = []
    for words, label in ((BLOCKED, 1), (ALLOWED, 0)):
        for k, w in enumerate(words):
            v = words[(k + step) % len(words)]
            out += [(shape.format(w=w, v=v, p=("go", "item", "page")[k % 3]), label) for shape in SHAPES]
    return out


def host_of(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    at = F.instr(url, "://")
    host = F.regexp_extract(F.substring(url, at + 3, F.length(url)), "^[^/?#]*", 0)
    return F.when(F.coalesce(at, F.lit(0)) > 0, F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise("")


def path_of(url: Column) -> Column:
    """Text after the host up to ``?``, ``#`` or the end; empty without ``://``."""
    at = F.instr(url, "://")
    path = F.regexp_extract(F.substring(url, at + 3, F.length(url)), "^[^/?#]*([^?#]*)", 1)
    return F.when(F.coalesce(at, F.lit(0)) > 0, path).otherwise("")


def best_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """Struct (rule, action) of the longest rule that fits, else null.

    A rule is a host and a path prefix in one string; it fits its host and all subdomains.  Of equally long rules the one with the longer
    host wins, then ``block``.
    """
    if not rules:
        return F.lit(None).cast("struct<rule:string,action:string>")
    rows = [{"host": r[: r.index("/")], "path": r[r.index("/") :], "rule": r, "action": a} for r, a in rules]
    table = F.from_json(F.lit(json.dumps(rows)), "array<struct<host:string,path:string,rule:string,action:string>>")
    return _longest(F.filter(table, lambda r: ((host == r["host"]) | host.endswith(F.concat(F.lit("."), r["host"]))) & path.startswith(r["path"])))


def _longest(fits: Column) -> Column:
    ranked = F.array_max(F.transform(fits, lambda r: F.struct(F.length(r["rule"]).alias("n"), F.length(r["host"]).alias("h"), r["action"].alias("action"), r["rule"].alias("rule"))))
    return F.when(ranked.isNotNull(), F.struct(ranked["rule"].alias("rule"), ranked["action"].alias("action")))


def with_rule(parts: DataFrame, rules: DataFrame) -> DataFrame:
    """Add ``_rule``, as ``best_rule`` finds it, from a table of any number of rules (rule, action).

    Distinct hosts meet the rules of their suffixes; pages then meet the rules of their host.
    """
    at = F.instr("rule", "/")
    table = rules.select(F.substring("rule", F.lit(1), at - 1).alias("suffix"), F.substring("rule", at, F.length("rule")).alias("path"), "rule", "action")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    near = parts.select("host").distinct().select("host", F.explode(suffixes).alias("suffix")).join(table, "suffix")
    by_host = near.groupBy("host").agg(F.collect_list(F.struct(F.col("suffix").alias("host"), "path", "rule", "action")).alias("_rules"))
    joined = parts.join(by_host, "host", "left")
    return joined.withColumn("_rule", _longest(F.filter("_rules", lambda r: F.col("path").startswith(r["path"])))).drop("_rules")


def ngram_buckets(host: Column, path: Column, buckets: int = BUCKETS) -> Column:
    """Array of hashed character n-grams; host and path have separate hash spaces."""
    parts = []
    for mark, text in (("h", F.concat(F.lit("^"), host, F.lit("$"))), ("p", path)):
        for n in GRAMS:
            at = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - (n - 1))).otherwise(F.array().cast("array<int>"))
            parts.append(_hashed(at, mark, text, n, buckets))
    return F.concat(*parts)


def _hashed(at: Column, mark: str, text: Column, n: int, buckets: int) -> Column:
    return F.transform(at, lambda i: F.pmod(F.xxhash64(F.lit(mark), F.substring(text, i, F.lit(n))), F.lit(buckets)).cast("int"))


def _margin(grams: Column, model: dict) -> Column:
    weights = F.from_json(F.lit(json.dumps(model["weights"])), "array<double>")
    total = F.aggregate(grams, F.lit(0.0), lambda acc, g: acc + F.element_at(weights, g + 1))
    return F.lit(model["bias"]) + total / F.sqrt(F.greatest(F.size(grams), F.lit(1)).cast("double"))


def train(spark: SparkSession, table: DataFrame | None = None, buckets: int = BUCKETS, rounds: int = 30, rate: float = 4.0, decay: float = 1e-3) -> dict:
    """Fit the weights by full-batch gradient descent; each round is one aggregation over the labelled table (columns url, label).

    The labelled table is small by contract (``seed_urls`` by default); what comes to the driver is one gradient of at most ``buckets``
    sums a round, whatever the table's size.
    """
    table = spark.createDataFrame(seed_urls(), "url string, label int") if table is None else table
    grams = ngram_buckets(host_of(F.col("url")), path_of(F.col("url")), buckets)
    rows = table.where("url IS NOT NULL AND label IS NOT NULL").select(F.col("label").cast("double").alias("label"), grams.alias("grams")).coalesce(1).cache()
    n = max(rows.count(), 1)
    model = {"bias": 0.0, "weights": [0.0] * buckets}
    for _ in range(rounds):
        error = F.lit(1.0) / (1.0 + F.exp(-_margin(F.col("grams"), model))) - F.col("label")
        each = rows.select(error.alias("e"), "grams").select("e", (F.col("e") / F.sqrt(F.greatest(F.size("grams"), F.lit(1)).cast("double"))).alias("g"), F.explode(F.concat("grams", F.array(F.lit(-1)))).alias("b"))
        sums = each.groupBy("b").agg(F.sum(F.when(F.col("b") < 0, F.col("e")).otherwise(F.col("g"))).alias("g")).collect()
        model["weights"] = [w * (1 - rate * decay) for w in model["weights"]]
        for b, g in sums:
            if b < 0:
                model["bias"] -= rate * g / n / 4
            else:
                model["weights"][b] -= rate * g / n
    rows.unpersist()
    return model


def judge(pages: DataFrame, rules: list[tuple[str, str]] | DataFrame, model: dict, id_col: str = "page_id", url_col: str = "url", threshold: float = 0.5) -> DataFrame:
    """Return id, host, path, rule, verdict and block_probability of every page.

    A fitting rule decides; without one, the model blocks at ``threshold``.  Rules are a list or a table (rule, action).
    """
    parts = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    if not isinstance(rules, DataFrame) and len(rules) > LITERAL_RULES:
        rules = pages.sparkSession.createDataFrame(rules, "rule string, action string")
    ruled = with_rule(parts, rules) if isinstance(rules, DataFrame) else parts.withColumn("_rule", best_rule(F.col("host"), F.col("path"), rules))
    ruled = ruled.withColumn("_grams", ngram_buckets(F.col("host"), F.col("path"), len(model["weights"])))
    scored = ruled.withColumn("block_probability", 1.0 / (1.0 + F.exp(-_margin(F.col("_grams"), model))))
    verdict = F.coalesce(F.col("_rule.action"), F.when(F.col("block_probability") >= threshold, F.lit("block")).otherwise(F.lit("allow")))
    return scored.select(id_col, "host", "path", F.col("_rule.rule").alias("rule"), verdict.alias("verdict"), "block_probability")


RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge every page url."""
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), RULES, train(spark))


def l1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can say of every page url: host, path and rule."""
    return op1_url_filter(spark, sf_dir).select("page_id", "host", "path", "rule")


ORACLE = r"""
WITH r AS (SELECT rule, split_part(rule, '/', 1) AS h, substr(rule, strpos(rule, '/')) AS p FROM (VALUES ('com/'), ('example.com/en/'), ('www.example.com/en/'), ('net/es/'), ('net/fr/')) t(rule)),
u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
  CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM pages)
SELECT page_id, host, path, (SELECT arg_max(rule, length(rule)) FROM r WHERE (u.host = r.h OR ends_with(u.host, '.' || r.h)) AND starts_with(u.path, r.p)) AS rule FROM u
"""
