"""An ad-hoc SQL catalog over reviewed calls, and selective invalidation."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.operators.sets import first_rows

VIEWS = {
    "calls": "call_id string, language string, num_speakers int, num_turns bigint, confidence double, rejected boolean, duration double, snr double",
    "reject_reasons": "call_id string, reason string",
    "turns": "call_id string, idx int, speaker string, start_s double, end_s double, duration double, text string",
    "turn_issues": "call_id string, idx int, issue string",
}


def shred(calls: DataFrame, turns: DataFrame, files: DataFrame | None = None) -> dict[str, DataFrame]:
    """The four tables of the catalog.

    calls: call_id, language, num_speakers, confidence, rejected, reject_reasons and, for repeated ids, ``source`` (the first one wins; reasons and turns
    of the others stay).  files: call_id, duration, snr.
    """
    order = "source" if "source" in calls.columns else "call_id"
    sizes = turns.groupBy("call_id").agg(F.count("*").alias("num_turns"))
    one = first_rows(calls, ["call_id"], order).select("call_id", "language", "num_speakers", "confidence", F.coalesce("rejected", F.lit(False)).alias("rejected"))
    one = one.join(sizes, "call_id", "left").withColumn("num_turns", F.coalesce("num_turns", F.lit(0).cast("bigint")))
    known = files.select("call_id", "duration", "snr") if files is not None else None
    one = one.join(known, "call_id", "left") if known is not None else one.withColumn("duration", F.lit(None).cast("double")).withColumn("snr", F.lit(None).cast("double"))
    length = F.greatest(F.lit(0.0), F.coalesce("end_s", F.lit(0.0)) - F.coalesce("start_s", F.lit(0.0)))
    issues = turns.select("call_id", "idx", F.explode("issues").alias("issue")) if "issues" in turns.columns else turns.select("call_id", "idx", F.lit(None).cast("string").alias("issue")).where("false")
    return {
        "calls": one,
        "reject_reasons": calls.select("call_id", F.explode("reject_reasons").alias("reason")),
        "turns": turns.select("call_id", "idx", "speaker", "start_s", "end_s", length.alias("duration"), "text"),
        "turn_issues": issues,
    }


def schema_text() -> str:
    """The catalog's schema for people to read."""
    return "\n".join(f"{name}({columns})" for name, columns in VIEWS.items())


def where(tables: dict[str, DataFrame], predicate: str) -> DataFrame:
    """Distinct ids of the calls that fulfil a predicate; it is parsed as an expression, so it cannot hold a statement."""
    return tables["calls"].where(F.expr(predicate)).select("call_id").distinct()


def any_case(query: str) -> str:
    """A query whose LIKE ignores case, as ad-hoc users expect; quoted text stays."""
    parts = re.split(r"('(?:[^']|'')*'|\"(?:[^\"]|\"\")*\"|`[^`]*`)", query)
    return "".join(p if k % 2 else re.sub(r"\bLIKE\b", "ILIKE", p, flags=re.I) for k, p in enumerate(parts))


def select_ids(spark: SparkSession, tables: dict[str, DataFrame], query: str, ignore_case: bool = True) -> DataFrame:
    """Distinct values of the first column of a query over the catalog, whose tables are visible to this query only."""
    if not re.match(r"\s*(select|with|from|values|table)\b", query, re.I):
        raise ValueError("only queries are accepted")
    body = (any_case(query) if ignore_case else query).replace("{", "{{").replace("}", "}}")
    names = ", ".join(f"{t} AS (SELECT * FROM {{{t}}})" for t in tables)
    made = spark.sql(f"WITH {names} SELECT * FROM ({body})", **tables)
    return made.select(made[made.columns[0]].cast("string").alias("call_id")).distinct()


def issue_counts(tables: dict[str, DataFrame], ids: DataFrame) -> DataFrame:
    """Number of turn issues of each chosen call."""
    n = tables["turn_issues"].groupBy("call_id").agg(F.count("*").alias("n"))
    return ids.join(n, "call_id", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))


class Invalidation:
    """Outputs of chosen calls, to be removed from stage tables and from all stages that follow.

    ``allowed`` are the stages that may be named; nothing is removed before ``apply``.
    """

    def __init__(self, ids: DataFrame, stages: list[str], order: list[str], cascade: bool = True, allowed: tuple[str, ...] | None = None):
        if not stages or not set(stages) <= set(order if allowed is None else allowed):
            raise ValueError(f"stages are some of {', '.join(order if allowed is None else allowed)}")
        first = min(order.index(s) for s in stages)
        self.ids, self.stages = ids.select("call_id").distinct(), order[first:] if cascade else [s for s in order if s in stages]

    def preview(self, tables: dict[str, DataFrame]) -> DataFrame:
        """Rows that would go, by stage."""
        parts = [tables[s].join(self.ids, "call_id", "left_semi").groupBy(F.lit(s).alias("stage")).agg(F.count("*").alias("rows")) for s in self.stages if s in tables]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def listing(self, catalog: dict[str, DataFrame]) -> DataFrame:
        """The chosen calls with the number of their turn issues."""
        return issue_counts(catalog, self.ids)

    def remove(self, spark: SparkSession, root: str, execute: bool = False) -> DataFrame | dict[str, int]:
        """Remove the calls from the bucketed stage tables under ``root``; without ``execute``, say only which buckets would change."""
        from turnloom.plans import tables

        paths = {s: f"{root}/{s}" for s in self.stages if tables.files_under(spark, f"{root}/{s}") is not None}
        return tables.remove_calls(spark, paths, self.ids) if execute else tables.removal(spark, paths, self.ids)

    def apply(self, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """The stage tables without the chosen calls."""
        return {s: df.join(self.ids, "call_id", "left_anti") if s in self.stages else df for s, df in tables.items()}
