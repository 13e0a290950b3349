"""One channel for what failed, whatever failed: (stage, item, error).

Broken documents, recordings that cannot be read and items that a model refused become rows of the same table, which is written beside the
stage tables; the rest goes on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAILURE = "stage string, item string, error string"


def of_rows(rows: DataFrame, stage: str, item: str = "call_id", error: str = "error") -> DataFrame:
    """Failures of rows whose ``error`` is not null (recordings, clips, embeddings)."""
    return rows.where(F.col(error).isNotNull()).select(F.lit(stage).alias("stage"), F.col(item).cast("string").alias("item"), F.col(error).alias("error"))


def of_answers(rows: DataFrame, stage: str, answer: str = "answer", item: str = "call_id") -> DataFrame:
    """Failures of model answers (ok, value, error)."""
    return of_rows(rows.where(~F.col(answer)["ok"]).select(item, F.col(answer)["error"].alias("error")), stage, item)


def gathered(*parts: DataFrame) -> DataFrame:
    """All failures as one table."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
