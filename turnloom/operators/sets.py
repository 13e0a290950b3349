"""First rows, pending work and spans of numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_rows(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each key."""
    w = Window.partitionBy(*keys).orderBy(order)
    return rows.withColumn("_first", F.row_number().over(w)).where("_first = 1").drop("_first")


def pending(all_rows: DataFrame, done: DataFrame, key: str = "call_id") -> DataFrame:
    """Rows whose key has no output yet."""
    return all_rows.join(done.select(key).distinct(), key, "left_anti")


def spans(text: str, low: int, high: int) -> list[int]:
    """Sorted numbers of a list like ``1,3-5``, all within the bounds."""
    out: set[int] = set()
    for part in filter(None, (p.strip() for p in text.split(","))):
        a, _, b = part.partition("-")
        first, last = int(a), int(b) if b else int(a)
        if not low <= first <= last <= high:
            raise ValueError(f"{part!r} is not within {low}-{high}")
        out.update(range(first, last + 1))
    return sorted(out)
