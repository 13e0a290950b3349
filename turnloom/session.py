"""Sending this package to Python workers that cannot import it."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package to the session's files, once; workers of a ``local`` master share the driver's path and may have it already."""
    root = Path(__file__).resolve().parent
    context = spark.sparkContext
    at_hand = re.fullmatch(r"local(\[.*\])?", context.master) and str(root.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if context.applicationId in _SENT or at_hand:
        return
    _SENT.add(context.applicationId)
    made = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="turnloom-"), "turnloom"), "zip", root.parent, root.name)
    context.addPyFile(made)


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A query that sends the package first."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run
