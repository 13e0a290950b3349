"""Choosing a training checkpoint by validation loss."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def step_numbers(names: DataFrame, name: str = "name") -> DataFrame:
    """Steps of folders named ``step_N``."""
    n = F.regexp_extract(name, r"^step_(\d+)$", 1)
    return names.where(n != "").withColumn("step", n.cast("bigint"))


def nearest_losses(steps: DataFrame, losses: DataFrame, within: int = 10) -> DataFrame:
    """The loss of each step: at the step itself, else at the nearest within reach; of equally near ones, the smaller loss.

    Losses are joined on blocks of ``within`` steps, of which three are looked at, so there is no comparison of all pairs.
    """
    block = F.floor(F.col("step") / within)
    near = steps.select("step", F.explode(F.array(block - 1, block, block + 1)).alias("block"))
    known = losses.select(F.col("step").alias("loss_step"), "loss", F.floor(F.col("step") / within).alias("block"))
    away = F.abs(F.col("step") - F.col("loss_step"))
    return near.join(known, "block").where(away <= within).groupBy("step").agg(F.min(F.struct(away.alias("away"), F.col("loss"))).alias("m")).select("step", "m.away", "m.loss")


def best_step(steps: DataFrame, matched: DataFrame) -> DataFrame:
    """The step of least loss (of equals the first), or the last step if none has a loss."""
    best = matched.agg(F.min_by("step", F.struct("loss", "step")).alias("best_step"), F.min("loss").alias("best_loss"))
    last = steps.agg(F.max("step").alias("last_step"))
    return best.join(last).select(F.coalesce("best_step", "last_step").alias("best_step"), "best_loss")  # one row each
