"""Vector columns."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Inner product of two arrays."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays; a norm of zero counts as 1."""
    norm_a, norm_b = F.sqrt(dot(a, a)), F.sqrt(dot(b, b))
    return dot(a, b) / (F.when(norm_a == 0, 1.0).otherwise(norm_a) * F.when(norm_b == 0, 1.0).otherwise(norm_b))


#: numbers of partial sums that a task holds before it sends them on
HELD = 1 << 22


def partial_sums(rows: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """Sums of vectors as tasks see them: keys, _n (how many numbers each position has) and _s (their sums).

    A task adds up what it reads and sends one row a group, or more where its groups hold over ``HELD`` numbers.  Null vectors and null
    numbers are left out, and shorter vectors end earlier.
    """
    kinds = [f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list[np.ndarray]] = {}
        size, names = 0, [*keys, "_n", "_s"]

        def sent() -> pa.RecordBatch:
            columns = [pa.array([k[j] for k in held], kind) for j, kind in enumerate(types)]
            return pa.RecordBatch.from_arrays([*columns, pa.array([n for n, _ in held.values()], pa.list_(pa.int64())), pa.array([s for _, s in held.values()], pa.list_(pa.float64()))], names=names)

        for batch in batches:
            batch = batch.filter(batch.column(vector).is_valid())
            types = [batch.schema.field(k).type for k in keys]
            if not batch.num_rows:
                continue
            lists = batch.column(vector)
            width = int(pc.max(pc.list_value_length(lists)).as_py())
            flat, length = lists.flatten().cast(pa.float64()), pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(batch.num_rows), length)
            at = np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)
            good = np.asarray(flat.is_valid())
            values, counts = np.zeros((batch.num_rows, width)), np.zeros((batch.num_rows, width), np.int64)
            values[row[good], at[good]] = flat.drop_null().to_numpy()
            counts[row[good], at[good]] = 1
            codes: dict[tuple, int] = {}
            group = np.array([codes.setdefault(k, len(codes)) for k in zip(*(batch.column(k).to_pylist() for k in keys), strict=True)] if keys else [codes.setdefault((), 0)] * batch.num_rows)
            order = np.argsort(group, kind="stable")
            first = np.searchsorted(group[order], np.arange(len(codes)))
            longest = np.maximum.reduceat(length[order], first)
            for key, n, s, width in zip(codes, np.add.reduceat(counts[order], first), np.add.reduceat(values[order], first), longest.tolist(), strict=True):
                n, s = n[:width], s[:width]
                if key not in held:
                    held[key] = [n, s]
                    size += 2 * width
                elif len(held[key][0]) == width:
                    held[key][0] += n
                    held[key][1] += s
                else:
                    wide = max(width, len(held[key][0]))
                    held[key] = [np.pad(x, (0, wide - len(x))) + np.pad(y, (0, wide - len(y))) for x, y in zip(held[key], (n, s), strict=True)]
            if size > HELD:
                yield sent()
                held.clear()
                size = 0
        if held:
            yield sent()

    return rows.select(*keys, vector).mapInArrow(run, ", ".join([*kinds, "_n array<bigint>", "_s array<double>"]))


def mean_vectors(rows: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """Mean vector of each group in two stages: sums of the tasks, and sums of these; one row a group and task is exchanged."""
    parts = partial_sums(rows, keys, vector)
    groups = (parts.groupBy(*keys) if keys else parts.groupBy()).agg(F.collect_list("_n").alias("_n"), F.collect_list("_s").alias("_s"))  # as many as tasks

    def total(lists: str, zero: Column) -> Column:
        return F.aggregate(F.col(lists), F.array().cast("array<double>"), lambda a, b: F.zip_with(a, b.cast("array<double>"), lambda x, y: F.coalesce(x, zero) + F.coalesce(y, zero)))

    mean = F.zip_with(total("_s", F.lit(0.0)), total("_n", F.lit(0.0)), lambda s, n: F.when(n > 0, s / n))
    return groups.select(*keys, mean.alias(vector))


def mean_vector_udaf():
    """An Arrow aggregate for SQL and DataFrames: the mean of a group's vectors, null without any."""

    @F.arrow_udf("array<double>")
    def mean_vector(v: pa.Array) -> Any:
        flat = [np.asarray(x, dtype=np.float64) for x in v.drop_null().to_pylist()]
        return pa.scalar(np.mean(flat, axis=0).tolist() if flat else None, pa.list_(pa.float64()))

    return mean_vector


def register(spark: SparkSession) -> None:
    """Make ``mean_vector`` known to SQL."""
    spark.udf.register("mean_vector", mean_vector_udaf())
