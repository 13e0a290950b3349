"""Whitening of embeddings by a block Jacobi-Davidson method over distributed products.

The covariance matrix is never formed.  Its product with a block of vectors is one pass over the vectors: each task centres its rows in exact
integers, multiplies them with the block and adds up one small matrix, and Spark sums the tasks' matrices.  The driver keeps a subspace of a
few blocks (``dims`` numbers a column, so its size is bounded by the vectors' length), takes Ritz pairs from it, locks those whose residual
is at rounding level, and widens it by corrections from MINRES, run in lock step for all open pairs, so an inner step is one pass too.

Defined results: vectors that are null or hold null or non-finite entries are left out, and so are those of another length than most have
(of equally frequent ones the longer counts), since they have no place in the covariance; rows without an id and rows that repeat count and
come out like others; directions without variance (an eigenvalue that is zero to double precision) are no components, so vectors that are all
equal, a single one, or none give an empty result; equal eigenvalues have an arbitrary orthogonal basis, the same for all rows; other
columns, whatever their names, are not read.  Deviations that do not fit 64-bit integers are an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.llm.centroids import integers, matrix
from turnloom.llm.storage import materialize

OFFSET = 1_000_000
EPS = float(np.finfo(np.float64).eps)
SCHEMA = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"

Product = Callable[[np.ndarray], np.ndarray]


def deviations(batch: pa.RecordBatch, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * x - S`` of each row."""
    return matrix(batch.column("x"), len(sums)) * n - sums


class Centred:
    """Vectors (vec_id, x) as deviations from their mean: exact integers ``n * x - S``, or these over ``n`` as doubles."""

    def __init__(self, vectors: DataFrame, n: int, sums: list[int], largest: int):
        if n * largest >= 1 << 62:
            raise ValueError("deviations do not fit 64-bit integers")
        self.vectors, self.n, self.dims = vectors, n, len(sums)
        self.centre = partial(deviations, n=n, sums=np.array(sums, dtype=np.int64))  # what tasks need, without the DataFrame

    def _summed(self, width: int, part: Callable[[np.ndarray], np.ndarray], rows: int) -> np.ndarray:
        """Sum of ``part(centred rows)``, a matrix of ``rows`` x ``width``, over all batches: one pass, and ``rows`` rows for the driver."""
        n, centre = self.n, self.centre

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((rows, width))
            for batch in batches:
                if batch.num_rows:
                    total += part(centre(batch) / n)
            yield pa.RecordBatch.from_arrays([pa.array(range(rows), pa.int32()), *(pa.array(total[:, k]) for k in range(width))], names=["j", *(f"s{k}" for k in range(width))])

        parts = self.vectors.select("x").mapInArrow(run, ", ".join(["j int", *(f"s{k} double" for k in range(width))]))
        out = np.zeros((rows, width))
        for row in parts.groupBy("j").agg(*[F.sum(f"s{k}") for k in range(width)]).collect():
            out[row[0]] = row[1:]
        return out

    def product(self, block: np.ndarray) -> np.ndarray:
        """The covariance matrix times a block."""
        return self._summed(block.shape[1], lambda y: y.T @ (y @ block), self.dims) / self.n

    def trace(self) -> float:
        """The trace of the covariance matrix, from the exact sum of squared deviations."""
        centre = self.centre

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = 0
            for batch in batches:
                if batch.num_rows:
                    total += int(squares(centre(batch)).sum(dtype=object))
            yield pa.RecordBatch.from_arrays([pa.array([str(total)])], names=["total"])

        whole = self.vectors.select("x").mapInArrow(run, "total string").agg(F.sum(F.col("total").cast("decimal(38,0)"))).first()[0]
        return int(whole or 0) / self.n**3

    def identity_error(self, axes: np.ndarray) -> float:
        """Largest absolute entry of the covariance of the rows' coordinates along ``axes``, less the identity; each batch is centred on its own mean."""
        width = axes.shape[1]

        def part(y: np.ndarray) -> np.ndarray:
            w = y @ axes
            mean = w.mean(axis=0)
            w = w - mean
            return np.hstack([w.T @ w + len(y) * np.outer(mean, mean), len(y) * mean[:, None]])

        sums = self._summed(width + 1, part, width) / self.n
        mean = sums[:, width]
        return float(np.abs(sums[:, :width] - np.outer(mean, mean) - np.eye(width)).max())

    def coordinates(self, axes: np.ndarray, shares: list[float], error: float) -> DataFrame:
        """One row a vector and axis."""
        width, n, centre = axes.shape[1], self.n, self.centre

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            step = 1024
            for batch in batches:
                for at in range(0, batch.num_rows, step):
                    part = batch.slice(at, step)
                    exact, rows = centre(part), part.num_rows
                    each = np.repeat(np.arange(rows), width)
                    columns = [
                        part.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, width + 1), rows), pa.int32()), pa.array(np.full(rows * width, n), pa.int64()),
                        pa.array(np.repeat(squares(exact), width).tolist(), pa.int64()), pa.array((exact / n @ axes).reshape(-1)), pa.array(np.tile(shares, rows)), pa.array(np.full(rows * width, error)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in SCHEMA.split(", ")])

        return self.vectors.mapInArrow(run, SCHEMA)


def squares(exact: np.ndarray) -> np.ndarray:
    """Exact sum of squares of each row, in Python's integers where 64 bits might not do."""
    largest = int(np.abs(exact).max(initial=0))
    wide = exact if largest * largest * exact.shape[1] < 1 << 63 else exact.astype(object)
    return (wide * wide).sum(axis=1)


def minres(apply: Product, rhs: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of symmetric, possibly indefinite systems, one a column, after ``steps`` steps in lock step."""
    norm = np.linalg.norm(rhs, axis=0)
    x, v_old, w_old, w_older = (np.zeros_like(rhs) for _ in range(4))
    v = rhs / np.where(norm > 0, norm, 1)
    beta, eta = np.zeros_like(norm), norm.copy()
    c_old, c, s_old, s = np.ones_like(norm), np.ones_like(norm), np.zeros_like(norm), np.zeros_like(norm)
    for _ in range(steps):
        image = apply(v)
        alpha = (v * image).sum(axis=0)
        rest = image - alpha * v - beta * v_old
        beta_next = np.linalg.norm(rest, axis=0)
        open_, second, third = c * alpha - c_old * s * beta, s * alpha + c_old * c * beta, s_old * beta
        first = np.hypot(open_, beta_next)
        live = first > EPS * np.maximum(norm, 1e-300)
        first = np.where(live, first, 1)
        c_old, s_old, c, s = c, s, open_ / first, beta_next / first
        w = (v - third * w_older - second * w_old) / first
        x += np.where(live, c * eta, 0) * w
        eta = np.where(live, -s * eta, 0)
        v_old, v = v, rest / np.where(beta_next > 0, beta_next, 1)
        w_older, w_old, beta = w_old, w, beta_next
    return x


def orthogonal(block: np.ndarray, against: list[np.ndarray]) -> np.ndarray:
    """An orthonormal basis of what a block adds to orthonormal blocks; directions that add nothing beyond rounding are left out."""
    scale = np.linalg.norm(block, axis=0)
    block = block[:, scale > 0] / scale[scale > 0]
    for _ in range(3):
        for basis in against:
            block = block - basis @ (basis.T @ block)
        if not block.shape[1]:
            return block
        left, size, _ = np.linalg.svd(block, full_matrices=False)
        block = left[:, size > 1e-10 * max(1.0, size[0])]
    return block


def leading_pairs(product: Product, dims: int, wanted: int, inner: int = 4, widest: int = 4, rounds: int = 60, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric positive matrix and unit eigenvectors, from products with blocks alone.

    A pair is locked when its residual is at rounding level: within ``8 sqrt(dims)`` units of double precision of the largest eigenvalue, or
    small and no longer falling.  The subspace restarts from its best Ritz vectors at ``widest`` times the wanted number of columns.  At the
    end the locked vectors are measured again by a fresh product, and the search goes on if one is above the bound.
    """
    wanted = min(wanted, dims)
    random = np.random.Generator(np.random.PCG64(seed))
    locked, found, before = np.zeros((dims, 0)), [0.0], np.zeros(0)
    basis = orthogonal(random.standard_normal((dims, wanted)), [])
    image = product(basis)
    for _ in range(rounds):
        values, turn = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        top = max([*values[:1].tolist(), *found])
        bound = 8 * np.sqrt(dims) * EPS * max(top, 1e-300)
        open_ = min(wanted - locked.shape[1], basis.shape[1])
        residual = image[:, :open_] - basis[:, :open_] * values[:open_]
        residual -= locked @ (locked.T @ residual)
        size = np.linalg.norm(residual, axis=0)
        stuck = np.array([s <= 1000 * bound and k < len(before) and s >= before[k] / 2 for k, s in enumerate(size)])
        ready = (size <= bound) | stuck
        done = int(open_ if ready.all() else ready.argmin())
        before, found = size[done:], [*found, *values[:done].tolist()]
        locked = np.hstack([locked, basis[:, :done]])
        kept = basis[:, done:]
        if locked.shape[1] == wanted:
            # a fresh product of all locked vectors: their Ritz pairs and true residuals
            locked = orthogonal(locked, [])
            fresh = product(locked)
            values, turn = np.linalg.eigh((locked.T @ fresh + fresh.T @ locked) / 2)
            values, locked, fresh = values[::-1], locked @ turn[:, ::-1], fresh @ turn[:, ::-1]
            if np.linalg.norm(fresh - locked * values, axis=0).max(initial=0.0) <= 1000 * bound:
                return values, locked
            basis, image, locked, found, before = locked, fresh, np.zeros((dims, 0)), [0.0], np.zeros(0)
            continue
        image, values, residual = image[:, done:], values[done:], residual[:, done:]
        open_ -= done
        if basis.shape[1] + locked.shape[1] > widest * wanted:
            kept, image = kept[:, : open_ + wanted // 2], image[:, : open_ + wanted // 2]
        basis = kept
        ritz, shift = basis[:, :open_], values[:open_]

        def outside(block: np.ndarray, ritz: np.ndarray = ritz) -> np.ndarray:
            for space in (locked, ritz):
                block = block - space @ (space.T @ block)
            return block

        def projected(block: np.ndarray, shift: np.ndarray = shift) -> np.ndarray:
            block = outside(block)
            return outside(product(block) - block * shift)

        # a new direction for each open pair, and chance ones where a correction adds nothing, so that no eigenvector stays hidden
        correction = orthogonal(minres(projected, -outside(residual), inner), [locked, basis])
        missing = min(wanted - locked.shape[1], dims - locked.shape[1] - basis.shape[1]) - correction.shape[1]
        if missing > 0:
            correction = np.hstack([correction, orthogonal(random.standard_normal((dims, missing)), [locked, basis, correction])])
        if correction.shape[1]:
            basis, image = np.hstack([basis, correction]), np.hstack([image, product(correction)])
    raise RuntimeError(f"eigenvectors did not reach double precision in {rounds} rounds")


def whiten(rows: DataFrame, components: int = 32, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Return vec_id, component, n, deviation, whitened, explained and identity_error of every usable vector and component."""
    spark = rows.sparkSession
    usable = integers(rows, scale, None, id_col, vector_col).withColumn("x", F.transform("x", lambda c: c + OFFSET)).withColumn("dims", F.size("x"))
    stored = materialize(usable, "whiten-vectors")
    usual = stored.groupBy("dims").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    if usual is None or not usual["dims"]:
        return spark.createDataFrame([], SCHEMA)
    dims = usual["dims"]
    vectors = stored.where(F.col("dims") == dims).select("vec_id", "x")
    sums = vectors.agg(F.max(F.array_max(F.transform("x", F.abs))), *[F.sum(F.col("x")[j]) for j in range(dims)]).first()
    centred = Centred(vectors, usual["n"], list(sums[1:]), sums[0])
    trace = centred.trace()
    if trace == 0:
        return spark.createDataFrame([], SCHEMA)
    values, axes = leading_pairs(centred.product, dims, components)
    some = values > 64 * dims * EPS * values[0]
    values, axes = values[some], axes[:, some]
    scaled = axes / np.sqrt(values)
    return centred.coordinates(scaled, (values / trace).tolist(), centred.identity_error(scaled))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whiten all embeddings along their 32 first principal components."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
