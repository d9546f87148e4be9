"""Whitening of vectors by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

Entries become whole numbers, ``floor(scale * c) + shift``, so sums are exact.  X is the matrix of the rows
less their mean.  Rows are written once to the shared folder as blocks of whole numbers; each step of the
bidiagonalisation is one pass over the blocks:

    u = X v - beta u'      and in the same pass      z = X' u

``u`` has an entry per row and is never kept: it is X times a short vector p, so what a pass needs to form it
again is p, and its products with all earlier ones follow from z.  Both sides are reorthogonalised in full,
twice: v against all earlier v directly, u against all earlier u by P and Z = X'U.  A step that ends in an
invariant subspace (equal eigenvalues, fewer rows than dimensions) goes on from a new direction, orthogonal
to all so far.  Up to ``FULL`` dimensions all steps are made, so the small bidiagonal matrix holds the whole
spectrum; beyond, the passes end as soon as the wanted singular vectors have converged to double precision.
Its singular value decomposition gives the components and their deviations.

A pass yields one short vector per task; these are added up in ``LANES`` tasks and then on the driver, in the
order of tasks, so what the driver gets has a fixed bound and reruns agree.

Defined results: rows whose vector is null, empty, or holds null or non-finite entries take no part, nor do
vectors of another length than the most frequent one (of equally frequent ones the longest); null and
repeated ids are rows of their own; entries beyond 2**40 after scaling count as 2**40; components whose
eigenvalue is 0 to double precision don't exist, so equal rows, a single row and an empty table give none;
``deviation`` is null where it doesn't fit 64 bits.  Extra columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marisight.llm._shared import written
from marisight.llm.maxscore import usable

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
#: up to so many dimensions all steps are made
FULL = 1024
#: tasks that add up what passes yield
LANES = 16
_MOST = 1 << 40
_HIGH = 20
_BLOCK = 4096
_EPS = float(np.finfo(np.float64).eps)


def _total(blocks: DataFrame, kernel: Callable[[pa.RecordBatch], np.ndarray]) -> list[np.ndarray]:
    """Sums of the kernel's vectors over all batches: at most ``LANES`` of them, to be added in this order."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                now = kernel(batch)
                total = now if total is None else total + now
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), pa.array([total.tobytes()], pa.binary())], names=["part", "total"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((p, t) for b in batches for p, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        if rows:
            total = sum(np.frombuffer(t, kind) for _, t in rows)
            yield pa.RecordBatch.from_arrays([pa.array([rows[0][0]]), pa.array([total.tobytes()], pa.binary())], names=["part", "total"])

    kind = kernel.kind
    lanes = blocks.mapInArrow(partial, "part long, total binary").repartition(LANES).mapInArrow(added, "part long, total binary")
    return [np.frombuffer(r.total, kind) for r in sorted(lanes.collect(), key=lambda r: r.part)]


def _kernel(kind: str):
    def mark(f):
        f.kind = kind
        return f

    return mark


def _whole(column: pa.Array, width: int, scale: float, shift: int) -> np.ndarray:
    values = np.asarray(column.flatten().cast(pa.float64())).reshape(-1, width)
    return np.clip(np.floor(scale * values), -_MOST, _MOST).astype(np.int64) + shift


@dataclass
class Bidiagonal:
    """What the steps leave on the driver: a row per step of right vectors, of p and of X'u; diagonal and superdiagonal."""

    v: list[np.ndarray] = field(default_factory=list)
    p: list[np.ndarray] = field(default_factory=list)
    z: list[np.ndarray] = field(default_factory=list)
    alpha: list[float] = field(default_factory=list)
    beta: list[float] = field(default_factory=list)

    def svd(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.linalg.svd(np.diag(self.alpha) + np.diag(self.beta[: len(self.alpha) - 1], 1))


def bidiagonal(product: Callable[[np.ndarray], tuple[np.ndarray, float]], width: int, wanted: int, full: int = FULL, seed: int = 7) -> Bidiagonal:
    """Steps of the bidiagonalisation; ``product(p)`` is one pass: X'Xp, and the square of Xp's length."""
    rng = np.random.default_rng(seed)
    out = Bidiagonal()

    def against(w: np.ndarray) -> np.ndarray:
        for _ in range(2 * bool(out.v)):
            known = np.array(out.v)
            w = w - known.T @ (known @ w)
        return w

    def anew() -> np.ndarray:
        w = against(rng.standard_normal(width))
        return w / np.linalg.norm(w)

    v, beta, most = anew(), 0.0, 0.0
    while True:
        p = v - beta * out.p[-1] if beta else v
        z, square = product(p)
        for _ in range(2 * bool(out.p)):
            known = np.array(out.p) @ z  # the products with all earlier u
            p = p - np.array(out.p).T @ known
            z = z - np.array(out.z).T @ known
            square -= float(known @ known)
        alpha = math.sqrt(max(square, 0.0))
        most = max(most, alpha, beta)
        if alpha <= 16 * width * _EPS * most:  # Xv lies in the span of the earlier u
            alpha, p, z = 0.0, np.zeros(width), np.zeros(width)
        else:
            p, z = p / alpha, z / alpha
        out.v.append(v)
        out.p.append(p)
        out.z.append(z)
        out.alpha.append(alpha)
        if len(out.v) == width:
            return out
        w = against(z - alpha * v)
        beta = float(np.linalg.norm(w))
        if beta <= 16 * width * _EPS * most:
            beta, v = 0.0, anew()
        else:
            v = w / beta
        out.beta.append(beta)
        if width > full and len(out.v) >= 4 * wanted and beta:
            left, singular, _ = out.svd()
            if beta * np.abs(left[-1, :wanted]).max() <= 16 * _EPS * singular[0]:
                return out


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: float = SCALE, shift: int = SHIFT, vec_id: str = "vec_id", vector: str = "embedding", full: int = FULL) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every row that takes part."""
    spark = vectors.sparkSession
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector")).where(usable(F.col("vector")))
    found = rows.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    if found is None:
        return spark.createDataFrame([], schema)
    width, n = found["width"], found["count"]
    rows = rows.where(F.size("vector") == width)

    @_kernel("<i8")
    def halves(batch: pa.RecordBatch) -> np.ndarray:
        x = _whole(batch.column(1), width, scale, shift)
        return np.r_[(x >> _HIGH).sum(0), (x & (1 << _HIGH) - 1).sum(0)]

    total = _total(rows, halves)
    parts = [sum(int(t[i]) for t in total) for i in range(2 * width)]
    sums = [(parts[i] << _HIGH) + parts[width + i] for i in range(width)]
    base = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.int64)
    mean = rest / n  # of the entries less base, in [0, 1)

    def blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, _BLOCK):
                part = batch.slice(lo, _BLOCK)
                x = _whole(part.column(1), width, scale, shift) - base
                size = 4 if np.abs(x).max(initial=0) < 1 << 31 else 8
                ids = pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), part.column(0).cast(pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, pa.array([x.astype(f"<i{size}").tobytes()], pa.binary()), pa.array([size], pa.int32())], names=["ids", "block", "size"])

    blocks = written(rows.mapInArrow(blocked, "ids array<long>, block binary, size int"), "vectors")

    def matrices(batch: pa.RecordBatch, block: int, size: int) -> Iterator[np.ndarray]:
        for data, width_of in zip(batch.column(block), batch.column(size).to_pylist()):
            yield np.frombuffer(data.as_buffer(), f"<i{width_of}").reshape(-1, width)

    plain = blocks.select("block", "size")

    def product(p: np.ndarray) -> tuple[np.ndarray, float]:
        @_kernel("<f8")
        def step(batch: pa.RecordBatch) -> np.ndarray:
            total = np.zeros(width + 1)
            for x in matrices(batch, 0, 1):
                centred = x - mean
                u = centred @ p
                total[:width] += u @ centred
                total[width] += u @ u
            return total

        total = sum(_total(plain, step))
        return total[:width], float(total[width])

    made = bidiagonal(product, width, components, full)
    _, singular, right = made.svd()
    keep = int((singular[:components] > 16 * width * _EPS * max(singular[0], 1e-300)).sum()) if n > 1 else 0
    if not keep:
        return spark.createDataFrame([], schema)
    axes = right[:keep] @ np.array(made.v)
    axes *= np.sign(axes[np.arange(keep), np.abs(axes).argmax(1)])[:, None]
    value = singular[:keep] ** 2 / n
    to_white = (axes / np.sqrt(value)[:, None]).T

    @_kernel("<f8")
    def moments(batch: pa.RecordBatch) -> np.ndarray:
        total = np.zeros(keep * keep + keep + 1)
        for x in matrices(batch, 0, 1):
            centred = x - mean
            y = centred @ to_white
            total += np.r_[(y.T @ y).ravel(), y.sum(0), np.square(centred).sum()]
        return total

    total = sum(_total(plain, moments)) / n
    at = total[keep * keep : -1]
    error = float(np.abs(total[: keep * keep].reshape(keep, keep) - np.outer(at, at) - np.eye(keep)).max())
    explained = value / total[-1]

    def output(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x in zip(batch.column(0), matrices(batch, 1, 2)):
                m = len(x)
                far = float(np.abs(x).max(initial=0) + 1.0) * n
                if far * far * width < float(1 << 62):
                    deviation = pa.array(np.square(x.astype(np.int64) * n - rest).sum(1))
                else:
                    exact = [sum(d * d for d in row) for row in (x.astype(object) * n - rest.astype(object)).tolist()]
                    deviation = pa.array([d if d < 1 << 63 else None for d in exact], pa.int64())
                of = pa.array(np.repeat(np.arange(m), keep))
                columns = [ids.values.take(of), pa.array(np.tile(np.arange(1, keep + 1, dtype=np.int32), m)), pa.array(np.full(m * keep, n, np.int64)), deviation.take(of)]
                columns += [pa.array(((x - mean) @ to_white).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * keep, error))]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return blocks.mapInArrow(output, schema)


def op12_vector_whitening(spark, sf_dir: str) -> DataFrame:
    """The embeddings' leading components; see the module."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
