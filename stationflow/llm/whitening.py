"""Embedding whitening by polarisation: the covariance comes from variances alone.

Entries become integers, so every sum is exact. One job counts the vectors and sums each dimension; a second one sums the
squared centred values of every dimension and of every sum of two dimensions. As
(u + v)^2 - u^2 - v^2 = 2uv, differences of these variances give all covariances, which are assembled for an
eigendecomposition. What meets on the driver is a matrix of the dimensions, whatever the number of vectors.

Centred values are n * x - S (S: the dimension's sum), integers too. In a task they are n * z - r with z = x - floor(S / n) and
r = S - n * floor(S / n), so that numpy adds up squares of small integers z in 64 bits and Python's integers do the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import bounded_batches

#: Fixed values of the contract: an entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Largest integer that an entry may become; beyond it doubles hold no unit places.
LARGEST = 1 << 52
#: Squares of rows below 2 ** 31 / ROWS_AT_ONCE fit in 64 bits together.
ROWS_AT_ONCE = 4096


@dataclass(frozen=True)
class Whitening:
    """What the fit list says: vectors, dimension sums, component vectors (columns), their eigenvalues, total variance."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float


def remaining(embeddings: DataFrame) -> DataFrame:
    """vec_id, v (array of doubles): the rows whose vector is usable.

    Vectors that are null, empty or hold null or non-finite entries go, and so do entries beyond 2 ** 52 / SCALE. Of vectors of
    several lengths the commonest length stays (ties: the longest).
    """
    rows = embeddings.select(F.col("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    odd = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) > LARGEST // SCALE)
    rows = rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & ~F.exists("v", odd))
    lengths = rows.groupBy(F.size("v").alias("length")).agg(F.count("*").alias("n")).agg(F.max(F.struct("n", "length")).alias("best")).first()
    return rows.where(F.size("v") == (lengths.best.length if lengths.best else 0))


def _integers(batch: pa.RecordBatch) -> np.ndarray:
    """Entries of a batch as integers, a row for each vector."""
    column = batch.column("v")
    cells = column.flatten().to_numpy(zero_copy_only=False)
    return (np.floor(SCALE * cells) + SHIFT).astype(np.int64).reshape(batch.num_rows, -1)


def _sum_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of each dimension over a task's rows, with the number of rows under i = -1."""
    n, sums = 0, None
    for batch in batches:
        if batch.num_rows:
            x = _integers(batch)
            part = (x >> 26).sum(axis=0).astype(object) * (1 << 26) + (x & ((1 << 26) - 1)).sum(axis=0).astype(object)
            n, sums = n + len(x), part if sums is None else sums + part
    if n:
        yield _totals([(-1, -1, n), *((i, i, int(s)) for i, s in enumerate(sums))])


def _totals(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    """Exact integers as text for decimal columns."""
    i, j, total = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(list(map(str, total)))], ["i", "j", "total"])


def _exact_squares(z: np.ndarray) -> list[int]:
    """Exact sum of squares of each column."""
    most = int(np.abs(z).max(initial=0))
    if most < 1 << 25:  # 4096 squares below 2 ** 50
        return [int(s) for s in (z * z).sum(axis=0)]
    return [int(s) for s in (z.astype(object) ** 2).sum(axis=0)]


def pair_squares(x: np.ndarray, n: int, sums: list[int]) -> dict[tuple[int, int], int]:
    """Sums over rows x of (n * x_i - S_i) ** 2 under (i, i), and of the squared sums of two such values under (i, j)."""
    floors, rest = zip(*(divmod(s, n) for s in sums), strict=True)
    z = x - np.array(floors, np.int64)
    out: dict[tuple[int, int], int] = {}
    for at in range(0, len(z), ROWS_AT_ONCE):
        part = z[at : at + ROWS_AT_ONCE]
        k, plain = len(part), [int(s) for s in part.sum(axis=0)]

        def centred(square: int, total: int, r: int, k: int = k) -> int:
            return n * n * square - 2 * n * r * total + k * r * r

        for i in range(z.shape[1]):
            squares = _exact_squares(np.concatenate([part[:, i : i + 1], part[:, i : i + 1] + part[:, i + 1 :]], axis=1))
            for step, square in enumerate(squares):
                j = i + step
                more, r = (plain[i], rest[i]) if i == j else (plain[i] + plain[j], rest[i] + rest[j])
                out[i, j] = out.get((i, j), 0) + centred(square, more, r)
    return out


def covariance(totals: dict[tuple[int, int], int], n: int, width: int) -> np.ndarray:
    """Covariances with divisor n from the sums of squares, by polarisation; each is exact before it is rounded."""
    out = np.zeros((width, width))
    for i in range(width):
        for j in range(i, width):
            cross = 2 * totals[i, i] if i == j else totals[i, j] - totals[i, i] - totals[j, j]
            out[i, j] = out[j, i] = float(Fraction(cross, 2 * n**3))
    return out


def _summed(df: DataFrame) -> dict[tuple[int, int], int]:
    """Totals of all tasks: at most one row for each two dimensions."""
    return {(r.i, r.j): int(r.total) for r in df.select("i", "j", F.col("total").cast("decimal(38,0)").alias("total")).groupBy("i", "j").agg(F.sum("total").cast("decimal(38,0)").alias("total")).collect()}


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of `remaining` rows; None without rows. Components without variance (to double precision) are left out."""
    bounded_batches(rows.sparkSession)
    vectors = rows.select("v")
    first = _summed(vectors.mapInArrow(_sum_rows, "i int, j int, total string"))
    n = first.pop((-1, -1), 0)
    if not n:
        return None
    width = len(first)
    sums = [first[i, i] for i in range(width)]

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every: dict[tuple[int, int], int] = {}
        for batch in batches:
            if batch.num_rows:
                for key, total in pair_squares(_integers(batch), n, sums).items():
                    every[key] = every.get(key, 0) + total
        if every:
            yield _totals([(*key, total) for key, total in every.items()])

    v = covariance(_summed(vectors.mapInArrow(squares, "i int, j int, total string")), n, width)
    values, vectors_of = np.linalg.eigh(v)
    order = np.argsort(-values, kind="stable")[:components]
    trace = float(np.trace(v))
    order = order[values[order] > trace * width * np.finfo(float).eps]
    return Whitening(n, sums, vectors_of[:, order], values[order], trace)


def whitened(x: np.ndarray, w: Whitening) -> np.ndarray:
    """x - S / n, unrounded, on each component, over the root of its eigenvalue."""
    return _centred(x, w) @ w.vectors / np.sqrt(w.values)


def _centred(x: np.ndarray, w: Whitening) -> np.ndarray:
    """x - S / n: the integer part is taken off exactly, then the fraction."""
    floors, rest = zip(*(divmod(s, w.n) for s in w.sums), strict=True)
    return (x - np.array(floors, np.int64)) - np.array([r / w.n for r in rest])


def identity_error(rows: DataFrame, w: Whitening) -> float:
    """Largest entry, in absolute value, of the whitened vectors' covariance minus the identity, measured on all rows."""
    size = len(w.values)
    cells = [(a, b) for a in range(size) for b in range(a, size)]

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size + 1))
        for batch in batches:
            if batch.num_rows:
                ones = np.column_stack([np.ones(batch.num_rows), whitened(_integers(batch), w)])
                total += ones.T @ ones
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], ["cells"])

    found = rows.select("v").mapInArrow(products, "cells array<double>").select(F.posexplode("cells").alias("k", "x")).groupBy("k").agg(F.sum("x").alias("x")).collect()
    total = np.zeros((size + 1) ** 2)
    for r in found:
        total[r.k] = r.x
    total = total.reshape(size + 1, size + 1) / w.n
    return max(abs(total[a + 1, b + 1] - total[0, a + 1] * total[0, b + 1] - (a == b)) for a, b in cells)


def _deviation_type(rows: DataFrame, w: Whitening) -> str:
    """long where every deviation provably fits, else decimal(38,0)."""
    ends = rows.agg(F.max(F.array_max("v")).alias("high"), F.min(F.array_min("v")).alias("low")).first()
    most = max(abs(int(SCALE * e) + SHIFT - s // w.n) + 2 for e in (ends.high, ends.low) for s in w.sums)
    return "long" if len(w.sums) * (w.n * most) ** 2 < 1 << 63 else "decimal(38,0)"


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Per remaining row of embeddings (vec_id, embedding) and component: vec_id, component, n, deviation, whitened,
    explained and identity_error, as the contract has them.

    Rows that repeat a vec_id, or have none, stay rows of their own. Without usable vectors, or where none differ, there are no
    rows. deviation is a long, and a decimal where a long could overflow.
    """
    rows = remaining(embeddings)
    w = fit(rows, components)
    columns = "component int, n long, deviation {}, whitened double, explained double, identity_error double"
    if w is None or not len(w.values):
        kind = dict(rows.dtypes)["vec_id"]
        return rows.sparkSession.createDataFrame([], f"vec_id {kind}, {columns.format('long')}")
    error, kind = identity_error(rows, w), _deviation_type(rows, w)
    ids, size = dict(rows.dtypes)["vec_id"], len(w.values)
    explained = w.values / w.trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floors, rest = zip(*(divmod(s, w.n) for s in w.sums), strict=True)
        for batch in batches:
            k = batch.num_rows
            if not k:
                continue
            x = _integers(batch)
            if kind == "long":
                y = (x - np.array(floors, np.int64)) * w.n - np.array(rest, np.int64)
                deviation = pa.array((y * y).sum(axis=1))
            else:
                y = (x - np.array(floors, np.int64)).astype(object) * w.n - np.array(rest, object)
                deviation = pa.array([str(d) for d in (y * y).sum(axis=1)])
            again = pa.array(np.repeat(np.arange(k), size))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(again),
                    pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), k)),
                    pa.array(np.full(k * size, w.n)),
                    deviation.take(again),
                    pa.array(whitened(x, w).ravel()),
                    pa.array(np.tile(explained, k)),
                    pa.array(np.full(k * size, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    out = rows.mapInArrow(project, f"vec_id {ids}, {columns.format('long' if kind == 'long' else 'string')}")
    return out.withColumn("deviation", F.col("deviation").cast(kind))
