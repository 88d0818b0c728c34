"""Whitening of embeddings by principal components of their exact covariance.

Components become whole numbers, so the scatter matrix of the distinct vectors is exact: tasks
multiply blocks whose sums stay below 2^53 (larger numbers are cut into limbs of 20 bits), and
Spark adds up the cells. :mod:`exact_spectrum` finds its largest eigenvalues and eigenvectors from
the exact characteristic polynomial. What reaches the driver are d (d + 3) / 2 sums, a number per
prime and coefficient, and the components; d is the dimension, whatever the number of vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.exact_spectrum import largest_components
from plumbline.llm.vectors import matrices, packed, unpacked, whole
from plumbline.sources.staging import Staging

SCALE = 64.0
COMPONENTS = 16
_ROWS = 8192  # products of two 20-bit limbs over so many rows stay below 2^53
_LIMBS = 7  # of 32 bits, for sums of products of 62-bit numbers


def _gram(x: np.ndarray) -> np.ndarray:
    """x.T @ x as exact Python integers."""
    limbs, rest = [], x.T
    while not limbs or rest.any():
        small = np.abs(rest).max(initial=0) < 1 << 20
        limbs.append((rest if small else rest & ((1 << 20) - 1)).astype(np.float64))
        rest = np.zeros_like(rest) if small else rest >> 20
    total = np.zeros((x.shape[1], x.shape[1]), object)
    for i, a in enumerate(limbs):
        for j, b in enumerate(limbs):
            total += (a @ b.T).astype(np.int64).astype(object) << 20 * (i + j)
    return total


@dataclass(frozen=True)
class Whitening:
    """A fitted transformation: ``n`` distinct vectors with these ``sums``; ``columns`` hold what a component multiplies.

    ``explained`` are shares of the whole variance, ``identity_error`` the largest entry of the
    whitened vectors' covariance minus the identity, from the exact scatter and the doubles of ``columns``.
    """

    scale: float
    n: int
    sums: tuple[int, ...]
    components: tuple[tuple[float, ...], ...]
    columns: tuple[tuple[float, ...], ...]
    explained: tuple[float, ...]
    identity_error: float

    def apply(self, vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
        """(key, deviation, whitened): a row for each vector of the fitted length that is finite throughout.

        ``deviation`` is the sum over dimensions of (n x - S)^2, null where a long cannot hold it;
        ``whitened`` has a double per component, none if nothing varies.
        """
        sums, columns = np.array(self.sums, object), np.array(self.columns, float).reshape(len(self.columns), len(self.sums)).T
        narrow = max(map(abs, self.sums), default=0) < 2**61
        fitted = self

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at, matrix in matrices(batch.column(column)):
                    if matrix.shape[1] != len(sums) or not fitted.n:
                        continue
                    x = whole(matrix, fitted.scale)
                    most = max(int(x.max(initial=0)), -int(x.min(initial=0)))
                    if narrow and most * fitted.n < 2**61:
                        away = x * fitted.n - sums.astype(np.int64)
                    else:
                        away = x.astype(object) * fitted.n - sums
                    most = max(int(away.max(initial=0)), -int(away.min(initial=0)))
                    squares = away if most * most * len(sums) < 2**63 else away.astype(object)
                    squares = (squares * squares).sum(axis=1)
                    if squares.dtype == object:
                        squares = [value if value < 2**63 else None for value in squares.tolist()]
                    whitened = away.astype(float) @ columns
                    offsets = np.arange(len(at) + 1, dtype=np.int32) * whitened.shape[1]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(key).take(pa.array(at)), pa.array(squares, pa.int64()), pa.ListArray.from_arrays(offsets, whitened.ravel())],
                        names=[key, "deviation", "whitened"],
                    )

        kind = vectors.schema[key].dataType.simpleString()
        return vectors.select(key, column).mapInArrow(rows, f"`{key}` {kind}, deviation long, whitened array<double>")


def fit(vectors: DataFrame, *, column: str = "embedding", scale: float = SCALE, components: int = COMPONENTS, staging: Staging | None = None) -> Whitening:
    """Fit on each distinct vector floor(scale * v) once; vectors that are null or not finite throughout take no part.

    The space is that of the length most distinct vectors have (of several, the longest); others
    are not fitted, nor transformed. Only components of positive variance count, which is known exactly.
    """
    spark = vectors.sparkSession

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, matrix in matrices(batch.column(0)):
                for array in packed(whole(matrix, scale)):
                    d = pa.array(np.full(len(array), matrix.shape[1], np.int32))
                    yield pa.RecordBatch.from_arrays([d, array], names=["d", "packed"])

    distinct = vectors.select(column).mapInArrow(pack, "d int, packed binary").distinct()
    distinct = (staging or Staging(spark)).put(distinct, "distinct-vectors")
    most = distinct.groupBy("d").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    d, n = (most[0]["d"], most[0]["n"]) if most else (0, 0)
    sums, scatter = _moments(distinct.where(F.col("d") == d), d) if d else ([], [])
    scatter = [[n * scatter[i][j] - sums[i] * sums[j] for j in range(d)] for i in range(d)]
    trace = sum(scatter[k][k] for k in range(d))
    found = largest_components(spark, scatter, components)
    columns = tuple(component.scaled for component in found)
    return Whitening(
        scale, n, tuple(sums), tuple(component.vector for component in found), columns,
        tuple(component.value / (trace << component.bits) for component in found), _identity_error(scatter, columns),
    )


def _moments(distinct: DataFrame, d: int) -> tuple[list[int], list[list[int]]]:
    """Sums and sums of products of the packed vectors, exact."""
    parts = [f"p{k}" for k in range(_LIMBS)]
    upper = np.triu_indices(d)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums = np.zeros((d, d), object), np.zeros(d, object)
        for batch in batches:
            for x in unpacked(batch.column(0), d):
                for lo in range(0, len(x), _ROWS):
                    total += _gram(x[lo : lo + _ROWS])
                    sums += x[lo : lo + _ROWS].astype(object).sum(axis=0)
        cells = [*total[upper], *sums]
        limbs = [[int(v) >> 32 * k if k == _LIMBS - 1 else int(v) >> 32 * k & 0xFFFFFFFF for v in cells] for k in range(_LIMBS)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(cells)), pa.int64()), *(pa.array(p, pa.int64()) for p in limbs)], names=["cell", *parts])

    cells = distinct.select("packed").mapInArrow(add, "cell long, " + ", ".join(f"{p} long" for p in parts))
    rows = cells.groupBy("cell").agg(*(F.sum(p).alias(p) for p in parts)).collect()
    values = {row["cell"]: sum(row[p] << 32 * k for k, p in enumerate(parts)) for row in rows}
    products, scatter = len(upper[0]), [[0] * d for _ in range(d)]
    for cell, (i, j) in enumerate(zip(*map(np.ndarray.tolist, upper))):
        scatter[i][j] = scatter[j][i] = values[cell]
    return [values[products + k] for k in range(d)], scatter


def _identity_error(scatter: list[list[int]], columns: tuple[tuple[float, ...], ...]) -> float:
    """Covariance of the whitened vectors, columns' * scatter * columns, minus the identity, in exact numbers."""
    ratios = [[value.as_integer_ratio() for value in column] for column in columns]
    bits = max((den.bit_length() - 1 for column in ratios for _, den in column), default=0)
    exact = np.array([[num << bits + 1 - den.bit_length() for num, den in column] for column in ratios], object).reshape(len(columns), len(scatter))
    covariance = exact @ np.array(scatter, object).reshape(len(scatter), len(scatter)) @ exact.T if len(columns) else exact[:, :0]
    one = 1 << 2 * bits
    return max((abs(int(value) - one * (i == j)) / one for i, row in enumerate(covariance) for j, value in enumerate(row)), default=0.0)


def whitened_rows(vectors: DataFrame, *, key: str = "vec_id", column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row per vector and component: key, component (from 1), n, deviation, whitened, explained, identity_error.

    Null and repeated keys are rows as others; no other column is read. An empty table, and
    vectors that are all alike, give no rows.
    """
    fitted = fit(vectors, column=column, components=components)
    explained = F.array(*map(F.lit, fitted.explained)) if fitted.explained else F.array().cast("array<double>")
    long = fitted.apply(vectors, key, column).select(key, "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return long.select(
        key, (F.col("at") + 1).alias("component"), F.lit(fitted.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(fitted.identity_error).alias("identity_error"),
    )
