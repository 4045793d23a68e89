"""Operator 13: embedding whitening from variances alone (polarisation).

A covariance is half of what the variance of a sum of two dimensions exceeds the
sum of their variances by. So only squares are added up: of every centred dimension
and of the sum of every pair of dimensions. Entries are integers, and the squares
are summed exactly: tasks add 64-bit integers (Python integers where these could
overflow) and Spark adds the tasks' sums as decimals. Centring first by a whole
number near the mean and then by the exact remainder loses nothing. The matrix, as
large as the square of the dimensions whatever the rows, is decomposed on the driver.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meeple.llm.common import let_go, picked, stored, table

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
BATCH = 2048  # vectors whose pair sums are made at once
SMALL = 1 << 22  # centred entries below this are squared as 64-bit integers


def integer_vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, x array<bigint>) of the rows(vec_id, embedding) whose vector has no null
    and no non-finite entry: x = floor(64 c) + 1000000."""
    c = F.col("embedding").cast("array<double>")
    bad = F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    x = F.transform(c, lambda v: F.floor(v * SCALE).cast("long") + SHIFT)
    return rows.filter(F.col("embedding").isNotNull() & ~bad).select("vec_id", x.alias("x"))


def _matrix(b: pa.RecordBatch) -> np.ndarray:
    x = b.column("x")
    return x.flatten().to_numpy().reshape(b.num_rows, -1)


def _decimals(values: list) -> pa.Array:
    return pa.array([decimal.Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per dimension the sum of x, and the count in dimension -1."""
    n, total = 0, None
    for b in batches:
        if b.num_rows:
            x = _matrix(b)
            safe = np.abs(x).max(initial=0) < 1 << 40
            part = (x if safe else x.astype(object)).sum(axis=0).astype(object)
            n, total = n + b.num_rows, part if total is None else total + part
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([-1, *range(len(total))], pa.int32()), _decimals([n, *total])],
                                         names=["i", "total"])


def _squares(pivot: list[int]):
    """Per dimension i (j = i) the sum of squared centred values, and per pair i < j
    that of the squared sums of both."""
    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        d, at = len(pivot), np.array(pivot, object)
        total = np.zeros(d * (d + 1) // 2, object)
        some = False
        for b in batches:
            for k in range(0, b.num_rows, BATCH):
                x, some = _matrix(b.slice(k, BATCH)), True
                y = (x - np.array(pivot, np.int64) if max(map(abs, pivot)) < 1 << 60 and np.abs(x).max() < 1 << 60
                     else x.astype(object) - at)
                if y.dtype == object or np.abs(y).max() >= SMALL:
                    y = y.astype(object)
                columns = np.ascontiguousarray(y.T)
                place = 0
                for i in range(d):
                    s = columns[i:] + columns[i]
                    s[0] = columns[i]
                    part = (s * s).sum(axis=1)
                    total[place:place + d - i] += part.astype(object)
                    place += d - i
        if some:
            i, j = np.triu_indices(d)
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                                              _decimals(list(total))], names=["i", "j", "total"])
    return squares


class Fit:
    """What whitening needs: n, the exact sums S, the components kept and their shares."""

    def __init__(self, n: int, sums: list[int], squares: dict[tuple[int, int], int], components: int):
        d = len(sums)
        self.n, self.pivot = n, [s // n for s in sums]
        self.rest = [s - n * p for s, p in zip(sums, self.pivot, strict=True)]  # S - n * pivot, below n

        def variation(i: int, j: int) -> int:
            """n times the sum of squares of n*(x - mean), of dimension i or of i + j."""
            r = self.rest[i] + (self.rest[j] if j != i else 0)
            return n * squares[i, j] - r * r

        own = [variation(i, i) for i in range(d)]
        cov = np.zeros((d, d))
        for i in range(d):
            cov[i, i] = float(Fraction(own[i], n * n))
            for j in range(i + 1, d):
                cov[i, j] = cov[j, i] = float(Fraction(variation(i, j) - own[i] - own[j], 2 * n * n))
        self.covariance = cov
        values, vectors = np.linalg.eigh(cov)
        values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
        vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), range(vectors.shape[1])] < 0, -1, 1)
        self.values, trace = values, float(np.trace(cov))
        self.alive = values > max(trace, 0) * 1e-13  # no variance: nothing to divide by
        self.explained = np.where(self.alive, values, 0) / trace if trace > 0 else np.full(len(values), np.nan)
        self.project = np.where(self.alive, vectors / np.sqrt(np.where(self.alive, values, 1)), np.nan)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Rows of x-vectors on the components."""
        return self.centred(x) @ self.project

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - np.array(self.pivot, np.int64)).astype(np.float64) - np.array(self.rest, np.float64) / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n*x - S)^2, exact; None beyond 64 bits."""
        y = x - np.array(self.pivot, np.int64)
        if (int(np.abs(y).max(initial=0)) + 1) ** 2 * self.n ** 2 * max(1, x.shape[1]) < 1 << 62:
            v = y * self.n - np.array(self.rest, np.int64)
            return list((v * v).sum(axis=1))
        v = y.astype(object) * self.n - np.array(self.rest, object)
        return [int(s) if s < 1 << 63 else None for s in (v * v).sum(axis=1)]


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """The fit over the distinct rows of vectors(x), all of one length; None without any."""
    sums = {r.i: int(r.total) for r in vectors.mapInArrow(_sums, "i int, total decimal(38,0)")
            .groupBy("i").agg(F.sum("total").alias("total")).collect()}
    n, d = sums.pop(-1, 0), len(sums)
    if not n or not d:
        return None
    pivot = [sums[i] // n for i in range(d)]
    squares = {(r.i, r.j): int(r.total) for r in
               vectors.mapInArrow(_squares(pivot), "i int, j int, total decimal(38,0)")
               .groupBy("i", "j").agg(F.sum("total").alias("total")).collect()}  # d * (d + 1) / 2 rows
    return Fit(n, [sums[i] for i in range(d)], squares, components)


def identity_error(vectors: DataFrame, model: Fit) -> float | None:
    """Largest entry of the covariance of the whitened fit list minus the identity."""
    alive = np.flatnonzero(model.alive)
    if not len(alive):
        return None

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros((len(alive) + 1, len(alive))), False
        for b in batches:
            if b.num_rows:
                z, some = model.whitened(_matrix(b))[:, alive], True
                total += np.concatenate([z.T @ z, z.sum(axis=0)[None]])
        if some:
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())],
                                             names=["i", "j", "total"])
    got = np.zeros((len(alive) + 1, len(alive)))
    for r in vectors.mapInArrow(products, "i bigint, j bigint, total double").groupBy("i", "j").agg(
            F.sum("total").alias("total")).collect():
        got[r.i, r.j] = r.total / model.n
    return float(np.abs(got[:-1] - np.outer(got[-1], got[-1]) - np.eye(len(alive))).max())


RESULT = ("component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")


def _projected(model: Fit, error: float | None):
    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        k = len(model.values)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                b = whole.slice(at, BATCH)
                x, rows = _matrix(b), np.repeat(np.arange(b.num_rows), k)
                n = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [b.column("vec_id").take(pa.array(rows)),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), b.num_rows)),
                     pa.array(np.full(n, model.n)),
                     pa.array(model.deviations(x), pa.int64()).take(pa.array(rows)),
                     pa.array(model.whitened(x).ravel(), pa.float64(), from_pandas=True),
                     pa.array(np.tile(model.explained, b.num_rows), pa.float64(), from_pandas=True),
                     pa.array([error] * n, pa.float64())],
                    names=["vec_id", *(f.split()[0] for f in RESULT.split(", "))])
    return projected


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row per row of rows(vec_id, embedding) and component, ``components`` at most:
    vec_id, component, n, deviation, whitened, explained, identity_error.

    Dropped: null vectors, vectors with null or non-finite entries, and vectors of
    another length than most have (of equally many, the longest counts; without
    entries there is nothing to whiten). The fit takes each distinct vector once;
    repeated rows get rows of their own. A deviation beyond 64 bits is null, and so
    is ``whitened`` on a component without variance (one distinct vector has none
    that varies). An empty table gives no row.
    """
    rows = picked(rows, "vec_id", "embedding")
    kind = dict(rows.dtypes)["vec_id"]
    spark = rows.sparkSession
    all_x = integer_vectors(rows)
    sizes = all_x.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).filter("d > 0")
    most = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    schema = f"vec_id {kind}, {RESULT}"
    if most is None:
        return spark.createDataFrame([], schema)
    kept = all_x.filter(F.size("x") == most.d)
    distinct = stored(kept.select("x").distinct(), "whitening-fit")
    model = fit(distinct, components)
    return kept.mapInArrow(_projected(model, identity_error(distinct, model)), schema)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
