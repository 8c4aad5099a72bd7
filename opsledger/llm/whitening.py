"""Whitening of embeddings by a cyclic Jacobi eigendecomposition of their covariance.

Vectors are turned into whole numbers, and each distinct one is counted once. Sums, then the
scatter about their mean, are added up in tasks and by Spark; the driver gets one number a pair
of dimensions, whatever the number of rows. There cyclic Jacobi rotations work on both sides of
the matrix until each off-diagonal entry vanishes beside its two diagonal ones, a test that keeps small
eigenvalues accurate too. The components, sorted, go back to the tasks as a small matrix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsledger.llm.common import apart, dropped, stored, table

SCALE = 256
COMPONENTS = 4
SWEEPS = 60
FINITE = "size({0}) > 0 and forall({0}, v -> v is not null and not isnan(v) and abs(v) < double('infinity'))"


def usable(vectors: DataFrame, column: str) -> DataFrame:
    """The rows of ``vectors`` whose ``column`` is an array of finite numbers of the commonest length (of equally common ones the greatest), cast to doubles.

    Vectors of other lengths have no covariance with those, so they take no part, as null and empty ones.
    """
    rows = vectors.withColumn(column, F.col(column).cast("array<double>")).where(F.expr(FINITE.format(column)))
    most = rows.groupBy(F.size(column).alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    return rows.where(F.size(column) == (most["dim"] if most else 0))


def jacobi(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of the symmetric matrix ``a``, falling, and unit eigenvectors as columns, whose largest entry is positive.

    Sweeps over all pairs of rows (p, q); each rotation makes the entry at (p, q) zero. A sweep
    without a rotation ends them.
    """
    a, n = np.array(a, np.float64), len(a)
    v = np.eye(n)
    for _ in range(SWEEPS):
        turned = False
        for p in range(n - 1):
            for q in range(p + 1, n):
                x = a[p, q]
                if abs(x) <= np.finfo(float).eps * np.sqrt(abs(a[p, p] * a[q, q])):
                    continue
                turned = True
                theta = (a[q, q] - a[p, p]) / (2 * x)
                t = 1.0 if theta == 0 else np.sign(theta) / (abs(theta) + np.hypot(theta, 1))
                c = 1 / np.hypot(t, 1)
                s = t * c
                ap, aq = a[p].copy(), a[q].copy()
                app, aqq = ap[p] - t * x, aq[q] + t * x
                rp, rq = c * ap - s * aq, s * ap + c * aq
                a[p], a[:, p], a[q], a[:, q] = rp, rp, rq, rq
                a[p, p], a[q, q], a[p, q], a[q, p] = app, aqq, 0.0, 0.0
                v[:, p], v[:, q] = c * v[:, p] - s * v[:, q], s * v[:, p] + c * v[:, q]
        if not turned:
            break
    else:
        raise RuntimeError("the rotations did not settle")
    values = np.diag(a)
    order = np.argsort(-values, kind="stable")
    v = v[:, order]
    return values[order], v * np.where(v[np.abs(v).argmax(axis=0), np.arange(n)] < 0, -1.0, 1.0)


@dataclass
class Whitening:
    """n vectors with sums ``sums``; ``components`` as columns, their eigenvalues, and shares of the trace; the measured error."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    components: np.ndarray
    explained: np.ndarray
    identity_error: float | None

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exactly: whole numbers of 64 bits where they fit, else Python's."""
        most = self.n * max(1, int(np.abs(x.astype(float)).max(initial=0))) + int(max(map(abs, self.sums.tolist()), default=0))
        kind = np.int64 if most < 1 << 62 else object
        return x.astype(kind) * self.n - self.sums.astype(kind)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """x about the mean, on the components, over their deviations; NaN where a component has none."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.values > 0, (self.deviations(x).astype(float) / self.n) @ self.components / np.sqrt(np.maximum(self.values, 0)), np.nan)


def _rows(a: pa.Array, kind: str = "int64") -> np.ndarray:
    """An Arrow array of lists of equal length as a matrix."""
    return a.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(a), -1)


def _summed(df: DataFrame, f, kind: str) -> dict[tuple[int, int], float]:
    """``f`` of each batch of vectors, a matrix, added up entry by entry. A task sends one row an entry, of which its partition's are added before."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                m = f(_rows(b["x"]))
                total = m if total is None else total + m
        if total is not None:
            i, j = np.indices(total.shape).reshape(2, -1)
            values = total.ravel().tolist()
            yield pa.RecordBatch.from_pydict({"i": i.astype(np.int32), "j": j.astype(np.int32), "v": pa.array([str(x) for x in values] if kind != "double" else values)})

    out = df.select("x").mapInArrow(part, f"i int, j int, v {'string' if kind != 'double' else kind}").groupBy("i", "j").agg(F.sum(F.col("v").cast(kind)).alias("v"))
    return {(r["i"], r["j"]): r["v"] for r in out.collect()}


def _matrix(entries: dict, shape: tuple[int, int]) -> np.ndarray:
    out = np.zeros(shape)
    for (i, j), v in entries.items():
        out[i, j] = v
    return out


def fit(whole: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of vectors ``x`` (arrays of longs of one length) of ``whole``, each distinct one counted once; none if there are no rows.

    A component is without variance, and whitens to null, where its eigenvalue is below the rounding of the trace.
    """
    paths: list[str] = []
    once = stored(whole.select("x").distinct(), paths)

    def sums_of(x: np.ndarray) -> np.ndarray:
        small = len(x) * max(1, int(np.abs(x.astype(float)).max())) < 1 << 62
        return np.vstack([x.sum(axis=0, dtype=np.int64 if small else object).astype(object), np.full(x.shape[1], len(x), object)])

    entries = _summed(once, sums_of, "decimal(38,0)")
    if not entries:
        dropped(whole.sparkSession, paths)
        return None
    d = len(entries) // 2
    n, sums = int(entries[1, 0]), np.array([int(entries[0, k]) for k in range(d)], object)
    w = Whitening(n, sums, np.zeros(0), np.zeros((d, 0)), np.zeros(0), None)
    w.sums = sums.astype(np.int64) if max(map(abs, sums.tolist())) < 1 << 62 else sums

    def scatter(x: np.ndarray) -> np.ndarray:
        c = w.deviations(x).astype(float) / w.n
        return c.T @ c

    v = _matrix(_summed(once, scatter, "double"), (d, d)) / n
    values, vectors = jacobi((v + v.T) / 2)
    trace = float(np.trace(v))
    k = min(components, d)
    values, w.components = values[:k], vectors[:, :k]
    w.values = np.where(values > d * np.finfo(float).eps * trace, values, 0.0)
    w.explained = w.values / trace if trace > 0 else np.full(k, np.nan)

    def spread(x: np.ndarray) -> np.ndarray:
        y = np.nan_to_num(w.whitened(x))
        return y.T @ y

    some = w.values > 0
    if some.any():
        w.identity_error = float(np.abs(_matrix(_summed(once, spread, "double"), (k, k)) / n - np.eye(k))[np.ix_(some, some)].max())
    dropped(whole.sparkSession, paths)
    return w


def whole_numbers(column: str) -> str:
    """SQL of a vector of doubles as longs; numbers past 64 bits stay at their end."""
    return f"transform({column}, v -> cast(greatest(least(floor(cast({SCALE} * v as double)), 9223372036854775807), -9223372036854775808) as bigint) + 0)"


def whitened(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> tuple[DataFrame, Whitening | None]:
    """The usable rows of ``vectors`` with ``whitened`` (a double for each component) and ``deviation`` (n * x - sums, squared and added up), and the whitening.

    Rows whose vector is null, empty, of another length than most, or holds a null or non-finite
    entry go. Rows that repeat are kept, and counted once in the fit. A component without
    variance is null; so is a deviation past 64 bits. No usable row gives an empty result. Other
    columns are kept, whatever their names; those named like a result are replaced.
    """
    back, held = apart(vectors, [column], ["whitened", "deviation"])
    rows = usable(held, column).withColumn("x", F.expr(whole_numbers(column)))
    w = fit(rows, components)

    @F.arrow_udf("struct<whitened: array<double>, deviation: bigint>")
    def apply(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for a in parts:
            x = _rows(a)
            y = w.whitened(x)
            dev = w.deviations(x)
            most = int(np.abs(dev).max(initial=0))
            if most and x.shape[1] * most * most >= 1 << 63:
                dev = dev.astype(object)
            total = [None if t >= 1 << 63 else t for t in (dev * dev).sum(axis=1).tolist()]
            flat = pa.array(y.ravel(), pa.float64(), from_pandas=True)
            ends = pa.array(np.arange(len(x) + 1) * y.shape[1], pa.int32())
            yield pa.StructArray.from_arrays([pa.ListArray.from_arrays(ends, flat), pa.array(total, pa.int64())], ["whitened", "deviation"])

    if w is None:
        return rows.limit(0).select(*back, F.lit(None).cast("array<double>").alias("whitened"), F.lit(None).cast("long").alias("deviation")), None
    out = rows.withColumn("out", apply("x"))
    return out.select(*back, F.col("out.whitened").alias("whitened"), F.col("out.deviation").alias("deviation")), w


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, w = whitened(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    shares = F.array(*[F.lit(None if w is None or np.isnan(x) else float(x)).cast("double") for x in (w.explained if w else [])]).cast("array<double>")
    out = rows.select("vec_id", F.lit(w.n if w else 0).cast("long").alias("n"), "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", "whitened", shares[F.col("at")].alias("explained"), F.lit(w.identity_error if w else None).cast("double").alias("identity_error"))
