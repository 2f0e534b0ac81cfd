"""Embedding whitening with components found by contour integration (FEAST).

The covariance of all vectors is summed up on the executors. Its leading components come
from the matrix (dimensions x dimensions, on the driver): LDL factors count the eigenvalues above a shift (inertia) and
so fix intervals with few of them; in each, quadrature of complex shifted solves round the
interval projects random vectors onto its eigenspace, and Rayleigh-Ritz extracts eigenpairs, again until all that the
inertia counts promise are there. The vectors are projected where they lie.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DecimalType, DoubleType, LongType, StructField, StructType

from .common import cut_lineage

#: x = floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Quadrature nodes on the upper half of a contour, most eigenvalues of an interval, and rounds.
NODES, PER_INTERVAL, ROUNDS = 8, 8, 40
#: Entries from here on have no exact long.
LIMIT = float(1 << 42)
SEED = 11


# --- the matrix -----------------------------------------------------------------------------

def count_above(v: np.ndarray, shift: float) -> int:
    """Eigenvalues of a symmetric matrix above ``shift``: positive pivots of an LDL factorisation (inertia)."""
    a, alpha, positive = v - shift * np.eye(len(v)), (1 + 17 ** 0.5) / 8, 0
    while len(a):
        below = np.abs(a[1:, 0])
        most = below.max() if len(below) else 0.0
        two = False
        if abs(a[0, 0]) < alpha * most:
            r = int(below.argmax()) + 1
            row = np.abs(a[r])
            row[r] = 0.0
            if abs(a[0, 0]) * row.max() < alpha * most * most:
                two = abs(a[r, r]) < alpha * row.max()
                to = 1 if two else 0
                a[[to, r]] = a[[r, to]]
                a[:, [to, r]] = a[:, [r, to]]
        if two:
            positive += 1  # such a block has one eigenvalue of either sign
            c = a[2:, :2]
            a = a[2:, 2:] - c @ np.linalg.solve(a[:2, :2], c.T)
        else:
            positive += bool(a[0, 0] > 0)
            c = a[1:, 0]
            a = a[1:, 1:] - (np.outer(c, c) / a[0, 0] if a[0, 0] else 0.0)
    return positive


def _split(v: np.ndarray, low: float, high: float, want: int, most: int, norm: float) -> float:
    """A bound in (low, high) with ``want`` to ``most`` eigenvalues above it, where there is one, else the highest with ``want``."""
    while high - low > 1e-12 * norm:
        mid = (low + high) / 2
        n = count_above(v, mid)
        if want <= n <= most:
            return mid
        low, high = (mid, high) if n > most else (low, mid)
    return low


def interval_pairs(v: np.ndarray, low: float, high: float, count: int, norm: float, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs of ``v`` in (low, high], by FEAST with a subspace that widens where it does not converge."""
    d, rng = len(v), np.random.default_rng(seed)
    x, w = np.polynomial.legendre.leggauss(NODES)
    angle = np.pi / 2 * (1 - x)
    centre, radius = (low + high) / 2, (high - low) / 2
    shifts = centre + radius * np.exp(1j * angle)
    size, tolerance = min(d, max(2 * count, count + 8)), 1e-12 * norm
    while True:
        y, before = rng.standard_normal((d, size)), np.inf
        for _ in range(ROUNDS):
            q = np.zeros((d, size))
            for z, weight, t in zip(shifts, w, angle):
                q += weight / 2 * (radius * np.exp(1j * t) * np.linalg.solve(z * np.eye(d) - v, y)).real
            q = np.linalg.qr(q)[0]
            e, u = np.linalg.eigh(q.T @ v @ q)  # Rayleigh-Ritz
            y = q @ u
            residual = np.linalg.norm(v @ y - y * e, axis=0)
            inside = (e > low) & (e <= high) & (residual <= max(tolerance, 1e-9 * norm))
            worst = residual[inside].max() if inside.any() else np.inf
            # as many as the inertia says, and no longer getting better
            if inside.sum() == count and worst <= tolerance and (worst >= before / 2 or worst <= tolerance / 100):
                return e[inside], y[:, inside]
            before = worst
        if size == d:
            raise ArithmeticError(f"{int(inside.sum())} of {count} eigenvalues found in ({low}, {high}]")
        size = min(d, 2 * size)


def leading_pairs(v: np.ndarray, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a covariance matrix, falling, and their unit eigenvectors (columns).

    Eigenvalues that double precision cannot tell from zero are left out. Each vector's largest entry is positive."""
    d = len(v)
    v = (v + v.T) / 2
    norm = float(np.abs(v).sum(axis=1).max()) if d else 0.0
    floor = norm * d * np.finfo(float).eps * 4
    total = min(components, count_above(v, floor)) if norm > 0 else 0
    values, vectors, high, done = [], [], norm * (1 + 1e-9), 0
    while done < total:
        want = min(total - done, PER_INTERVAL)
        low = max(floor, _split(v, floor, high, done + want, done + 2 * PER_INTERVAL, norm))
        count = count_above(v, low) - done
        e, y = interval_pairs(v, low, high, count, norm)
        values.append(e[::-1])
        vectors.append(y[:, ::-1])
        high, done = low, done + count
    if not values:
        return np.empty(0), np.empty((d, 0))
    e, y = np.concatenate(values)[:total], np.concatenate(vectors, axis=1)[:, :total]
    return e, y * np.where(np.take_along_axis(y, np.abs(y).argmax(axis=0)[None], 0) < 0, -1.0, 1.0)


# --- the vectors ----------------------------------------------------------------------------

def fit_list(table: DataFrame, vector_col: str) -> DataFrame:
    """Rows whose vector is there and has no null, not-a-number or infinite entry (an empty one has none)."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return table.where(v.isNotNull() & ~F.coalesce(bad, F.lit(True)))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    """Longs x (rows x d) of a list column."""
    c = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), d)
    return np.floor(SCALE * c).astype(np.int64) + SHIFT


def _added(parts: DataFrame, key: str, value: str, d: int) -> dict[int, np.ndarray]:
    """Sums of rows of ``d`` doubles by key, first among some tasks' rows, then of these sums."""
    def total(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("part")  # the same order in every run
        return pd.DataFrame({key: frame[key].iloc[:1], "part": frame["part"].iloc[:1],
                             value: [np.sum(np.stack(frame[value].tolist()), axis=0)]})
    schema = f"{key} int, part long, {value} array<double>"
    parts = parts.withColumn("salt", F.pmod("part", F.lit(256)))
    some = parts.groupBy(key, "salt").applyInPandas(lambda f: total(f), schema)
    return {r[key]: np.array(r[value]) for r in some.groupBy(key).applyInPandas(total, schema).collect()}  # d rows


def _gram_rows(part: int, gram: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(len(gram), dtype=np.int32)), pa.array([part] * len(gram), pa.int64()),
         pa.array(list(gram), pa.list_(pa.float64()))], ["i", "part", "row"])


def _deviation(x: np.ndarray, n: int, sums: np.ndarray) -> list[int]:
    """Exact sum over dimensions of (n x - S)^2 per row."""
    t = n * x - sums
    top = int(np.abs(t).max()) if t.size else 0
    if t.shape[1] * top * top < 1 << 63:
        return (t * t).sum(axis=1).tolist()
    return (t.astype(object) ** 2).sum(axis=1).tolist()


def whiten(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``(id, n, deviation, whitened, explained, identity_error)`` per remaining vector.

    ``whitened`` and ``explained`` are arrays with an entry per component, in falling order of eigenvalue. ``deviation``
    is a decimal(38,0): the exact sum over dimensions of ``(n x - S)^2``. ``identity_error`` is measured on
    the whitened rows, the largest absolute entry of their covariance minus the identity.

    Vectors that are null or hold a null or non-finite entry go. Of the rest the commonest length is the dimension (ties: the
    longer); others are no points of that space and go too. Fewer components come where the covariance has fewer
    eigenvalues above zero: none for equal vectors or a single one, whose arrays are empty and error null. Rows are points of
    their own, whatever their ids. An empty table gives an empty one. Entries beyond ``LIMIT`` in size are an error, as
    the sums would leave the longs. What the driver sees is d sums and a d x d matrix."""
    spark = table.sparkSession
    rows = fit_list(table.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")), "v")
    lengths = rows.groupBy(F.size("v").alias("d")).agg(
        F.count("*").alias("n"), F.max(F.array_max(F.transform("v", lambda c: F.abs(c.cast("double"))))).alias("top"))
    first = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    id_type = rows.schema["id"].dataType
    doubles = ArrayType(DoubleType())
    shape = StructType([StructField("id", id_type), StructField("deviation", DecimalType(38, 0)), StructField("whitened", doubles)])
    out = [F.col("id").alias(id_col), F.lit(first["n"] if first else 0).cast("long").alias("n"), "deviation", "whitened"]
    if first is None or first["d"] == 0:
        return (rows.where(F.size("v") == 0).select("id", F.lit(0).cast("decimal(38,0)").alias("deviation"), F.array().cast(doubles).alias("whitened"))
                .select(*out, F.array().cast(doubles).alias("explained"), F.lit(None).cast("double").alias("identity_error")))
    d, n = first["d"], first["n"]
    if first["top"] * SCALE >= LIMIT:
        raise ValueError(f"entries up to {first['top']} leave the range of exact sums")
    rows = rows.where(F.size("v") == d)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(d, np.int64)
        for batch in batches:
            total += _matrix(batch.column(0), d).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), pa.array(total)], ["i", "s"])
    sums = rows.select("v").mapInArrow(add, "i int, s long").groupBy("i").agg(F.sum("s").alias("s"))
    sums = np.array([r["s"] for r in sums.orderBy("i").collect()], np.int64)  # d rows
    mean = sums / n

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((d, d))
        for batch in batches:
            y = _matrix(batch.column(0), d) - mean
            gram += y.T @ y
        yield _gram_rows(TaskContext.get().partitionId(), gram)
    gram = _added(rows.select("v").mapInArrow(products, "i int, part long, row array<double>"), "i", "row", d)
    v = np.stack([gram[i] for i in range(d)]) / n
    e, vectors = leading_pairs(v, components)
    project = vectors / np.sqrt(e)
    k = len(e)

    def white(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), d)
            w = (x - mean) @ project
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(_deviation(x, n, sums), pa.decimal128(38, 0)),
                 pa.array(list(w), pa.list_(pa.float64()))], shape.names)
    done = cut_lineage(rows.select("id", "v").mapInArrow(white, shape))
    error = None
    if k:
        def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            gram, total = np.zeros((k + 1, k)), np.zeros(k)
            for batch in batches:
                w = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
                gram[:k] += w.T @ w
                gram[k] += w.sum(axis=0)
            yield _gram_rows(TaskContext.get().partitionId(), gram)
        found = _added(done.select("whitened").mapInArrow(again, "i int, part long, row array<double>"), "i", "row", k)
        m = found[k] / n
        cov = np.stack([found[i] for i in range(k)]) / n - np.outer(m, m)
        error = float(np.abs(cov - np.eye(k)).max())
    explained = F.array(*[F.lit(float(x)) for x in e / np.trace(v)]).cast(doubles)
    return done.select(*out, explained.alias("explained"), F.lit(error).cast("double").alias("identity_error"))


def whitening_report(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``whiten`` with one row per vector and component; the deviation as a long (beyond a long it is an error)."""
    w = whiten(table, id_col, vector_col)
    w = w.select(id_col, "n", F.col("deviation").cast("long").alias("deviation"), "explained", "identity_error",
                 F.posexplode("whitened").alias("c", "whitened"))
    return w.select(id_col, (F.col("c") + 1).cast("int").alias("component"), "n", "deviation", "whitened",
                    F.get("explained", F.col("c")).alias("explained"), "identity_error")
