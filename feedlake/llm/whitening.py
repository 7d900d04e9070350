"""Whitening of embeddings by their principal components.

Entries are taken to whole numbers (``floor(scale * c)``), so counts, sums and deviations
are exact. The fit list is each distinct vector once: a distinct aggregation with map-side
combining, so copies of one vector meet nowhere unreduced. Sums per dimension are added in
Spark; then blockwise QR reduces the centred rows: a task folds its batches into one upper
triangle, and triangles are stacked and reduced sixteen at a time until one is left, which
is no larger than the dimension squared. ``bidiagonal`` finds the singular values of that
triangle by dqds and the directions by twisted factorisations. A last pass projects.

Defined cases: rows whose vector is null or holds null or non-finite entries are left out;
so are rows of another length than the commonest (of equally common ones the longest) and
empty vectors. Rows that repeat, or lack an id, give rows of their own. Entries beyond a
long take its ends; a deviation beyond a long is null. Components whose variance is zero to
rounding do not exist, so a table of one distinct vector, or an empty one, gives no rows.
Of components of equal variance any orthonormal choice is right. Other columns are ignored.
"""

from __future__ import annotations

import decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.bidiagonal import right_vectors
from feedlake.llm.common import map_arrow, written

SCALE = 256
COMPONENTS = 4
FAN = 16
SAFE = 1 << 62


def clean_vectors(table: DataFrame, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and x (array of long) of the rows that count."""
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = table.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")) \
        .where(F.col("v").isNotNull() & (F.size("v") > 0)).where(~bad)
    return rows.select("vec_id", F.transform("v", lambda c: F.floor(c * float(scale)).cast("long")).alias("x"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _largest(x: np.ndarray) -> int:
    return max(int(x.max()), -int(x.min())) if x.size else 0


class Fit:
    """The fitted transform: dim numbers, the directions and what the report needs."""

    def __init__(self, n: int, sums: list[int], triangle: np.ndarray, components: int):
        self.n, self.sums, self.dim = n, sums, len(sums)
        squares, self.directions = right_vectors(triangle, components)
        self.variance = squares / max(n, 1)
        trace = float((triangle ** 2).sum()) / max(n, 1)
        self.explained = self.variance / trace if trace else self.variance

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: 64-bit integers where they hold it, Python's beyond."""
        return _centred(x, self.n, self.sums)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        gaps = self.centred(x).astype(float) / self.n
        return gaps @ self.directions.T / np.sqrt(self.variance)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    if n * _largest(x) + max(map(abs, sums), default=0) < SAFE:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Rows and exact sums per dimension: one row per task and dimension, added in Spark."""
    schema = pa.schema([("at", pa.int32()), ("total", pa.decimal128(38, 0)), ("n", pa.int64())])

    def run(it):
        n, totals = 0, [0] * dim
        for b in it:
            x = _matrix(b.column(0), dim)
            exact = x if _largest(x) * len(x) < SAFE else x.astype(object)
            totals = [t + int(s) for t, s in zip(totals, exact.sum(axis=0))]
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()),
                                              pa.array([decimal.Decimal(t) for t in totals], pa.decimal128(38, 0)),
                                              pa.array([n] * dim, pa.int64())], schema=schema)

    found = map_arrow(fit, run, "at int, total decimal(38,0), n long").groupBy("at") \
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n")).orderBy("at").collect()
    return (found[0]["n"], [int(r["total"]) for r in found]) if found else (0, [])


def _stack(parts: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.concatenate(parts), mode="r")


def _triangle(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Upper triangle R of the centred fit list, R'R = n V, by blockwise QR."""
    dim = len(sums)
    schema, text = pa.schema([("part", pa.int64()), ("r", pa.binary())]), "part long, r binary"

    def fold(it):
        r = np.zeros((0, dim))
        for b in it:
            r = _stack([r, _centred(_matrix(b.column(0), dim), n, sums).astype(float) / n])
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()),
                                              pa.array([r.tobytes()], pa.binary())], schema=schema)

    def reduce_some(key, table):
        r = _stack([np.frombuffer(raw.as_py()).reshape(-1, dim) for raw in table.sort_by("part").column("r")])
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "r": pa.array([r.tobytes()], pa.binary())})

    parts = written(map_arrow(fit, fold, text), "whitening-triangles")
    while (top := parts.agg(F.max("part")).first()[0]) is not None and top > 0:
        step = F.floor(F.col("part") / FAN).cast("long")
        parts = written(parts.groupBy(step.alias("step")).applyInArrow(reduce_some, text), "whitening-triangles")
    last = parts.select("r").collect()  # one triangle
    r = np.frombuffer(last[0]["r"]).reshape(-1, dim) if last else np.zeros((0, dim))
    return np.concatenate([r, np.zeros((dim - len(r), dim))])


def fit_whitening(clean: DataFrame, components: int = COMPONENTS) -> tuple[Fit | None, float]:
    """The transform of the distinct vectors of ``clean`` and its identity error."""
    lengths = clean.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not lengths:
        return None, 0.0
    dim = lengths[0]["d"]
    fit = written(clean.where(F.size("x") == dim).select("x").distinct(), "whitening-fit")
    n, sums = _sums(fit, dim)
    model = Fit(n, sums, _triangle(fit, n, sums), components)
    return model, _identity_error(fit, model)


def _identity_error(fit: DataFrame, model: Fit) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity."""
    k = len(model.variance)
    schema = pa.schema([("at", pa.int32()), ("total", pa.float64())])

    def run(it):
        total = np.zeros(k * k + k)
        for b in it:
            w = model.whiten(_matrix(b.column(0), model.dim))
            total += np.concatenate([(w.T @ w).ravel(), w.sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], schema=schema)

    if not k:
        return 0.0
    rows = map_arrow(fit, run, "at int, total double").groupBy("at").agg(F.sum("total").alias("total")).orderBy("at").collect()
    total = np.array([r["total"] for r in rows]) / model.n
    # The rows are centred already; their mean is zero to rounding and still taken out.
    mean = total[k * k:]
    return float(np.abs(total[:k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def whiten(table: DataFrame, components: int = COMPONENTS, scale: int = SCALE, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """One row per remaining row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    clean = written(clean_vectors(table, scale, id_col, vector_col), "whitening-rows")
    model, error = fit_whitening(clean, components)
    id_type = dict(clean.dtypes)["vec_id"]
    text = f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not len(model.variance):
        return table.sparkSession.createDataFrame([], text)
    k = len(model.variance)

    def run(it):
        for b in it:
            x = _matrix(b.column(1), model.dim)
            rows = len(x)
            gap = model.centred(x)
            if gap.dtype == object or _largest(gap) ** 2 * model.dim >= SAFE:
                exact = (gap.astype(object) ** 2).sum(axis=1)
                deviation = pa.array([int(v) if v < 1 << 63 else None for v in exact], pa.int64())
            else:
                deviation = pa.array((gap ** 2).sum(axis=1), pa.int64())
            white = gap.astype(float) / model.n @ model.directions.T / np.sqrt(model.variance)
            each = np.repeat(np.arange(rows), k)
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()),
                pa.array(np.full(rows * k, model.n), pa.int64()), deviation.take(pa.array(each)),
                pa.array(white.ravel()), pa.array(np.tile(model.explained, rows)), pa.array(np.full(rows * k, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return map_arrow(clean.where(F.size("x") == model.dim), run, text)


def q_whitening(spark, sf_dir):
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
