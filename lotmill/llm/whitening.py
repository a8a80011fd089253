"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

Components are scaled and floored to whole numbers.  The fit list holds each distinct vector once; tasks sum up its entries,
then the products of centred vectors, a block of rows at a time, and only sums leave a task.  One task for each length of
vectors decomposes the scatter A = L L' (rows pivoted by the largest diagonal that is left) and rotates the columns of L, two
by two, until all are orthogonal: L Q = U S.  Their norms squared over n are the eigenvalues of the covariance, and the columns
of U, rows put back in place, its eigenvectors.  A is never diagonalised, so small eigenvalues keep their digits.

What a task or the driver holds grows with the lengths of vectors (a square for each length that occurs), not with rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage_table, without

COMPONENTS = 4
SCALE = 256
#: Entries that are multiplied at a time.
BLOCK = 1 << 20
SWEEPS = 60
OUT = ("component", "n", "deviation", "whitened", "explained", "identity_error")


class Model(NamedTuple):
    """Fit of one length: rows, sums by dimension, components as columns, eigenvalues, trace and error."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float
    error: float = 0.0

    def mean(self) -> np.ndarray:
        return np.array([float(s) / self.n if abs(s) < 2**53 else s / self.n for s in self.sums])

    def weights(self) -> np.ndarray:
        return self.components / np.sqrt(self.values)


def pivoted_cholesky(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``factor`` (as many columns as the rank) and ``order`` with ``scatter[order][:, order] = factor @ factor.T``."""
    size = len(scatter)
    factor, order, left = np.zeros((size, size)), np.arange(size), scatter.diagonal().astype(float)
    least = size * np.finfo(float).eps * left.max(initial=0.0)
    for k in range(size):
        p = k + int(np.argmax(left[k:]))
        if left[p] <= least:
            return factor[:, :k], order
        for rows in (factor, order, left):
            rows[[k, p]] = rows[[p, k]]
        factor[k, k] = np.sqrt(left[k])
        factor[k + 1 :, k] = (scatter[order[k + 1 :], order[k]] - factor[k + 1 :, :k] @ factor[k, :k]) / factor[k, k]
        left[k + 1 :] -= factor[k + 1 :, k] ** 2
    return factor, order


def one_sided_jacobi(factor: np.ndarray) -> np.ndarray:
    """``factor`` with its columns rotated until they are orthogonal; in a sweep each pair meets once, disjoint pairs together."""
    columns, count = factor.copy(), factor.shape[1]
    seats = np.arange(count + count % 2)
    enough = 1e-15 * max(count, 8)
    for _ in range(SWEEPS):
        most = 0.0
        for _ in range(len(seats) - 1):
            a, b = seats[: len(seats) // 2], seats[len(seats) // 2 :][::-1]
            real = (a < count) & (b < count)
            a, b = a[real], b[real]
            p, q = columns[:, a], columns[:, b]
            pp, qq, pq = (p * p).sum(0), (q * q).sum(0), (p * q).sum(0)
            skew = np.abs(pq) / np.sqrt(pp * qq)
            most = max(most, skew.max(initial=0.0))
            turn = skew > enough / 4
            zeta = (qq - pp) / np.where(turn, 2 * pq, 1.0)
            tangent = np.where(turn, np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
            cosine = 1 / np.hypot(1.0, tangent)
            sine = cosine * tangent
            columns[:, a], columns[:, b] = cosine * p - sine * q, sine * p + cosine * q
            seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])
        if most <= enough:
            break
    return columns


def principal(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues above zero, falling, and their unit eigenvectors as columns, the largest entry of each above zero."""
    factor, order = pivoted_cholesky(scatter)
    columns = one_sided_jacobi(factor)
    norms = np.sqrt((columns**2).sum(0))
    falling = np.argsort(-norms, kind="stable")
    vectors = np.empty_like(columns)
    vectors[order] = (columns / norms)[:, falling]
    signs = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])]) if vectors.size else 1.0
    return norms[falling] ** 2, vectors * signs


def by_length(column: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, rows and matrix of the vectors of each length, in blocks."""
    lengths, flat = np.asarray(column.value_lengths()).astype(np.int64), np.asarray(column.flatten())
    starts = np.cumsum(lengths) - lengths
    for length in np.unique(lengths):
        rows, step = np.flatnonzero(lengths == length), max(1, BLOCK // max(1, length))
        for a in range(0, len(rows), step):
            part = rows[a : a + step]
            yield int(length), part, flat[starts[part][:, None] + np.arange(length)]


def _sums(fit: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Rows and exact sums by dimension, for each length."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for length, rows, x in by_length(batch.column(0)):
                safe = len(x) * int(np.abs(x.astype(float)).max(initial=0.0)) < 2**62
                n, total = held.get(length, (0, np.zeros(length, object)))
                held[length] = n + len(rows), total + (x.sum(0).astype(object) if safe else x.astype(object).sum(0))
        found = [(length, k, n, Decimal(int(s))) for length, (n, total) in held.items() for k, s in enumerate(total)]
        if found:
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=["length", "at", "n", "s"])

    parts = fit.select("x").mapInArrow(work, "length int, at int, n long, s decimal(38,0)")
    out: dict[int, tuple[int, list[int]]] = {}
    for r in parts.groupBy("length", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("length", "at").collect():
        out.setdefault(r.length, (r.n, []))[1].append(int(r.s))
    return out


def _products(fit: DataFrame, models: Mapping[int, Model], weighted: bool) -> DataFrame:
    """Rows (``length``, ``at``, ``row``) of the matrices of summed products of centred vectors, or of their components."""
    sent = fit.sparkSession.sparkContext.broadcast(dict(models))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for length, _, x in by_length(batch.column(0)):
                y = x - sent.value[length].mean()
                y = y @ sent.value[length].weights() if weighted else y
                held[length] = held.get(length, 0.0) + y.T @ y
        for length, total in held.items():
            yield pa.RecordBatch.from_pydict({
                "length": pa.array([length] * len(total), pa.int32()), "at": pa.array(range(len(total)), pa.int32()),
                "row": pa.array(list(total), pa.list_(pa.float64())),
            })

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"length": rows["length"].iloc[:1], "at": rows["at"].iloc[:1], "row": [np.sum(np.stack(list(rows["row"])), axis=0)]})

    schema = "length int, at int, row array<double>"
    return fit.select("x").mapInArrow(work, schema).groupBy("length", "at").applyInPandas(add, schema)


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> dict[int, Model]:
    """Models by length of the distinct whole-numbered vectors in column ``x`` of ``fit``."""
    none = np.empty(0)
    models = {k: Model(n, s, none, none, 0.0) for k, (n, s) in _sums(fit).items()}
    sizes = {k: m.n for k, m in models.items()}

    def decompose(rows: pd.DataFrame) -> pd.DataFrame:
        scatter = np.stack(list(rows.sort_values("at")["row"]))
        values, vectors = principal(scatter)
        n, kept = sizes[int(rows["length"].iloc[0])], min(components, len(values))
        return pd.DataFrame({"length": rows["length"].iloc[:1], "components": [vectors[:, :kept].ravel()], "values": [values[:kept] / n], "trace": [scatter.trace() / n]})

    found = _products(fit, models, False).groupBy("length").applyInPandas(decompose, "length int, components array<double>, values array<double>, trace double")
    for r in found.collect():
        models[r.length] = models[r.length]._replace(
            components=np.array(r.components).reshape(r.length, len(r["values"])), values=np.array(r["values"]), trace=r.trace,
        )
    models = {k: m for k, m in models.items() if len(m.values)}
    known = fit.where(F.size("x").isin(list(models)))
    covered: dict[int, dict[int, list[float]]] = {}
    for r in _products(known, models, True).collect():
        covered.setdefault(r.length, {})[r.at] = r.row
    for k, rows in covered.items():
        covariance = np.array([rows[j] for j in range(len(rows))]) / models[k].n
        models[k] = models[k]._replace(error=float(np.abs(covariance - np.eye(len(covariance))).max()))
    return models


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sums of (n x - S) squared; None beyond a long."""
    most = n * float(np.abs(x.astype(float)).max(initial=0.0)) + max(map(abs, sums), default=0)
    if most**2 * max(1, x.shape[1]) < 2**62:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(1).tolist()
    exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    return [e if e < 2**63 else None for e in exact]


def _whole(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * scale).cast("long"))


def whiten(df: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """A row for each vector and each of its first ``components`` components, beside the input's columns.

    Adds ``component`` (from 1), ``n`` (distinct vectors), ``deviation``, ``whitened``, ``explained`` and ``identity_error``.

    Defined results: vectors that are null or hold a null, NaN or infinite entry are left out; vectors of each length have a
    fit of their own; there are as many components as the rank has, so that vectors without entries, and a fit on one vector,
    give no rows; entries beyond a long once scaled count as the nearest long; a deviation beyond a long is null; null and
    repeated ids are rows like others; an empty table gives an empty one; input columns named as an output column are replaced.
    """
    base = without(df, OUT)
    vector = F.col(f"`{vector_col}`")
    finite = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))
    rows = base.where(vector.isNotNull() & finite).withColumn("__x", _whole(vector, scale))
    fit = stage_table(rows.select(F.col("__x").alias("x")).where(F.size("x") > 0).distinct(), "fit")
    sent = df.sparkSession.sparkContext.broadcast(fit_whitening(fit, components))
    kinds = {"component": pa.int32(), "n": pa.int64(), "deviation": pa.int64(), "whitened": pa.float64(), "explained": pa.float64(), "identity_error": pa.float64()}

    @F.arrow_udf("array<struct<component int, n long, deviation long, whitened double, explained double, identity_error double>>")
    def answers(column: pa.Array) -> pa.Array:
        counts = np.zeros(len(column), np.int64)
        blocks = [(sent.value[length], rows, x) for length, rows, x in by_length(column) if length in sent.value]
        for m, rows, _ in blocks:
            counts[rows] = len(m.values)
        ends = np.cumsum(counts)
        out = {c: np.empty(int(ends[-1]) if len(ends) else 0, object if c == "deviation" else kinds[c].to_pandas_dtype()) for c in kinds}
        for m, rows, x in blocks:
            k = len(m.values)
            at = ((ends - counts)[rows][:, None] + np.arange(k)).ravel()
            out["component"][at], out["n"][at] = np.tile(np.arange(1, k + 1), len(rows)), m.n
            out["deviation"][at] = np.repeat(np.array(deviations(x, m.n, m.sums), object), k)
            out["whitened"][at] = ((x - m.mean()) @ m.weights()).ravel()
            out["explained"][at], out["identity_error"][at] = np.tile(m.values / m.trace, len(rows)), m.error
        values = pa.StructArray.from_arrays([pa.array(out[c], kinds[c]) for c in kinds], names=list(kinds))
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), values)

    done = rows.select(*[F.col(f"`{c}`") for c in base.columns], F.explode(answers("__x")).alias("__a"))
    return done.select(*[F.col(f"`{c}`") for c in base.columns], *[F.col(f"__a.{c}").alias(c) for c in OUT])


def op12_jacobi_whitening(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return whiten(vectors).select("vec_id", *OUT)
