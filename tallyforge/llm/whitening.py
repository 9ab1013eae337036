"""Whitening of embeddings by a compensated covariance (operator 13).

Vectors become whole numbers; the fit list is each different one once. Its
length and sums are exact. Centred outer products are accumulated in
double-double, each task's high and low parts are merged per matrix row, and
the d x d result alone comes to the driver. There LAPACK's divide and conquer
on the tridiagonal form gives eigenvectors, which are then refined against the
double-double matrix, so they are right to a double even where the matrix,
rounded to doubles, would not determine them.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm import doubledouble as dd
from tallyforge.llm.storage import Batches, bound_batches, lean, stored
from tallyforge.llm.vectors import finite_rows, whole_numbers

#: entries of vectors whose products are held at once
PRODUCTS = 1 << 16
LONGEST = (1 << 63) - 1


@dataclass(frozen=True)
class Scaling:
    """x = floor(factor * c) + shift; beyond +-2^62 it is held at that bound."""

    factor: float = 64.0
    shift: int = 1_000_000

    def __call__(self, c: np.ndarray) -> np.ndarray:
        return np.clip(whole_numbers(self.factor * c) + self.shift, -(1 << 62), 1 << 62)


@dataclass(frozen=True)
class Whitening:
    """What the fit list gives: length, sums, eigenvalues and the unit eigenvectors (columns)."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n*x - S, exactly: as 64-bit integers where they fit, else Python's."""
        sums = self.sums
        most = max((self.n * max(abs(int(x.min())), abs(int(x.max()))), *map(abs, sums))) if x.size else 0
        if most < 1 << 61:
            return self.n * x - np.array(sums, np.int64)
        return self.n * x.astype(object) - np.array(sums, object)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Rows of whitened coordinates, one column a component."""
        centred = (self.deviations(x) / self.n).astype(np.float64)
        return centred @ (self.vectors / np.sqrt(self.values))


def _whole(scaling: Scaling, size: int):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            _, c = finite_rows(batch[0], size)
            yield pa.RecordBatch.from_arrays([_lists(scaling(c))], names=["x"])

    return lean(run)


def _lists(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * np.int32(values.shape[1])), pa.array(values.ravel()))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _sums(size: int):
    def run(batches: Batches) -> Batches:
        n, sums = 0, np.zeros(size, object)
        for batch in batches:
            x = _matrix(batch[0], size)
            n += len(x)
            # in two halves, which cannot overflow
            sums += ((x >> 31).sum(axis=0).astype(object) << 31) + (x & 0x7FFFFFFF).sum(axis=0).astype(object)
        rows = {"i": range(-1, size), "total": [Decimal(n), *map(Decimal, sums.tolist())]}
        yield pa.RecordBatch.from_arrays([pa.array(rows["i"], pa.int32()), pa.array(rows["total"], pa.decimal128(38, 0))], names=["i", "total"])

    return lean(run)


def _products(fit: Whitening, size: int):
    def run(batches: Batches) -> Batches:
        total = np.zeros((size, size)), np.zeros((size, size))  # above the diagonal
        n = np.float64(fit.n), np.float64(0)
        step = max(1, PRODUCTS // size)
        for batch in batches:
            x = _matrix(batch[0], size)
            for k in range(0, len(x), step):
                high, low = dd.div(dd.of_integers(fit.deviations(x[k : k + step])), n)
                upper, lower = dd.halves(high)
                for i in range(size):
                    own, rest = slice(i, i + 1), slice(i, size)
                    p, e = dd.two_prod(high[:, own], high[:, rest], (upper[:, own], lower[:, own]), (upper[:, rest], lower[:, rest]))
                    e += high[:, own] * low[:, rest] + low[:, own] * high[:, rest]
                    total[0][i, rest], total[1][i, rest] = dd.add((total[0][i, rest], total[1][i, rest]), dd.sum_rows(dd.quick_two_sum(p, e)))
        task = TaskContext.get()
        columns = [pa.array([v[i, i:] for i in range(size)], pa.list_(pa.float64())) for v in total]
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array([task.partitionId() if task else 0] * size, pa.int32()), *columns], names=["i", "task", "high", "low"])

    return lean(run)


def _merged(parts: pd.DataFrame) -> pd.DataFrame:
    """One matrix row from the parts of all tasks, in their order."""
    parts = parts.sort_values("task")
    high, low = dd.sum_rows((np.stack(parts["high"].to_list()), np.stack(parts["low"].to_list())))
    return pd.DataFrame({"i": [parts["i"].iloc[0]], "high": [high.tolist()], "low": [low.tolist()]})


def covariance(fit_list: DataFrame, fit: Whitening, size: int) -> dd.Pair:
    """Covariance of the fit list, divisor n, as a pair of d x d matrices.

    A task gives d rows; those of a matrix row meet in one group, as many as
    there are tasks.
    """
    parts = fit_list.mapInArrow(_products(fit, size), "i int, task int, high array<double>, low array<double>")
    rows = parts.groupBy("i").applyInPandas(_merged, "i int, high array<double>, low array<double>").collect()
    out = np.zeros((size, size)), np.zeros((size, size))
    for r in rows:
        for o, values in zip(out, (r["high"], r["low"]), strict=True):
            o[r["i"], r["i"] :] = o[r["i"] :, r["i"]] = values
    return dd.div(out, (np.full((size, size), float(fit.n)), np.zeros((size, size))))


def _groups(values: np.ndarray, small: float) -> list[np.ndarray]:
    """Places of the values that lie within ``small`` of a neighbour, by neighbourhood."""
    order = np.argsort(values, kind="stable")
    parts = np.split(order, np.flatnonzero(np.diff(values[order]) > small) + 1)
    return [p for p in parts if len(p) > 1]


def eigen(v: dd.Pair, rounds: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric double-double matrix.

    ``numpy.linalg.eigh`` is LAPACK's divide and conquer on the tridiagonal
    form. Each round then corrects the vectors by first-order terms from their
    products in double-double; those of eigenvalues that are too close for that
    are turned within their space by the eigenvectors of what parts them.
    """
    size = len(v[0])
    x = np.linalg.eigh(v[0])[1]
    pair = x, np.zeros_like(x)
    for _ in range(rounds):
        turned = pair[0].T, pair[1].T
        r = dd.matmul(turned, pair)
        r = dd.add((np.eye(size), np.zeros((size, size))), (-r[0], -r[1]))
        s = dd.matmul(turned, dd.matmul(v, pair))
        one = dd.add((np.ones(size), np.zeros(size)), (-np.diag(r[0]), -np.diag(r[1])))
        e = dd.div((np.diag(s[0]).copy(), np.diag(s[1]).copy()), one)
        gap = dd.add((e[0][None, :], e[1][None, :]), (-e[0][:, None], -e[1][:, None]))[0]
        small = 2 * (np.abs(s[0] - np.diag(np.diag(s[0]))).max(initial=0) + np.abs(v[0]).max(initial=0) * np.abs(r[0]).max(initial=0))
        near = np.abs(gap) <= small
        top = s[0] + e[0][None, :] * r[0]
        change = np.where(near, r[0] / 2, top / np.where(near, 1, gap))
        pair = dd.add(pair, dd.matmul(pair, (change, np.zeros_like(change))))
        for group in _groups(e[0], small):
            middle = np.diag(np.full(len(group), e[0][group[0]]))
            apart = dd.add((s[0][np.ix_(group, group)], s[1][np.ix_(group, group)]), (-middle, np.zeros_like(middle)))[0]
            turn = np.linalg.eigh((apart + apart.T) / 2)[1]
            turned = dd.matmul((pair[0][:, group], pair[1][:, group]), (turn, np.zeros_like(turn)))
            pair[0][:, group], pair[1][:, group] = turned
    order = np.argsort(-e[0], kind="stable")
    return e[0][order], pair[0][:, order]


def _moments(fit: Whitening, size: int):
    def run(batches: Batches) -> Batches:
        k = len(fit.values)
        total, count = np.zeros((k, k)), 0
        for batch in batches:
            z = fit.project(_matrix(batch[0], size))
            total += z.T @ z
            count += len(z)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(k), k), pa.int32()), pa.array(np.tile(np.arange(k), k), pa.int32()), pa.array(total.ravel())], names=["a", "b", "total"])

    return lean(run)


def identity_error(fit_list: DataFrame, fit: Whitening, size: int) -> float:
    """Largest absolute entry of the covariance of whitened fit vectors, minus the identity; measured on the vectors.

    Their mean is 0 by the exact sums, so their products are centred.
    """
    if not len(fit.values):
        return 0.0
    rows = fit_list.mapInArrow(_moments(fit, size), "a int, b int, total double").groupBy("a", "b").agg(F.sum("total").alias("total")).collect()
    return max(abs(r["total"] / fit.n - (r["a"] == r["b"])) for r in rows)


def dimension(vectors: DataFrame, vec_col: str) -> int:
    """The most frequent length of a vector (of equally frequent ones the longest); 0 without vectors."""
    counted = vectors.where(F.col(vec_col).isNotNull()).groupBy(F.size(vec_col).alias("size")).count()
    first = counted.orderBy(F.desc("count"), F.desc("size")).first()
    return first["size"] if first else 0


def fit(vectors: DataFrame, *, vec_col: str = "embedding", size: int | None = None, scaling: Scaling = Scaling(), components: int = 16) -> tuple[DataFrame, Whitening, int]:
    """The fit list (stored), its whitening, and the length of the vectors."""
    bound_batches(vectors.sparkSession)
    size = dimension(vectors, vec_col) if size is None else size
    whole = vectors.select(F.col(vec_col).cast("array<double>")).mapInArrow(_whole(scaling, size), "x array<long>")
    fit_list = stored(whole.distinct(), "whitening-fit")
    if not size:
        return fit_list, Whitening(0, [], np.empty(0), np.empty((0, 0)), 0.0), 0
    sums = {r["i"]: int(r["total"]) for r in fit_list.mapInArrow(_sums(size), "i int, total decimal(38,0)").groupBy("i").agg(F.sum("total").cast("decimal(38,0)").alias("total")).collect()}
    n = sums.get(-1, 0)
    bare = Whitening(n, [sums.get(i, 0) for i in range(size)], np.empty(0), np.empty((size, 0)), 0.0)
    if not n:
        return fit_list, bare, size
    v = covariance(fit_list, bare, size)
    values, found = eigen(v)
    keep = int((values[:components] > size * np.finfo(float).eps * values[0]).sum())
    return fit_list, Whitening(n, bare.sums, values[:keep], found[:, :keep], float(np.add.reduce(np.diag(v[0])))), size


def _deviation(d: np.ndarray) -> pa.Array:
    most = max(abs(int(d.min())), abs(int(d.max()))) if d.size else 0
    if d.dtype == object or d.shape[1] * most**2 > LONGEST:
        exact = (d.astype(object) ** 2).sum(axis=1)
        return pa.array([int(v) if v <= LONGEST else None for v in exact], pa.int64())
    return pa.array((d * d).sum(axis=1))


def _apply(scaling: Scaling, model: Whitening, size: int, error: float):
    share = model.values / model.trace if len(model.values) else model.values

    def run(batches: Batches) -> Batches:
        k = len(model.values)
        for batch in batches:
            rows, c = finite_rows(batch[1], size)
            for a in range(0, len(rows), 2048):
                x = scaling(c[a : a + 2048])
                m = len(x)
                ids = batch[0].take(pa.array(np.repeat(rows[a : a + 2048], k)))
                deviation = _deviation(model.deviations(x)).take(pa.array(np.repeat(np.arange(m), k)))
                columns = [ids, pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, model.n)), deviation]
                columns += [pa.array(model.project(x).ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * k, error))]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return lean(run)


def whiten(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", size: int | None = None, scaling: Scaling = Scaling(), components: int = 16) -> DataFrame:
    """A row for each usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Null vectors and those with a null or non-finite entry are left out, as are
    vectors of another length than ``size`` (default: the most frequent one; of
    equally frequent ones the longest). Repeated rows each get their rows; the
    fit list holds each different vector once. Components without variance
    (eigenvalue at most d * 2^-52 of the largest) have no unit variance to give
    and no rows, so vectors that are all alike, and an empty table, give none.
    A deviation beyond 64 bits is null. Ids may be null; other columns are not read.
    """
    fit_list, model, size = fit(vectors, vec_col=vec_col, size=size, scaling=scaling, components=components)
    error = identity_error(fit_list, model, size)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>"))
    return rows.mapInArrow(_apply(scaling, model, size, error), "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
