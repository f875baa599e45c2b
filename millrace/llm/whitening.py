"""Embedding whitening by shifted CholeskyQR: distributed Gram passes, triangular solves, and an SVD of the composed factor."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.scratch import fresh, materialize

#: Components that are returned.
COMPONENTS = 4
#: Vector entries are taken as whole steps of 1 / SCALE.
SCALE = 256
#: Rows that are solved together, and columns of a triangular solve that are finished together.
ROWS, BLOCK = 4096, 32
#: Partial sums that one adding task takes.
FAN_IN = 16
UNIT_ROUNDOFF = 2.0**-53


@dataclass(frozen=True)
class Whitening:
    """``n`` and ``sums`` of the fit list; a column of ``axes`` a component, with its ``variances``; ``trace`` of the covariance."""

    n: int
    sums: tuple[int, ...]
    axes: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float


def steps(vector: Column) -> Column:
    """The entries as whole numbers of steps; null where the vector is null or an entry is null or not finite."""
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE))
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    return F.when(~bad, x)


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, width)


def _blocks(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for k in range(0, batch.num_rows, ROWS):
            yield _matrix(batch.column(0).slice(k, ROWS), width)


def exact_sums(x: np.ndarray) -> list[int]:
    """Sums of the columns of ``x`` as whole numbers of any size."""
    if len(x) and int(np.abs(x.astype(np.float64)).max()) < 1 << 40:
        return [int(v) for v in x.sum(axis=0)]
    return [sum(column) for column in x.T.tolist()]


def solve_right(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Q with Q @ r == a for an upper triangular ``r``: columns from the left, in blocks so that most work is products."""
    q = np.empty_like(a)
    for k in range(0, a.shape[1], BLOCK):
        end = min(k + BLOCK, a.shape[1])
        q[:, k:end] = a[:, k:end] - q[:, :k] @ r[:k, k:end]
        for j in range(k, end):
            q[:, j] = (q[:, j] - q[:, k:j] @ r[k:j, j]) / r[j, j]
    return q


def pivoted_cholesky(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``r, picked`` with r.T @ r == g on the rank of ``g``: the columns ``picked`` of r are upper triangular.

    Columns are picked by what the earlier ones leave of them; it ends where that is rounding only.
    """
    g, d = g.copy(), len(g)
    r, picked, left = np.zeros((0, d)), [], np.diag(g).copy()
    least = 8 * d * UNIT_ROUNDOFF * left.max(initial=0.0)
    for _ in range(d):
        j = int(left.argmax())
        if left[j] <= least:
            break
        row = (g[j] - r[:, j] @ r) / np.sqrt(left[j])
        row[picked] = 0.0
        row[j] = np.sqrt(left[j])
        r, left = np.vstack([r, row]), left - row**2
        left[[*picked, j]] = -1.0
        picked.append(j)
    return r, np.array(picked, int)


def _added(parts: DataFrame, add: Callable[[Iterable[np.ndarray]], np.ndarray], kind: str) -> DataFrame:
    """Add the partial arrays of a table ``task, v`` in rounds of ``FAN_IN``, in the order of their tasks, until one is left."""

    def fold(table: pa.Table) -> pa.Table:
        order = np.argsort(table["task"].to_numpy())
        total = add(table["v"][int(k)].values.to_numpy(zero_copy_only=False) for k in order)
        return pa.table({"task": pa.array([int(table["task"].to_numpy().min()) // FAN_IN], pa.int64()), "v": pa.array([total.tolist()], pa.list_(pa.float64() if kind == "double" else pa.decimal128(38)))})

    parts = materialize(parts, "whitening-parts")
    while parts.agg(F.max("task")).first()[0] > 0:
        parts = materialize(parts.groupBy(F.floor(F.col("task") / FAN_IN).alias("g")).applyInArrow(fold, f"task long, v array<{kind}>"), "whitening-parts")
    return parts


def _gram(fit: DataFrame, mean: np.ndarray, turns: list[tuple[np.ndarray, np.ndarray]], last: np.ndarray | None = None) -> np.ndarray:
    """Gram matrix of the centred rows after the solves of ``turns`` (picked columns, triangular factor), or of rows @ ``last``.

    Every task adds up its own rows; the matrices are added in rounds. One matrix of the vectors' width reaches the driver.
    """
    width = len(mean)

    def own(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total, rows = None, 0
        for x in _blocks(batches, width):
            a = x - mean
            for picked, r in turns:
                a = solve_right(np.ascontiguousarray(a[:, picked]), r)
            a = a if last is None else a @ last
            total, rows = (a.T @ a if total is None else total + a.T @ a), rows + len(a)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], ["task", "v"])

    parts = _added(fit.select("x").mapInArrow(own, "task long, v array<double>"), lambda vs: sum(vs), "double")
    flat = np.array(parts.first()["v"])
    return flat.reshape(int(np.sqrt(len(flat))), -1)


def _totals(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """Rows of the fit list and exact sums of its dimensions."""

    def own(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from decimal import Decimal

        from pyspark import TaskContext

        rows, total = 0, [0] * width
        for x in _blocks(batches, width):
            rows, total = rows + len(x), [p + q for p, q in zip(total, exact_sums(x))]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([[Decimal(v) for v in (rows, *total)]], pa.list_(pa.decimal128(38)))], ["task", "v"])

    parts = _added(fit.select("x").mapInArrow(own, "task long, v array<decimal(38,0)>"), lambda vs: sum(vs), "decimal(38,0)")
    n, *sums = (int(v) for v in parts.first()["v"])
    return n, sums


def fit_list(vectors: DataFrame, column: str) -> tuple[DataFrame | None, int]:
    """The distinct step vectors of ``column`` as a table ``x`` and their length (the most frequent one; of ties the longest)."""
    x = vectors.select(steps(F.col(f"`{column}`")).alias("x")).where("x is not null")
    fit = materialize(x.distinct(), "whitening-fit")
    most = fit.groupBy(F.size("x").alias("width")).count().where("width > 0").orderBy(F.desc("count"), F.desc("width")).first()
    return (fit.where(F.size("x") == most["width"]), most["width"]) if most else (None, 0)


def fit(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Fit on each distinct step vector once; None where no row has one.

    Three passes of CholeskyQR over the centred rows: the first factors the Gram matrix plus a shift above its rounding
    errors, so that it succeeds however the columns depend on each other; the second, on rows that are near orthogonal
    by then, tells real dependence from rounding and drops it by pivots; the third makes the rows orthogonal to double
    precision. R is the product of the three factors, its SVD gives the axes. A sixth pass measures the whitened covariance.
    """
    rows, width = fit_list(vectors, column)
    if rows is None:
        return None
    n, sums = _totals(rows, width)
    mean = np.array([s / n for s in sums])
    everything = np.arange(width)
    gram = _gram(rows, mean, [])
    trace = float(np.trace(gram)) / n
    none = Whitening(n, tuple(sums), np.zeros((width, 0)), np.zeros(0), trace, 0.0)
    if trace == 0.0:
        return none
    shift = 11 * (n * width + width * (width + 1)) * UNIT_ROUNDOFF * float(np.trace(gram))
    first = np.linalg.cholesky(gram + shift * np.eye(width)).T
    factor, turns = first, [(everything, first)]
    gram = _gram(rows, mean, turns)
    second, picked = pivoted_cholesky(gram)
    factor, turns = second @ factor, [*turns, (picked, np.triu(second[:, picked]))]
    gram = _gram(rows, mean, turns)
    factor = np.linalg.cholesky(gram).T @ factor
    _, singular, axes = np.linalg.svd(factor, full_matrices=False)
    axes, variances = axes[:components].T, singular[:components] ** 2 / n
    whitened = _gram(rows, mean, [], axes / np.sqrt(variances)) / n
    return Whitening(n, tuple(sums), axes, variances, trace, float(np.abs(whitened - np.eye(len(variances))).max()))


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Sum of (n * x - sums)**2 of each row; null where it passes a long."""
    most = n * int(np.abs(x.astype(np.float64)).max(initial=0)) + max((abs(s) for s in sums), default=0)
    if most * most * x.shape[1] < 1 << 62:
        d = n * x - np.array(sums, np.int64)
        return (d * d).sum(axis=1).tolist()
    exact = (sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist())
    return [v if v < 1 << 63 else None for v in exact]


def whiten(vectors: DataFrame, id_col: str = "vec_id", column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Return ``id, component, n, deviation, whitened, explained, identity_error`` for each usable row and component.

    Entries become whole steps x = floor(256 * entry). The fit list holds each distinct x once: n vectors with the sums S.
    ``deviation`` is the exact sum of (n * x - S)**2 (null where it passes a long), ``whitened`` is x - S / n on the
    component over the root of its variance, ``explained`` the component's share of all variance, ``identity_error`` how
    far the covariance of the whitened fit list is from the identity.

    Rows whose vector is null, empty, or holds null or non-finite entries are left out, and so are those of another
    length than the most frequent one (of ties the longest). Components end at the rank of the covariance, so a table
    of one distinct vector or without rows gives no rows. Repeated rows and ties get equal rows; ids may be null.
    """
    model = fit(vectors, column, components)
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not len(model.variances):
        return vectors.sparkSession.createDataFrame([], schema)
    width, mean, axes = len(model.sums), np.array([s / model.n for s in model.sums]), model.axes / np.sqrt(model.variances)
    n, sums, explained, error, count = model.n, model.sums, (model.variances / model.trace).tolist(), model.identity_error, len(model.variances)

    def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1), width)
            rows = np.repeat(np.arange(len(x)), count)
            deviation = pa.array(_deviations(x, n, sums), pa.int64()).take(pa.array(rows))
            whitened = ((x - mean) @ axes).ravel()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))), pa.array(np.full(len(rows), n, np.int64)), deviation, pa.array(whitened), pa.array(np.tile(explained, len(x))), pa.array(np.full(len(rows), error))],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    x = fresh(vectors, "x")
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), steps(F.col(f"`{column}`")).alias(x)).where(F.size(x) == width)
    return rows.mapInArrow(project, schema)
