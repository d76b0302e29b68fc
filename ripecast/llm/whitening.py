"""Whitening of vectors by shifted CholeskyQR.

Components c become integers x = floor(1024 c) + 100000, so that sums, and with them the centre, are exact. A is the
matrix of the centred rows x - S/n. Distributed passes orthogonalise it without ever forming it: each pass takes Q, the
rows after the triangular solves so far (at first A itself), sums its Gram matrix G over all rows, factors G = R^T R and adds
R to the composition. The first pass shifts G by a little more than its rounding error, so that the factor exists for any
condition of A; one or two passes later Q is orthonormal to machine precision, which is where they stop. With A = Q R for
the composed R, the singular values s of R and its right singular vectors are those of A, at the condition of A and not
of its square: eigenvalues of the covariance are e = s^2 / n and the vectors are its components.

Directions without any spread (constant or dependent dimensions) leave Q with a Gram matrix that has no Cholesky factor;
its symmetric root takes the factor's place then, and components whose eigenvalue is rounding error are left out.

Tasks add up one Gram matrix per vector length over all their rows; these are summed in groups before the driver adds
the last few and does the d x d algebra. What reaches the driver depends on d only. All passes read the input again, so nothing
is cached and a lost executor costs only its tasks.

Defined results: vectors that are null or hold null or non-finite components are left out; vectors of another length are
a fit list of their own; empty vectors have no components; integers beyond 2^62 are taken as that; ``deviation`` is exact
and null where it does not fit a long; repeated rows count as often as they stand there; null keys stay null; equal
eigenvalues keep the order the decomposition gives them, and each component's largest entry is positive; with one row or
equal rows there is no component and no result row; very long vectors cost d x d numbers a task; other columns are ignored
whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 1_024, 100_000
BLOCK = 4_096
GROUPS = 32
MOST_PASSES = 6
_SAFE = 1 << 62


def integers(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, integer vectors) of up to ``BLOCK`` rows that share a length."""
    lengths = np.asarray(pc.list_value_length(column))
    flat = np.asarray(column.flatten())
    starts = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=starts[1:])
    for dims in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == dims)
        for k in range(0, len(rows), BLOCK):
            at = rows[k : k + BLOCK]
            values = flat[(starts[at][:, None] + np.arange(dims)).ravel()].reshape(len(at), int(dims))
            yield at, np.clip(np.floor(values * SCALE), -(2.0**62) + SHIFT, 2.0**62 - SHIFT).astype(np.int64) + SHIFT


def deviations(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """n x - S, in longs where they and their squares fit and in Python's integers where not."""
    largest = n * int(np.abs(x).max(initial=0)) + max(map(abs, total), default=0)
    if largest < _SAFE:
        found = n * x - np.array(total, np.int64)
        most = int(np.abs(found).max(initial=0))
        return found if x.shape[1] * most * most < _SAFE else found.astype(object)
    return x.astype(object) * n - np.array(total, object)


def centred(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """x - S/n, rounded once."""
    return deviations(x, n, total).astype(float) / n


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    spoilt = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    own = df.select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    return own.where(F.col("vector").isNotNull() & ~F.exists("vector", spoilt)).withColumn("vector", F.col("vector").cast("array<double>"))


def sums(rows: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Per vector length: how many vectors, and the exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            for _, x in integers(batch.column(0)):
                wide = int(np.abs(x).max()) * len(x) >= _SAFE
                part = (x.astype(object) if wide else x).sum(0)
                kept = found.setdefault(x.shape[1], [0, [0] * x.shape[1]])
                kept[0] += len(x)
                kept[1] = [a + int(b) for a, b in zip(kept[1], part)]
        for dims, (n, total) in found.items():
            columns = [np.full(dims, dims, np.int32), np.arange(dims, dtype=np.int32), np.full(dims, n)]
            values = pa.array([str(t) for t in total], pa.string())
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), values], names=["dims", "at", "n", "total"])

    part = rows.select("vector").mapInArrow(run, "dims int, at int, n bigint, total string")
    exact = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    out: dict[int, tuple[int, list[int]]] = {}
    for r in part.groupBy("dims", "at").agg(F.sum("n").alias("n"), exact).orderBy("dims", "at").collect():
        out.setdefault(r["dims"], (r["n"], []))[1].append(int(r["total"]))
    return out


def total_of(rows: DataFrame, matrix: Callable[[np.ndarray], np.ndarray]) -> dict[int, np.ndarray]:
    """Per vector length, the sum of ``matrix(integer vectors)`` over all blocks of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in integers(batch.column(0)):
                part = matrix(x)
                found[x.shape[1]] = found[x.shape[1]] + part if x.shape[1] in found else part
        for dims, value in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([dims], pa.int32()), pa.array([pickle.dumps(value)], pa.binary())], names=["dims", "value"])

    def add(table: pa.Table) -> pa.Table:
        parts = table.column("value").to_pylist()
        value = pickle.loads(parts[0])
        for part in parts[1:]:
            value += pickle.loads(part)
        return pa.table({"dims": table.column("dims").slice(0, 1), "value": pa.array([pickle.dumps(value)], pa.binary())})

    part = rows.select("vector").mapInArrow(run, "dims int, value binary").withColumn("slot", F.spark_partition_id() % GROUPS)
    grouped = part.groupBy("dims", "slot").applyInArrow(lambda t: add(t.select(["dims", "value"])), "dims int, value binary")
    out: dict[int, np.ndarray] = {}
    for r in grouped.collect():
        value = pickle.loads(r["value"])
        out[r["dims"]] = out[r["dims"]] + value if r["dims"] in out else value
    return out


def _factor(gram: np.ndarray) -> tuple[np.ndarray, bool]:
    """R with R^T R = gram, and whether it is a Cholesky factor rather than the symmetric root."""
    try:
        return np.linalg.cholesky(gram).T, True
    except np.linalg.LinAlgError:
        values, vectors = np.linalg.eigh(gram)
        noise = values.max() * len(values) * np.finfo(float).eps * 16
        return np.sqrt(np.where(values > noise, values, 0.0))[:, None] * vectors.T, False


def orthogonalise(rows: DataFrame, stats: dict[int, tuple[int, list[int]]]) -> dict[int, np.ndarray]:
    """Per vector length, the composed R of A = Q R with orthonormal Q."""
    composed: dict[int, np.ndarray] = {}
    solves: dict[int, list[np.ndarray]] = {dims: [] for dims in stats}
    for step in range(MOST_PASSES):

        def gram(x: np.ndarray) -> np.ndarray:
            q = centred(x, *stats[x.shape[1]])
            for r in solves[x.shape[1]]:
                q = np.linalg.solve(r.T, q.T).T
            return q.T @ q

        open_ = [dims for dims in stats if dims not in composed]
        if not open_:
            break
        for dims, g in total_of(rows.where(F.size("vector").isin(open_)), gram).items():
            n, eye = stats[dims][0], np.eye(dims)
            if step == 0:
                size = float(np.linalg.norm(g, 2))
                r = _factor(g + 11.0 * (n * dims + dims * (dims + 1)) * 1.1e-16 * size * eye)[0] if size else None
                if r is None:
                    composed[dims] = np.zeros((dims, dims))
                    continue
                solves[dims].append(r)
                continue
            r, full = _factor(g)
            done = np.abs(g - eye).max() < 1e-9
            if not full or done or step == MOST_PASSES - 1:
                whole = r
                for s in reversed(solves[dims]):
                    whole = whole @ s
                composed[dims] = whole
            else:
                solves[dims].append(r)
    return composed


def components(r: np.ndarray, n: int, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues and unit eigenvectors (rows) of R^T R / n by falling eigenvalue, and the trace."""
    if not r.size or not np.abs(r).max():
        return np.zeros(0), np.zeros((0, r.shape[1])), 0.0
    _, s, vectors = np.linalg.svd(r)
    sound = s > s[0] * max(r.shape) * np.finfo(float).eps * 8
    values = s * s / n
    kept = vectors[: len(s)][sound][:most]
    turn = np.sign(kept[np.arange(len(kept)), np.abs(kept).argmax(1)])
    return values[sound][:most], kept * turn[:, None], float(values.sum())


def whiten(df: DataFrame, key: str, vector: str, most: int = 8) -> DataFrame:
    """key, component, n, deviation, whitened, explained, identity_error: a row per vector and component up to ``most``."""
    rows = usable(df, key, vector)
    stats = sums(rows)
    factors = orthogonalise(rows, stats)
    models = {dims: components(factors[dims], stats[dims][0], most) for dims in stats}
    maps = {dims: (vectors / np.sqrt(values)[:, None]).T for dims, (values, vectors, _) in models.items()}

    def spread(x: np.ndarray) -> np.ndarray:
        w = centred(x, *stats[x.shape[1]]) @ maps[x.shape[1]]
        return w.T @ w

    # The mean of all whitened rows is zero to rounding, since the centre is exact.
    found = total_of(rows, spread)
    errors = [np.abs(g / stats[dims][0] - np.eye(len(g))).max(initial=0.0) for dims, g in found.items()]
    error = float(max(errors, default=0.0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in integers(batch.column(1)):
                dims = x.shape[1]
                n, total = stats[dims]
                values, _, trace = models[dims]
                k = len(values)
                if not k:
                    continue
                apart = deviations(x, n, total)
                square = (apart * apart).sum(1)
                square = [int(v) if int(v) < 1 << 63 else None for v in square]
                whitened = (apart.astype(float) / n) @ maps[dims]
                each = np.repeat(np.arange(len(at)), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(at[each])),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                        pa.array(np.full(len(each), n, np.int64)),
                        pa.array(square, pa.int64()).take(pa.array(each)),
                        pa.array(whitened.ravel()),
                        pa.array(np.tile(values / trace, len(at))),
                        pa.array(np.full(len(each), error)),
                    ],
                    names=["key", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
