"""Whitening of embeddings by shifted CholeskyQR.

The covariance's spectrum is that of the centred rows. A Gram matrix loses half
of the digits, so its eigenvectors are not taken: instead each pass over the
rows sums a Gram matrix in the tasks, its Cholesky factor R orthogonalises the
rows further (every task solves the triangular systems for its own rows), and the
factors are composed. The first factor is of the Gram matrix plus a small
shift, so that it exists however dependent the dimensions are; after it the
rows are well enough conditioned for plain passes, repeated until they are
orthonormal. What then stands in the composed factor, a matrix of dimension by
dimension, has the singular values and right vectors of all rows.

The rows themselves are small integers, kept in the shortest type that holds
them: the distinct ones are written once to the shared folder and read by each
pass. The driver sees only sums over rows: matrices of dimension by dimension.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labwatch.llm.common import pieces, table, written

#: Entries become floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: Rows that a task holds as doubles, bytes of a batch, bound of the integers, passes at most.
ROWS, BATCH_BYTES, LIMIT, PASSES = 4_096, 8 << 20, 1 << 62, 12
#: Directions that hold less than this part of the shifted, orthogonalised rows are rounding, not data.
RANK = 1e-11
TYPES = ("<i1", "<i2", "<i4", "<i8")
UNIT = float(np.finfo(np.float64).eps) / 2


def quantised(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(places, floor(SCALE * c))`` for the rows of a batch that take part, by length of the vector."""
    if not len(column):
        return
    offsets = column.offsets.to_numpy()
    values = column.values.slice(offsets[0], offsets[-1] - offsets[0]).cast(pa.float64())
    flat = values.to_numpy(zero_copy_only=False)  # nulls become NaN
    starts, lengths = offsets[:-1] - offsets[0], np.diff(offsets)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    whole = column.is_valid().to_numpy(zero_copy_only=False) & (lengths > 0) & (bad[starts + lengths] == bad[starts])
    for d in np.unique(lengths[whole]):
        at = np.flatnonzero(whole & (lengths == d))
        with np.errstate(over="ignore"):
            scaled = np.floor(flat[starts[at, None] + np.arange(d)] * SCALE)
        yield at, np.clip(scaled, -LIMIT, LIMIT).astype(np.int64)


def packed(rows: np.ndarray) -> list[bytes]:
    """Each row in the shortest integer type that holds it; equal rows have equal bytes."""
    low, high = rows.min(1), rows.max(1)
    kind = np.zeros(len(rows), int)
    for k, t in enumerate(TYPES[:-1]):
        kind[(low < np.iinfo(t).min) | (high > np.iinfo(t).max)] = k + 1
    out = [b""] * len(rows)
    for k in np.unique(kind):
        at = np.flatnonzero(kind == k)
        data, size = np.ascontiguousarray(rows[at].astype(TYPES[k])).tobytes(), rows.shape[1] * np.dtype(TYPES[k]).itemsize
        for i, place in enumerate(at.tolist()):
            out[place] = bytes([k]) + data[i * size : (i + 1) * size]
    return out


def unpacked(keys: list[bytes]) -> np.ndarray:
    """The rows behind keys of one dimension."""
    if len({k[0] for k in keys}) == 1:
        return np.frombuffer(b"".join(k[1:] for k in keys), TYPES[keys[0][0]]).reshape(len(keys), -1).astype(np.int64)
    return np.stack([np.frombuffer(k, TYPES[k[0]], offset=1).astype(np.int64) for k in keys])


def fit_list(rows: DataFrame, vector: str) -> DataFrame:
    """``d, key``: every distinct vector once, with its dimension, in the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, BATCH_BYTES):
            for _, x in quantised(batch.column(0)):
                yield pa.record_batch({"d": pa.array(np.full(len(x), x.shape[1], np.int32)), "key": pa.array(packed(x), pa.binary())})

    # copies meet in the tasks that read them before anything is shuffled
    return written(rows.select(F.col(vector).alias("v")).mapInArrow(run, "d int, key binary").distinct())


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield unpacked(batch.column(0).slice(start, ROWS).to_pylist())


def exact_sum(rows: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    """Column sums as Python integers."""
    if int(max(rows.max(), -rows.min())) * len(rows) < LIMIT:
        return rows.sum(0).astype(object)
    return rows.astype(object).sum(0)


def totals(keys: DataFrame) -> list[int]:
    """The exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for x in blocks(batches):
            total = exact_sum(x) if total is None else total + exact_sum(x)
        if total is not None:
            yield pa.record_batch({"i": pa.array(range(len(total)), pa.int32()), "s": pa.array([int(t) for t in total], pa.decimal128(38, 0))})

    sums = keys.mapInArrow(run, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").cast("decimal(38,0)").alias("s"))
    return [int(r["s"]) for r in sorted(sums.collect(), key=lambda r: r["i"])]


def gram(keys: DataFrame, width: int, rows_of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of the outer products of ``rows_of`` them, one partial matrix for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for x in blocks(batches):
            q = rows_of(x)
            total += q.T @ q
        yield pa.record_batch({"i": pa.array(range(width), pa.int32()), "row": pa.array([r.tobytes() for r in total], pa.binary())})

    def add(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, i = np.zeros(width), 0
        for batch in group:
            for i, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total += np.frombuffer(row)
        yield pa.record_batch({"i": pa.array([i], pa.int32()), "row": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros((width, width))
    for r in keys.mapInArrow(run, "i int, row binary").groupBy("i").applyInArrow(add, "i int, row binary").collect():
        out[r["i"]] = np.frombuffer(r["row"])
    return (out + out.T) / 2


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``x - S / n`` in double precision: the integers are subtracted before they are rounded."""
    return deviations(x, n, sums).astype(np.float64) / n


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n x - S``, exactly."""
    most = max(int(max(x.max(), -x.min())) * n, max(map(abs, sums)))
    if 2 * most < LIMIT:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def solved(rows: np.ndarray, r: np.ndarray, block: int = 64) -> np.ndarray:
    """``rows`` times the inverse of the upper triangular ``r``, by forward substitution."""
    out = np.empty_like(rows)
    for start in range(0, r.shape[1], block):
        end = min(start + block, r.shape[1])
        out[:, start:end] = rows[:, start:end] - out[:, :start] @ r[:start, start:end]
        for j in range(start, end):
            out[:, j] = (out[:, j] - out[:, start:j] @ r[start:j, j]) / r[j, j]
    return out


def factor(g: np.ndarray, shift: float = 0.0) -> np.ndarray:
    """The upper Cholesky factor of ``g``, or of ``g`` and the least shift that gives it one."""
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(len(g))).T
        except np.linalg.LinAlgError:
            shift = max(shift * 100, len(g) * UNIT * float(np.linalg.norm(g, 2)))


@dataclass
class Whitening:
    """``n`` distinct vectors of dimension ``d``, sums without the offset, and components as columns, by falling eigenvalue."""

    n: int
    d: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    passes: int = 0
    identity_error: float = 0.0

    def project(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums) @ self.components / np.sqrt(self.eigenvalues)


def fit(rows: DataFrame, vector: str = "embedding", most: int = COMPONENTS) -> Whitening | None:
    """The components of the distinct quantised vectors; None without a vector or where all are the same."""
    listed = fit_list(rows, vector)
    chosen = listed.groupBy("d").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    if not chosen:
        return None
    d, n = chosen[0]["d"], chosen[0]["n"]
    keys = listed.filter(F.col("d") == d).select("key")
    sums = totals(keys)

    g = gram(keys, d, lambda x: centred(x, n, sums))
    spread = float(np.trace(g))
    if not spread > 0:
        return None
    r = factor(g, 100 * d * UNIT * float(np.linalg.norm(g, 2)))
    steps: list[tuple[np.ndarray, np.ndarray | None]] = [(r, None)]  # factors to divide by, and bases to go over to after them

    def orthogonal(x: np.ndarray) -> np.ndarray:
        q = centred(x, n, sums)
        for upper, basis in steps:
            q = solved(q, upper)
            q = q if basis is None else q @ basis
        return q

    composed, passes = r, 1
    g = gram(keys, d, orthogonal)
    values, vectors = np.linalg.eigh(g)
    if (real := values > RANK).sum() < d:  # dependent dimensions: go on in those directions that hold data
        basis = vectors[:, real]
        steps[0] = (r, basis)
        composed, g = basis.T @ composed, np.diag(values[real])
    while float(np.abs(g - np.eye(len(g))).max()) > 8 * len(g) * UNIT * np.sqrt(n) and passes < PASSES:
        r = factor(g)
        steps.append((r, None))
        composed, passes = r @ composed, passes + 1
        g = gram(keys, len(g), orthogonal)
    _, singular, right = np.linalg.svd(composed, full_matrices=False)
    top = min(most, len(singular))
    model = Whitening(n, d, sums, right[:top].T.copy(), singular[:top] ** 2 / n, singular[:top] ** 2 / spread, passes)

    # a column of ones gathers the means, so that this covariance is centred as well
    both = gram(keys, top + 1, lambda x: np.hstack([np.ones((len(x), 1)), model.project(x)])) / n
    error = both[1:, 1:] - np.outer(both[0, 1:], both[0, 1:]) - np.eye(top)
    model.identity_error = float(np.abs(error).max())
    return model


def squares(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The sum over dimensions of ``(n x - S)**2``; None where no long holds it."""
    away = deviations(x, n, sums)
    if away.dtype != object:
        if int(max(away.max(), -away.min())) ** 2 * away.shape[1] < LIMIT:
            return (away * away).sum(1).tolist()
        away = away.astype(object)
    return [v if v < 1 << 63 else None for v in (away * away).sum(1).tolist()]


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(rows: DataFrame, model: Whitening | None, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """One row for each row of ``rows`` that takes part and each component, numbered from 1.

    Rows with a null vector, an empty one, a null or non-finite entry, or
    another dimension than the model's give none; nor does any where there is
    no model. Rows that repeat, or have a null id, each give theirs. Entries
    are bounded by 2**62 after scaling; ``deviation`` is null where no long
    holds it. Dimensions that depend on others leave fewer components.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, BATCH_BYTES):
            for at, x in quantised(batch.column(1)):
                if x.shape[1] != model.d:
                    continue
                k = len(model.eigenvalues)
                times = lambda values, kind: pa.array(np.repeat(np.asarray(values), k), kind)  # noqa: E731, B023
                ids = batch.column(0).take(pa.array(np.repeat(at, k)))
                size = len(at) * k
                yield pa.record_batch(
                    {
                        "vec_id": ids, "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))), "n": times([model.n] * len(at), pa.int64()),
                        "deviation": pa.array([v for v in squares(x, model.n, model.sums) for _ in range(k)], pa.int64()),
                        "whitened": pa.array(model.project(x).ravel()), "explained": pa.array(np.tile(model.explained, len(at))),
                        "identity_error": pa.array(np.full(size, model.identity_error)),
                    }
                )

    if model is None:
        return rows.sparkSession.createDataFrame([], SCHEMA)
    return rows.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("v")).mapInArrow(run, SCHEMA)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitened(rows, fit(rows))
