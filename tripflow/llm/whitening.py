"""Whitening of embeddings from an exact covariance by polarisation.

Entries become whole numbers. Centred values are squared and added exactly for
every dimension and for the sum of every two: the variance of a sum less both
variances is twice the covariance, so no product of two dimensions is taken.
Sums leave a task as one row per pair of dimensions and are added by Spark.
Only they, one number per pair, come to the driver, which decomposes the
matrix; vectors are projected where they lie.

Values are centred at the whole number next to the mean, so that squares stay
small however many rows there are; what that is off the mean is the same for
all rows and is taken out of the sums exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import stored

SCALE, SHIFT = 1024, 100_000
MOST = 1 << 40  # of a whole number; beyond it squares of many rows pass 38 digits
BATCH_ENTRIES = 1 << 18  # of a matrix at a time
_LIMB = 21

_SUMS = "i int, j int, total decimal(38,0)"
_DECIMAL = pa.decimal128(38, 0)


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and x, the whole numbers floor(1024 * c) + 100000 of each entry c.

    Vectors that are null or empty, or hold null, NaN or infinity, are left out.
    """
    entry = F.col(vector_col)
    bad = F.exists(
        entry, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf"))
    )
    scaled = F.transform(entry, lambda c: F.floor(SCALE * c.cast("double")) + SHIFT)
    return vectors.filter(entry.isNotNull() & (F.size(entry) > 0) & ~F.coalesce(bad, F.lit(True))).select(
        F.col(id_col).alias("vec_id"), scaled.alias("x")
    )


def _matrices(batches: Iterator[pa.RecordBatch], column: int, kind) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Parts of batches and their vectors as a matrix."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = batch.column(column).value_lengths().to_numpy()
        if lengths.min() != lengths.max():
            raise ValueError(f"vectors of {lengths.min()} and of {lengths.max()} entries")
        step = max(1, BATCH_ENTRIES // int(lengths[0]))
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            flat = part.column(column).flatten().to_numpy(zero_copy_only=False)
            yield part, flat.astype(kind).reshape(part.num_rows, -1)


def _rows(i: list, j: list, total: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([Decimal(t) for t in total], _DECIMAL)],
        names=["i", "j", "total"],
    )


def _plain_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per dimension i its sum, and under -1 the rows; j is the length of the vectors."""
    n, sums = 0, None
    for _, x in _matrices(batches, 1, np.int64):
        if np.abs(x).max() > MOST:
            raise ValueError("an entry is beyond 2^40 when scaled")
        own = x.sum(axis=0)
        if sums is not None and len(own) != len(sums):
            raise ValueError(f"vectors of {len(sums)} and of {len(own)} entries")
        n += len(x)
        sums = own.astype(object) if sums is None else sums + own
    if n:
        yield _rows([-1, *range(len(sums))], [len(sums)] * (len(sums) + 1), [n, *sums])


def _squares(z: np.ndarray) -> np.ndarray:
    """Exact sums of squares by column, as Python integers."""
    low = z & ((1 << _LIMB) - 1)
    high = z >> _LIMB
    total = np.einsum("ij,ij->j", low, low).astype(object)
    if high.any():
        total = total + (np.einsum("ij,ij->j", high, low).astype(object) << (_LIMB + 1))
        total = total + (np.einsum("ij,ij->j", high, high).astype(object) << (2 * _LIMB))
    return total


def _squared_sums(batches: Iterator[pa.RecordBatch], centre: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Per pair i <= j the sum of squares of u_i + u_j, and of u_i where they are equal."""
    d = len(centre)
    sums: list[np.ndarray | None] = [None] * d
    for _, x in _matrices(batches, 1, np.int64):
        u = np.asfortranarray(x - centre)
        for i in range(d):
            z = u[:, i:].copy()
            z[:, 1:] += u[:, i : i + 1]
            own = _squares(z)
            sums[i] = own if sums[i] is None else sums[i] + own
    if sums[0] is not None:
        for i, own in enumerate(sums):
            yield _rows([i] * (d - i), list(range(i, d)), own.tolist())


@dataclass(frozen=True)
class Whitening:
    """n rows, whole centres, sums off the centres, and the components that vary."""

    n: int
    centre: np.ndarray
    rest: np.ndarray  # sum of x - centre per dimension, less than n
    covariance: np.ndarray
    values: np.ndarray
    vectors: np.ndarray  # one column per component

    @property
    def explained(self) -> np.ndarray:
        return self.values / np.trace(self.covariance)


def _added(sums: DataFrame, keys: list[str]) -> list[tuple]:
    """One row per dimension, or per pair of dimensions, whatever the number of vectors."""
    table = sums.groupBy(*keys).agg(F.sum("total").alias("total")).toArrow()
    return list(zip(*(table.column(c).to_pylist() for c in [*keys, "total"]), strict=True))


def fit_whitening(whole: DataFrame, components: int = 8) -> Whitening | None:
    """Covariance of all vectors of ``whole_vectors`` and its leading components.

    None for an empty table. Components are unit eigenvectors by falling
    eigenvalue, their largest entry positive; those without variance (all but
    the rank of the covariance, to rounding) are left out. Vectors of different
    lengths are an error, as are entries beyond 2^40.
    """
    found = _added(whole.mapInArrow(_plain_sums, _SUMS), ["i", "j"])
    if not found:
        return None
    lengths = {j for _, j, _ in found}
    if len(lengths) > 1:
        raise ValueError(f"vectors of {min(lengths)} and of {max(lengths)} entries")
    by_dimension = {i: int(total) for i, _, total in found}
    n, d = by_dimension.pop(-1), lengths.pop()
    sums = [by_dimension[i] for i in range(d)]
    centre = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * c for s, c in zip(sums, centre, strict=True)]
    at = np.array(centre, np.int64)
    squares = _added(whole.mapInArrow(lambda batches: _squared_sums(batches, at), _SUMS), ["i", "j"])
    # n * sum(u^2) - (sum u)^2 is n times the sum of squares of x - mean.
    exact = [[0] * d for _ in range(d)]
    for i, j, total in squares:
        off = rest[i] if i == j else rest[i] + rest[j]
        exact[i][j] = n * int(total) - off * off
    covariance = np.empty((d, d))
    for i in range(d):
        covariance[i, i] = exact[i][i] / (n * n)
        for j in range(i + 1, d):
            both = exact[i][j] - exact[i][i] - exact[j][j]
            covariance[i, j] = covariance[j, i] = both / (2 * n * n)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = np.flatnonzero(values > values[0] * d * np.finfo(float).eps)[:components]
    values, vectors = values[keep], vectors[:, keep]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(keep))])
    return Whitening(n, at, np.array(rest, dtype=object), covariance, values, vectors * signs)


def _deviations(u: np.ndarray, n: int, rest: np.ndarray) -> list[Decimal]:
    """Exact sums of (n * u - rest)^2 per row."""
    largest = n * (int(np.abs(u).max()) + 1)
    if largest * largest * u.shape[1] < 2**63:
        y = n * u - rest.astype(np.int64)
        return [Decimal(v) for v in np.einsum("ij,ij->i", y, y).tolist()]
    y = n * u.astype(object) - rest
    return [Decimal(v) for v in (y * y).sum(axis=1)]


def _projected(batches: Iterator[pa.RecordBatch], fit: Whitening) -> Iterator[pa.RecordBatch]:
    off = (fit.rest / fit.n).astype(float)
    scaled = fit.vectors / np.sqrt(fit.values)
    for part, x in _matrices(batches, 1, np.int64):
        u = x - fit.centre
        whitened = (u - off) @ scaled
        offsets = np.arange(len(u) + 1, dtype=np.int32) * whitened.shape[1]
        yield pa.RecordBatch.from_arrays(
            [
                part.column(0),
                pa.array(_deviations(u, fit.n, fit.rest), _DECIMAL),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(whitened.ravel())),
            ],
            names=["vec_id", "deviation", "whitened"],
        )


def whiten(whole: DataFrame, fit: Whitening) -> DataFrame:
    """Every vector in the components of a fit: vec_id, deviation, whitened (an array)."""
    kind = whole.schema["vec_id"].dataType.simpleString()
    return whole.mapInArrow(
        lambda batches: _projected(batches, fit),
        f"vec_id {kind}, deviation decimal(38,0), whitened array<double>",
    )


def _moments(batches: Iterator[pa.RecordBatch], k: int, mean: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Sums per component, or with means of products of every two centred components."""
    total = np.zeros(k) if mean is None else np.zeros((k, k))
    for batch in batches:
        w = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
        total += w.sum(axis=0) if mean is None else (w - mean).T @ (w - mean)
    at = np.arange(total.size, dtype=np.int32)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel())], names=["at", "total"])


def identity_error(whitened: DataFrame, n: int, k: int) -> float:
    """Largest absolute entry of the covariance of stored whitened rows less the identity."""
    rows = whitened.select("whitened")

    def added(mean):
        parts = rows.mapInArrow(lambda batches: _moments(batches, k, mean), "at int, total double")
        table = parts.groupBy("at").agg(F.sum("total").alias("total")).orderBy("at").toArrow()
        return table.column("total").to_numpy() / n

    if not k:
        return 0.0
    return float(np.abs(added(added(None)).reshape(k, k) - np.eye(k)).max())


def whitened_components(
    vectors: DataFrame, components: int = 8, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Every vector's leading whitened components, a row each.

    Columns: vec_id, component (from 1), n, deviation_exact, whitened,
    explained, identity_error. The fit is over all vectors that are neither
    null nor empty and hold only finite numbers; others have no rows. Repeated
    rows count each and a null id stays null. Of equal eigenvalues the order is
    the solver's. A table without vectors, or whose vectors are all the same
    and so have no component, gives an empty result. Extra columns are ignored.
    """
    whole = whole_vectors(vectors, id_col, vector_col)
    kind = whole.schema["vec_id"].dataType.simpleString()
    fit = fit_whitening(whole, components)
    if fit is None or not len(fit.values):
        schema = (
            f"vec_id {kind}, component int, n long, deviation_exact decimal(38,0),"
            " whitened double, explained double, identity_error double"
        )
        return vectors.sparkSession.createDataFrame([], schema)
    rows = stored(whiten(whole, fit), "whitened")
    error = identity_error(rows, fit.n, len(fit.values))
    explained = F.array(*[F.lit(float(e)) for e in fit.explained])
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "value")).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(fit.n).cast("long").alias("n"),
        F.col("deviation").alias("deviation_exact"),
        F.col("value").alias("whitened"),
        F.element_at(explained, F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
