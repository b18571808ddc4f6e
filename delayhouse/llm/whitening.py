"""Whitening of embeddings by refined principal components.

Components become integers, and every distinct vector counts once (the fit list). Its sums and covariance are added up in tasks and
by a shuffle on the matrix row, so the driver sees one matrix of the vectors' dimension squared, never a vector. The
eigenvectors are taken in float32 and corrected in float64 by the iteration of Ogita and Aishima, which is
matrix products alone: from R = I - X'X and S = X'AX follow eigenvalues s_i / (1 - r_i) and a correction X + XE. It
cannot separate eigenvalues that are closer than its own error; those clusters are rotated by a small dense solve of X'AX, shifted
by the cluster's mean, and the iteration goes on. Rows are then projected in one pass with a broadcast model of at most
``COMPONENTS`` vectors.

Defined cases: vectors that are null, empty or hold a null or non-finite entry, or one whose integer does not fit into 62 bits, are dropped,
as are those whose length is not the most common one (ties: the longest); a null identifier is kept; repeated rows
give repeated results, but one entry of the fit list; a component without variance has a null ``whitened`` and takes no part in
``identity_error``; ``explained`` is null without any variance, ``identity_error`` without any component that has some; a
``deviation`` beyond 63 bits is null; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Stages
from .common import table

COMPONENTS = 16
SCALE, OFFSET = 64, 1_000_000
#: Most corrections; each squares the error, so three do unless clusters have to be solved between them.
ITERATIONS = 12
#: Rows of a piece of a batch.
ROWS = 4096
#: Eigenvalues closer than this share of the largest are a cluster, whatever the vectors' error: a quotient by their distance
#: would magnify rounding.
TOGETHER = 1e-6


# ---- eigenvectors ----------------------------------------------------------------------------------------------------


def corrected(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One step: eigenvalues, better eigenvectors, and the distance below which eigenvalues could not be told apart."""
    product = a @ x
    lack = np.eye(len(a)) - x.T @ x
    inner = x.T @ product
    inner = (inner + inner.T) / 2  # else rounding, divided by a small distance, would cost orthogonality
    values = np.diag(inner) / (1 - np.diag(lack))
    off = inner - np.diag(values)
    norm = np.linalg.norm(a, 2)
    near = 2 * (np.linalg.norm(off, 2) + norm * np.linalg.norm(lack, 2))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > max(near, TOGETHER * norm)
    change = np.where(apart, (inner + values[None, :] * lack) / np.where(apart, gap, 1), lack / 2)
    return values, x + x @ change, float(near)


def clusters(values: np.ndarray, near: float) -> list[np.ndarray]:
    """Places of eigenvalues, in falling order, that hang together by steps of at most ``near``; at least two each."""
    order = np.argsort(-values, kind="stable")
    cuts = np.flatnonzero(-np.diff(values[order]) > near) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def separated(a: np.ndarray, x: np.ndarray, group: np.ndarray) -> np.ndarray:
    """The vectors of one cluster, turned within the space they span so that they are eigenvectors of it."""
    own, _ = np.linalg.qr(x[:, group])
    inner = own.T @ (a @ own)
    centre = np.trace(inner) / len(group)
    inner = (inner + inner.T) / 2 - centre * np.eye(len(group))
    _, turn = np.linalg.eigh(inner)
    return own @ turn[:, ::-1]


def eigenvectors(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and unit eigenvectors of a symmetric matrix, float32 first, then corrected."""
    scale = np.abs(a).max(initial=0)
    if not scale:
        return np.zeros(len(a)), np.eye(len(a))
    a = a / scale
    _, x = np.linalg.eigh(a.astype(np.float32))
    x = x.astype(np.float64)
    together = TOGETHER * np.linalg.norm(a, 2)
    best = np.inf
    for _ in range(ITERATIONS):
        values, better, near = corrected(a, x)
        if near >= best / 2 and near < 1e-10:  # no longer limited by the vectors, but by rounding
            break
        best, x = near, better
        # Vectors that the step above could not part: the space they span is right to first order, its axes are not.
        for group in clusters(values, max(near, together)):
            x[:, group] = separated(a, x, group)
    values = np.einsum("ij,ij->j", x, a @ x) / np.einsum("ij,ij->j", x, x)
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.linalg.norm(x[:, order], axis=0)
    return values[order] * scale, x


# ---- sums over the fit list ------------------------------------------------------------------------------------------


def integers(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")).cast("long") + F.lit(OFFSET))


def usable(vector: Column) -> Column:
    """Whether every entry is there, finite, and small enough for its integer."""
    fits = lambda c: c.isNotNull() & (F.abs(F.lit(float(SCALE)) * c.cast("double")) < float(2**62))
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda c: F.coalesce(fits(c), F.lit(False)))


def _matrices(batches, column: str):
    """Pieces of a column of equally long lists, as matrices."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            piece = batch.slice(start, ROWS)
            if piece.num_rows:
                yield piece, piece.column(column).flatten().to_numpy(zero_copy_only=False).reshape(piece.num_rows, -1)


def sums(fit: DataFrame, dimension: int) -> tuple[int, list[int]]:
    """Number of vectors, and exact sums of each dimension."""

    def added(batches):
        n, high, low = 0, np.zeros(dimension, np.int64), np.zeros(dimension, np.int64)
        for _, x in _matrices(batches, "x"):
            n += len(x)
            high += (x >> 32).sum(0)
            low += (x & 0xFFFFFFFF).sum(0)
        columns = [pa.array(np.arange(dimension, dtype=np.int32)), pa.array(np.full(dimension, n, np.int64)), pa.array(high), pa.array(low)]
        yield pa.RecordBatch.from_arrays(columns, ["place", "n", "high", "low"])

    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    found = fit.mapInArrow(added, "place int, n long, high long, low long").groupBy("place").agg(total("n"), total("high"), total("low"))
    rows = sorted(found.collect())
    return (int(rows[0]["n"]), [int(r["high"]) * 2**32 + int(r["low"]) for r in rows]) if rows else (0, [])


class Centre(NamedTuple):
    """What a vector is held against: its distance from the mean, times n, is an exact integer."""

    n: int
    whole: np.ndarray  # integer parts of the means
    rest: np.ndarray  # n * whole - sum, above -n and at most 0

    @staticmethod
    def of(n: int, totals: list[int]) -> Centre:
        whole = [s // n for s in totals]
        return Centre(n, np.array(whole, np.int64), np.array([n * w - s for w, s in zip(whole, totals)], np.int64))

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) + self.rest / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2 of each row."""
        near = (x - self.whole).astype(np.float64)
        rough = ((np.abs(near) * self.n + self.n) ** 2).sum(1)
        small = rough < 2.0**62
        found: list[int | None] = [None] * len(x)
        distance = self.n * (x[small] - self.whole) + self.rest
        for i, total in zip(np.flatnonzero(small).tolist(), (distance * distance).sum(1).tolist()):
            found[i] = total
        for i in np.flatnonzero(~small).tolist():
            total = sum((self.n * (int(v) - w) + r) ** 2 for v, w, r in zip(x[i].tolist(), self.whole.tolist(), self.rest.tolist()))
            found[i] = total if total < 2**63 else None
        return found


def _row_sums(partial: DataFrame, width: int) -> np.ndarray:
    """Matrix rows (place, numbers) of many tasks, added up by a shuffle on the place; ``width`` numbers each."""

    def added(batches):
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for place, raw in zip(batch.column("place").to_pylist(), batch.column("numbers")):
                numbers = np.frombuffer(raw.as_buffer(), np.float64)
                found[place] = found[place] + numbers if place in found else numbers.copy()
        columns = [pa.array(list(found), pa.int32()), pa.array([x.tobytes() for x in found.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["place", "numbers"])

    rows = partial.repartition("place").mapInArrow(added, "place int, numbers binary").collect()
    rows.sort(key=lambda r: r["place"])
    return np.array([np.frombuffer(r["numbers"], np.float64) for r in rows]).reshape(len(rows), width)


def _told(matrix: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(np.arange(len(matrix), dtype=np.int32)), pa.array([np.ascontiguousarray(r).tobytes() for r in matrix], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["place", "numbers"])


def covariance(fit: DataFrame, centre: Centre) -> np.ndarray:
    """Of the fit list, divisor n, centred before multiplying."""
    dimension = len(centre.whole)

    def multiplied(batches):
        total = np.zeros((dimension, dimension))
        for _, x in _matrices(batches, "x"):
            z = centre.centred(x)
            total += z.T @ z
        yield _told(total)

    total = _row_sums(fit.mapInArrow(multiplied, "place int, numbers binary"), dimension) / centre.n
    return (total + total.T) / 2


class Model(NamedTuple):
    """Broadcast: a centre and at most ``COMPONENTS`` directions, divided by the square root of their eigenvalue."""

    centre: Centre
    directions: np.ndarray  # dimension x components; not a number where there is no variance
    explained: list[float | None]
    error: float | None

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ self.directions


def identity_error(fit: DataFrame, model: Model) -> float | None:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity, measured."""
    some = np.isfinite(model.directions).all(0)
    model = model._replace(directions=model.directions[:, some])
    k, n = int(some.sum()), model.centre.n
    if not k:
        return None

    def multiplied(batches):
        total = np.zeros((k + 1, k))  # products, and the sums in the last row
        for _, x in _matrices(batches, "x"):
            w = model.whitened(x)
            total[:k] += w.T @ w
            total[k] += w.sum(0)
        yield _told(total)

    total = _row_sums(fit.mapInArrow(multiplied, "place int, numbers binary"), k) / n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def fitted(fit: DataFrame, dimension: int, components: int) -> Model:
    """The model of a table of distinct vectors ``x`` of one length."""
    centre = Centre.of(*sums(fit, dimension))
    spread = covariance(fit, centre)
    values, vectors = eigenvectors(spread)
    k, total = min(components, dimension), float(np.trace(spread))
    # Below the rounding of the matrix a value is not told from zero.
    floor = dimension * np.finfo(float).eps * max(float(values[0]), 0.0)
    roots = np.sqrt(np.where(values[:k] > floor, values[:k], np.nan))
    explained = [max(float(v), 0.0) / total if total else None for v in values[:k]]
    model = Model(centre, vectors[:, :k] / roots, explained, None)
    return model._replace(error=identity_error(fit, model))


# ---- the operator ----------------------------------------------------------------------------------------------------


def whiten(spark: SparkSession, rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of rows (vec_id, embedding)."""
    identifier = rows.schema["vec_id"].dataType.simpleString()
    result = f"vec_id {identifier}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = rows.select("vec_id", "embedding").filter(usable(F.col("embedding"))).select("vec_id", integers(F.col("embedding")).alias("x"))
    lengths = rows.groupBy(F.size("x").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("length")).select("length").first()
    if common is None:
        return spark.createDataFrame([], result)
    rows = rows.filter(F.size("x") == common[0])
    with Stages(spark) as stages:
        fit = stages.add(rows.select("x").distinct(), "whiten-fit")
        model = fitted(fit, common[0], components)
    held = spark.sparkContext.broadcast(model)

    def projected(batches):
        model: Model = held.value
        k = len(model.explained)
        for batch, x in _matrices(batches, "x"):
            w = model.whitened(x).ravel()
            m = len(x)
            columns = [
                batch.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, model.centre.n, np.int64)),
                pa.array(model.centre.deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(w, mask=np.isnan(w)),
                pa.array(model.explained * m, pa.float64()),
                pa.array([model.error] * (m * k), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(projected, result)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on their first components."""
    return whiten(spark, table(spark, sf_dir, "embeddings"))
