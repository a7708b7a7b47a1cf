"""Embedding whitening with refined eigenvectors (12).

Entries become whole numbers x = floor(64 c) + 1000000.  The fit list holds each distinct x vector once.
Spark sums it exactly, then sums the products of its centred vectors: each dimension is centred on the
whole number next to its mean, so a task's products are exact doubles and their totals exact longs, and
the rest of the centring (less than one in each dimension) is subtracted exactly at the end.  Offsets of
1000000 never meet a product.

The covariance, dimensions by dimensions, is what the driver solves: float32 eigenvectors, then
Ogita-Aishima iterations (matrix products only) in extended precision until the correction vanishes.
Eigenvalues closer than the iteration can tell apart form clusters; each is solved as a small eigenproblem
shifted by its mean, which resolves it to its own scale, and the iteration goes on.  A second pass over
the fit list measures how far the whitened covariance is from the identity.

Odd input: null vectors and vectors with null or non-finite entries are dropped; shorter and empty
vectors count as padded with zero entries; null and repeated vec_ids are rows like any other.  A component
whose variance is zero up to the precision of the covariance has null ``whitened`` and explains 0 and is
left out of ``identity_error``, which is null if no component is left.  ``deviation`` is a decimal(38,0), null beyond 38 digits (a long in the query,
null beyond).  Entries whose scaled value does not fit 32 bits are summed as doubles and their deviation is rounded.
An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm.common import materialize, slices, table
from tillwise.llm.vector_blocks import Extent, extent, floors, takes_part, vectors_of

SCALE = 64
COMPONENTS = 16
DIGITS = 10 ** 38


def _keys(shape: Extent, scale: int):
    """One binary per row: the scaled vector, which stands for x (x less 1000000 in every dimension)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2_000):
            values, _ = floors(part.column(0), scale, shape.dim)
            yield pa.RecordBatch.from_pydict(
                {"z": pa.array([v.tobytes() for v in (values + 0.0).astype(shape.dtype)], pa.binary())})

    return run


def _sums(shape: Extent):
    """Per task: the number of vectors (dim -1) and the sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * shape.dim
        for part in slices(batches, 8_192):
            z, n = vectors_of(part.column(0), shape.dtype, shape.dim), n + len(part)
            sums = z.sum(axis=0, dtype="f8" if shape.dtype.kind == "f" else "i8")
            total = [a + int(b) for a, b in zip(total, sums)]
        yield pa.RecordBatch.from_pydict({
            "dim": pa.array(range(-1, shape.dim), pa.int32()),
            "total": pa.array([_decimal(v) for v in [n, *total]], pa.decimal128(38, 0))})

    return run


def _decimal(value: int) -> Decimal | None:
    return Decimal(value) if abs(value) < DIGITS else None


@dataclass(frozen=True)
class Centre:
    """Number of fitted vectors, the whole number next to each mean, and n times the rest."""

    n: int
    whole: list[int]
    rest: list[int]

    @property
    def fraction(self) -> np.ndarray:
        return np.array([r / self.n for r in self.rest])


def _widest(shape: Extent, centre: Centre) -> int:
    """The largest distance of an entry from its centre."""
    return max([max(int(h) - m, m - int(lo)) for lo, h, m in zip(shape.low, shape.high, centre.whole)], default=0)


def _products(shape: Extent, centre: Centre, exact: bool):
    """Per task: sums of products (i, j), i <= j, of vectors centred on whole numbers (in full if not exact)."""
    most = _widest(shape, centre)
    rows = int(max(1, min(8_192, (1 << 52) // max(1, most * most)))) if exact else 8_192
    middle = np.array(centre.whole, "f8") + (0.0 if exact else centre.fraction)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((shape.dim, shape.dim), "i8" if exact else "f8")
        for part in slices(batches, rows):
            d = vectors_of(part.column(0), shape.dtype, shape.dim).astype("f8") - middle
            total += (d.T @ d).astype(total.dtype)
        i, j = np.triu_indices(shape.dim)
        yield pa.RecordBatch.from_pydict({"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()),
                                          "v": pa.array(total[i, j])})

    return run


def covariance(fit: DataFrame, shape: Extent) -> tuple[Centre, np.ndarray]:
    """Centre and covariance (extended precision) of the fit list; the driver sees sums per dimension
    and per pair of dimensions only."""
    sums = dict(fit.mapInArrow(_sums(shape), "dim int, total decimal(38,0)").groupBy("dim")
                .agg(F.sum("total").cast("decimal(38,0)")).collect())
    n = int(sums.get(-1) or 0)
    if not n:
        return Centre(0, [0] * shape.dim, [0] * shape.dim), np.zeros((shape.dim, shape.dim), np.longdouble)
    totals = [int(sums[d]) for d in range(shape.dim)]
    whole = [(2 * s + n) // (2 * n) for s in totals]
    centre = Centre(n, whole, [s - n * m for s, m in zip(totals, whole)])
    most = _widest(shape, centre)
    exact = shape.dtype.kind != "f" and most * most < 1 << 52 and n * most * most < 1 << 62
    pairs = (fit.mapInArrow(_products(shape, centre, exact), f"i int, j int, v {'long' if exact else 'double'}")
             .groupBy("i", "j").agg(F.sum("v")).collect())
    v = np.zeros((shape.dim, shape.dim), np.longdouble)
    for i, j, p in pairs:
        if exact:
            top = n * int(p) - centre.rest[i] * centre.rest[j]
            head = float(top)
            v[i, j] = v[j, i] = (np.longdouble(head) + np.longdouble(float(top - int(head)))) / (np.longdouble(n) * n)
        else:
            v[i, j] = v[j, i] = np.longdouble(p) / n
    return centre, v


def groups_of(values: np.ndarray, width: np.longdouble) -> list[np.ndarray]:
    """Indices of eigenvalues in runs whose neighbours are at most ``width`` apart; runs of two or more."""
    order = np.argsort(values)
    cuts = np.nonzero(np.diff(values[order]) > width)[0] + 1
    return [g for g in np.split(order, cuts) if len(g) > 1]


RESOLVED = 1e-9   # gaps below this share of the matrix are left to the clusters


def refine(a: np.ndarray, x: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of the symmetric ``a`` from approximate eigenvectors ``x``.

    One iteration forms R = I - X'X and S = X'AX, takes the Rayleigh quotients, and corrects X by X E:
    E splits the residual by the gap of two eigenvalues where the gap is wider than the error bound, and
    only restores orthogonality where it is not.  R and S are kept symmetric, so E never spoils
    orthogonality.  What is closer forms clusters; each is solved apart as a small problem, shifted by its
    mean and scaled to its own spread, and its vectors are turned within the space that they span."""
    a, x = a.astype(np.longdouble), x.astype(np.longdouble)
    eye, scale = np.eye(len(a), dtype=np.longdouble), np.sqrt((a * a).sum())
    tiny, last = np.finfo(np.longdouble).eps, np.inf

    def quotients(x):
        r, s = eye - x.T @ x, x.T @ (a @ x)
        r, s = (r + r.T) / 2, (s + s.T) / 2
        return r, s, np.diag(s) / (1 - np.diag(r))

    for _ in range(rounds):
        r, s, values = quotients(x)
        off = s - np.diag(values)
        bound = max(2 * (np.sqrt((off * off).sum()) + scale * np.sqrt((r * r).sum())), RESOLVED * scale)
        gap = values[None, :] - values[:, None]
        close = np.abs(gap) <= bound
        e = np.where(close, r / 2, (s + values[None, :] * r) / np.where(close, 1, gap))
        x = x + x @ e
        for g in groups_of(values, bound):
            inner = np.eye(len(g), dtype=np.longdouble)
            xg = x[:, g]
            shift = values[g].mean()
            small = xg.T @ (a @ xg - shift * xg)
            size = np.abs(small).max()
            if size > tiny * scale:
                _, turn = np.linalg.eigh(((small + small.T) / (2 * size)).astype(np.float64))
                xg = xg @ turn.astype(np.longdouble)
            x[:, g] = xg + xg @ ((inner - xg.T @ xg) / 2)
        change = np.abs(e).max(initial=0)
        if change <= 8 * tiny or change >= last / 4 and change < 1e-12:
            break
        last = change
    _, _, values = quotients(x)
    return values, x / np.sqrt((x * x).sum(axis=0))


@dataclass(frozen=True)
class Whitener:
    """Eigenvalues (falling), the share of variance each explains, and the matrix that whitens."""

    values: np.ndarray
    explained: np.ndarray
    matrix: np.ndarray
    vectors: np.ndarray


def solve(v: np.ndarray, components: int) -> Whitener:
    """The ``components`` leading ones of the covariance ``v``; a component of no variance has a zero column."""
    size = float(np.abs(v).max(initial=0)) or 1.0
    _, start = np.linalg.eigh((v / size).astype(np.float32))
    values, x = refine(v / np.longdouble(size), start)
    order = np.argsort(-values, kind="stable")[:components]
    values, x = values[order], x[:, order]
    x = x * np.where(np.take_along_axis(x, np.abs(x).argmax(axis=0)[None, :], 0)[0] < 0, -1, 1) if len(order) else x
    real = values > len(v) * np.finfo(np.float64).eps * max(values.max(initial=0), 0)
    root = np.sqrt(np.where(real, values * size, 1))
    trace = np.trace(v) / size
    return Whitener((values * size).astype("f8"), np.where(real, values / (trace or 1), 0).astype("f8"),
                    (np.where(real, x / root, 0)).astype("f8"), x.astype("f8"))


def _second_moments(shape: Extent, centre: Centre, matrix: np.ndarray):
    """Per task: sums of whitened values (i, -1) and of their products (i, j)."""
    whole, fraction = np.array(centre.whole, "f8"), centre.fraction

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = matrix.shape[1]
        one, two = np.zeros(k), np.zeros((k, k))
        for part in slices(batches, 8_192):
            y = (vectors_of(part.column(0), shape.dtype, shape.dim).astype("f8") - whole - fraction) @ matrix
            one, two = one + y.sum(axis=0), two + y.T @ y
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_pydict({
            "i": pa.array(np.append(np.arange(k), i), pa.int32()),
            "j": pa.array(np.append(np.full(k, -1), j), pa.int32()), "v": pa.array(np.append(one, two[i, j]))})

    return run


def identity_error(fit: DataFrame, shape: Extent, centre: Centre, white: Whitener) -> float | None:
    """Largest absolute entry of the whitened fit list's covariance less the identity, over the
    components that have variance; None if there is none."""
    real = white.matrix.any(axis=0)
    if not real.any():
        return None
    found = {(i, j): v / centre.n for i, j, v in
             fit.mapInArrow(_second_moments(shape, centre, white.matrix[:, real]), "i int, j int, v double")
             .groupBy("i", "j").agg(F.sum("v")).collect()}
    return max(abs(v - found[i, -1] * found[j, -1] - (i == j)) for (i, j), v in found.items() if j >= 0)


def _whiten(shape: Extent, scale: int, centre: Centre, white: Whitener):
    """(vec_id, vector) to (vec_id, deviation, whitened): one row each, all components in an array."""
    whole, fraction, n = np.array(centre.whole, "f8"), centre.fraction, centre.n
    real = white.matrix.any(axis=0)
    rest, base = centre.rest, sum(r * r for r in centre.rest)
    most = _widest(shape, centre)
    short = shape.dtype.kind != "f" and shape.dim * (n * most + max(map(abs, rest), default=0)) ** 2 < 1 << 62
    fits = shape.dtype.kind != "f" and shape.dim * most * max(most, n) < 1 << 62

    def deviations(d: np.ndarray) -> list[Decimal | None]:
        """Sum of (n d - rest) squared: as longs if they hold it, else put together from sums that they
        hold (n^2 d.d - 2 n d.rest + rest.rest), else from Python integers throughout."""
        if short:
            far = n * d.astype("i8") - np.array(rest, "i8")
            return [Decimal(int(v)) for v in (far * far).sum(axis=1)]
        if fits:
            whole_d, r = d.astype("i8"), np.array(rest, "i8")
            pairs = zip((whole_d * whole_d).sum(axis=1).tolist(), (whole_d @ r).tolist())
            return [_decimal(n * n * a - 2 * n * b + base) for a, b in pairs]
        return [_decimal(sum((n * int(v) - r) ** 2 for v, r in zip(row, rest))) for row in d]

    schema = pa.schema([("vec_id", pa.int64()), ("deviation", pa.decimal128(38, 0)), ("whitened", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2_000):
            d = floors(part.column(1), scale, shape.dim)[0] - whole
            y = (d - fraction) @ white.matrix
            flat = pa.array(y.ravel(), mask=np.tile(~real, len(d)))
            ends = pa.array(np.arange(len(d) + 1) * y.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(deviations(d), pa.decimal128(38, 0)),
                 pa.ListArray.from_arrays(ends, flat)], schema=schema)

    return run


COLUMNS = ("vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, "
           "identity_error double")


def whiten(rows: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """One row per remaining row of ``rows`` (vec_id, embedding) and component: see COLUMNS."""
    used = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(takes_part("embedding", scale))
    shape = extent(used, "embedding", scale)
    if not shape.rows or not shape.dim:
        return rows.sparkSession.createDataFrame([], COLUMNS)
    fit = materialize(used.select("embedding").mapInArrow(_keys(shape, scale), "z binary").distinct(), "whitening-fit")
    centre, v = covariance(fit, shape)
    white = solve(v, components)
    error = identity_error(fit, shape, centre, white)
    done = used.mapInArrow(_whiten(shape, scale, centre, white),
                           "vec_id long, deviation decimal(38,0), whitened array<double>")
    explained = F.array(*[F.lit(float(e)) for e in white.explained])
    return done.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(centre.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("long"))
