"""Whitening of vectors: eigenpairs of their covariance kept up to date by rank-one changes.

Every partition holds a spectrum: the weight and mean of its vectors and the eigenpairs of their
scatter matrix. A vector changes the scatter by one centred rank-one term; the new eigenvalues are the
roots of a secular equation, once entries that don't take part have been deflated, and the new
eigenvectors follow from the roots. Two spectra are combined by as many rank-one changes as the one has
eigenvectors, and one for the distance of the means; a tree of groups combines all partitions'. The
result's eigenvectors are refined by one Rayleigh-Ritz step: the covariance in their basis is summed over all
rows, exactly centred, and its eigenpairs turn the basis. Only matrices of the vectors' length pass the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempora.session import shared_path

SCALE, SHIFT = 64, 1_000_000
FAN = 8          # spectra, or sums, that one task combines
LIMIT = 1 << 62  # a quantised entry is below
EPS = np.finfo(np.float64).eps


# ---------------------------------------------------------------------------
# Rank-one changes.
# ---------------------------------------------------------------------------
def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> np.ndarray:
    """``d[i] - root[j]`` at [j, i], for the roots of 1 + rho * sum(z[i]**2 / (d[i] - x)) = 0.

    ``d`` ascends strictly, ``z`` has no zeros, rho > 0: root j lies between d[j] and d[j + 1], the last one at most
    rho * |z|**2 above. A root is held as its distance from the nearer end of its gap, so that differences keep their
    digits; steps come from a rational model with the poles at both ends, and halve the bracket where they leave it.
    """
    k = len(d)
    zz = rho * z * z
    if k == 1:
        return -zz[:, None]
    top = np.append(d[1:], d[-1] + zz.sum())
    gap = top - d
    diff = d[None, :] - d[:, None]
    middle = 1 + (zz / (diff - 0.5 * gap[:, None])).sum(1)
    right = (middle < 0) & (np.arange(k) < k - 1)
    origin = np.where(right, top, d)
    rel = d[None, :] - origin[:, None]             # poles, from each root's origin
    low, high = np.where(right, -0.5 * gap, 0.0), np.where(right, 0.0, np.where(np.arange(k) < k - 1, 0.5 * gap, gap))
    near, far = np.where(right, -gap, 0.0), np.where(right, 0.0, gap)  # the two poles of the model
    tau = 0.5 * (low + high)
    lower = np.tri(k, dtype=bool)
    with np.errstate(all="ignore"):
        for _ in range(100):
            delta = rel - tau[:, None]
            t = zz / delta
            f = 1 + t.sum(1)
            small = np.abs(f) <= 4 * EPS * (1 + np.abs(t).sum(1))
            if small.all():
                break
            high, low = np.where(f > 0, tau, high), np.where(f > 0, low, tau)
            t /= delta
            slope = t.sum(1)
            psi = np.where(lower, t, 0).sum(1)
            d1, d2 = near - tau, far - tau
            a = (d1 + d2) * f - d1 * d2 * slope
            b = d1 * d2 * f
            c = f - d1 * psi - d2 * (slope - psi)
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            new = tau + step
            bad = ~((new > low) & (new < high))
            new = np.where(bad, 0.5 * (low + high), new)
            moved = np.abs(new - tau) > EPS * np.abs(new)
            tau = np.where(small, tau, new)
            if not (moved & ~small).any():
                break
    return rel - tau[:, None]


def rank_one(values: np.ndarray, vectors: np.ndarray, u: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs of vectors * diag(values) * vectors.T + rho * u * u.T for rho >= 0; values ascend, vectors are columns."""
    z = u @ vectors
    norm = float(np.sqrt(z @ z))
    if not norm or not rho:
        return values, vectors
    z = z / norm
    rho = rho * norm * norm
    tol = 8 * EPS * max(abs(values[-1]), abs(values[0]), rho)
    vectors = vectors.copy()
    active = rho * np.abs(z) > tol
    idx = np.flatnonzero(active)
    if not len(idx):
        return values, vectors
    # Of two values that are equal, as far as z is concerned, a rotation takes one out.
    zi, di = z[idx], values[idx]
    if len(idx) > 1 and (np.diff(di) * np.abs(zi[1:] * zi[:-1]) <= tol * (zi[1:] ** 2 + zi[:-1] ** 2)).any():
        values = values.copy()
        last = None
        for i in idx.tolist():
            if last is not None:
                r = float(np.hypot(z[last], z[i]))
                c, s = z[i] / r, z[last] / r
                t = values[i] - values[last]
                if abs(t * c * s) <= tol:
                    z[i], z[last] = r, 0.0
                    a, b = vectors[:, last].copy(), vectors[:, i].copy()
                    vectors[:, last], vectors[:, i] = c * a - s * b, s * a + c * b
                    va, vb = values[last], values[i]
                    values[last], values[i] = c * c * va + s * s * vb, s * s * va + c * c * vb
                    active[last] = False
            last = i
        idx = np.flatnonzero(active)
        idx = idx[np.argsort(values[idx], kind="stable")]
    d, zi = values[idx], z[idx]
    if len(idx) > 1 and not (np.diff(d) > 0).all():  # rounding left two alike: the plain way
        full = (vectors * values) @ vectors.T + rho * np.outer(vectors @ z, vectors @ z)
        return np.linalg.eigh(full)
    minus = secular_roots(d, zi, rho)                # [root, pole]
    k = len(idx)
    roots = _values(d, minus)
    # The z for which these roots are exact: eigenvectors are then orthogonal.
    between = d[None, :] - d[:, None]
    between[np.arange(k), np.arange(k)] = 1.0
    exact = np.sqrt(np.abs(np.prod(minus / between, axis=0))) * np.sign(zi)
    w = exact[None, :] / minus
    w /= np.sqrt((w * w).sum(1))[:, None]
    vectors[:, idx] = vectors[:, idx] @ w.T
    values = values.copy()
    values[idx] = roots
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


def _values(d: np.ndarray, minus: np.ndarray) -> np.ndarray:
    """Each root from its nearest pole."""
    at = np.abs(minus).argmin(1)
    return d[at] - minus[np.arange(len(d)), at]


class Spectrum:
    """Weight, mean, exact sums and the eigenpairs of the scatter of some vectors."""

    def __init__(self, size: int):
        self.n = 0
        self.mean = np.zeros(size)
        self.sums = [0] * size
        self.values = np.zeros(size)
        self.vectors = np.eye(size)

    def _move(self, n: int, mean: np.ndarray) -> None:
        """The change that the mean's move makes, when ``n`` vectors with this mean join."""
        total = self.n + n
        far = mean - self.mean
        if self.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, far, self.n * (n / total))
        self.mean = self.mean + far * (n / total)
        self.n = total

    def add(self, x: np.ndarray, n: int = 1) -> None:
        """``n`` copies of a vector."""
        self._move(n, x)

    def join(self, other: Spectrum) -> None:
        """Another spectrum's vectors: a rank-one change for each of its eigenvectors, and one for the means."""
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, vector, float(value))
        self._move(other.n, other.mean)
        self.sums = [a + b for a, b in zip(self.sums, other.sums)]


SPECTRUM = "place long, n long, sums array<string>, mean array<double>, eigenvalues array<double>, eigenvectors array<double>"


def _spectrum_row(place: int, s: Spectrum) -> pa.Table:
    """The sums as decimal text: they may exceed 64 bits."""
    return pa.table({"place": pa.array([place], pa.int64()), "n": pa.array([s.n], pa.int64()),
                     "sums": pa.array([[str(x) for x in s.sums]], pa.list_(pa.string())),
                     **{k: pa.array([v.ravel()], pa.list_(pa.float64()))
                        for k, v in (("mean", s.mean), ("eigenvalues", s.values), ("eigenvectors", s.vectors))}})


def _spectra(table: pa.Table) -> Iterator[Spectrum]:
    for r in table.sort_by("place").to_pylist():
        s = Spectrum(len(r["mean"]))
        s.n, s.sums = r["n"], [int(x) for x in r["sums"]]
        s.mean, s.values = np.array(r["mean"]), np.array(r["eigenvalues"])
        s.vectors = np.array(r["eigenvectors"]).reshape(len(s.mean), -1)
        yield s


# ---------------------------------------------------------------------------
# Over partitions.
# ---------------------------------------------------------------------------
def combined(partials: DataFrame, merge: Callable[[pa.Table], pa.Table], path: str) -> DataFrame:
    """One row, or none: ``merge`` makes one of up to FAN rows, in the order of ``place``, again and again.

    Each level is written under ``path``: a lost executor costs the tasks of one level.
    """
    spark, schema = partials.sparkSession, partials.schema
    level = 0
    while True:
        at = f"{path}/{level}"
        partials.write.parquet(at)
        partials = spark.read.schema(schema).parquet(at)
        if partials.count() <= 1:
            return partials
        ranked = partials.withColumn("__group", F.floor(F.col("place") / FAN).cast("long"))

        def run(key, table):
            out = merge(table.drop_columns(["__group"]))
            return out.set_column(0, "place", pa.array([key[0].as_py()], pa.int64()))

        partials = ranked.groupBy("__group").applyInArrow(run, schema)
        level += 1


def _matrix(values: pa.Array, size: int) -> np.ndarray:
    """Quantised vectors, a row each."""
    x = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    return np.floor(SCALE * x).astype(np.int64) + SHIFT


def vectors_of(table: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(id, v) of the rows that take part, and the vectors' length; see ``whiten``."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) >= F.lit(float(LIMIT // SCALE))))
    rows = table.select(F.col(id_col).alias("id"), v.alias("v")).where(F.col("v").isNotNull() & (F.size("v") > 0) & ~bad)
    common = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    size = common["size"] if common else 0
    return rows.where(F.size("v") == size), size


def fit(rows: DataFrame, size: int) -> Spectrum | None:
    """The spectrum of all rows: every partition's by rank-one changes, combined by a tree."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, place = Spectrum(size), None
        for b in batches:
            place = b.column(0)[0].as_py() if b.num_rows else place
            x = _matrix(b.column(1), size)
            most = int(np.abs(x).max(initial=0))
            exact = x if most * len(x) < LIMIT else x.astype(object)
            s.sums = [a + int(t) for a, t in zip(s.sums, exact.sum(0))]
            distinct, times = np.unique(x, axis=0, return_counts=True)  # copies at once
            for vector, n in zip((distinct - SHIFT).astype(np.float64), times.tolist()):
                s.add(vector, n)
        if place is not None and s.n:
            yield from _spectrum_row(place, s).to_batches()

    def merge(table: pa.Table) -> pa.Table:
        first, *rest = _spectra(table)
        for s in rest:
            first.join(s)
        return _spectrum_row(0, first)

    spark = rows.sparkSession
    parts = rows.select(F.spark_partition_id().cast("long").alias("place"), "v").mapInArrow(run, SPECTRUM)
    found = combined(parts, merge, shared_path(spark, "whitening", unique=True)).toArrow()
    return next(_spectra(found)) if len(found) else None


class Centre:
    """n * x - S of quantised vectors, exactly, from a whole number near the mean."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.near = [s // n for s in sums]
        self.rest = [s - n * a for s, a in zip(sums, self.near)]  # 0 to n - 1

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """int64 where they fit, else Python integers."""
        x = x - np.array(self.near, dtype=np.int64)
        if (int(np.abs(x).max(initial=0)) + 1) * self.n < LIMIT:
            return x * np.int64(self.n) - np.array(self.rest, dtype=np.int64)
        return x.astype(object) * self.n - np.array(self.rest, dtype=object)

    def deviation(self, scaled: np.ndarray) -> list[int | None]:
        """Sum of squares of each row; None where it needs more than 64 bits."""
        if scaled.dtype != object and int(np.abs(scaled).max(initial=0)) ** 2 * max(1, scaled.shape[1]) < LIMIT:
            return (scaled * scaled).sum(1).tolist()
        return [t if t < 1 << 63 else None for t in (sum(int(a) ** 2 for a in row) for row in scaled)]

    def floats(self, scaled: np.ndarray) -> np.ndarray:
        return scaled.astype(np.float64) / self.n


MOMENTS = "place long, n long, sums array<double>, products array<double>"


def moments(rows: DataFrame, size: int, values: Callable[[pa.RecordBatch], np.ndarray], width: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, sums, sums of products) of what ``values`` makes of each batch, ``width`` numbers a row."""
    def row(place: int, n: int, sums: np.ndarray, products: np.ndarray) -> pa.Table:
        return pa.table({"place": pa.array([place], pa.int64()), "n": pa.array([n], pa.int64()),
                         "sums": pa.array([sums], pa.list_(pa.float64())), "products": pa.array([products.ravel()], pa.list_(pa.float64()))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products, place = 0, np.zeros(width), np.zeros((width, width)), None
        for b in batches:
            place = b.column(0)[0].as_py() if b.num_rows else place
            y = values(b)
            n, sums, products = n + len(y), sums + y.sum(0), products + y.T @ y
        if n:
            yield from row(place, n, sums, products).to_batches()

    def merge(table: pa.Table) -> pa.Table:
        rows_ = table.sort_by("place").to_pylist()
        return row(0, sum(r["n"] for r in rows_), np.sum([r["sums"] for r in rows_], axis=0), np.sum([r["products"] for r in rows_], axis=0))

    parts = rows.select(F.spark_partition_id().cast("long").alias("place"), "v").mapInArrow(run, MOMENTS)
    r = combined(parts, merge, shared_path(rows.sparkSession, "whitening", unique=True)).first()
    return r["n"], np.array(r["sums"]), np.array(r["products"]).reshape(width, width)


def refine(rows: DataFrame, size: int, s: Spectrum) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as columns) of the covariance, by falling value, from a Rayleigh-Ritz step in the spectrum's basis.

    Each vector's entry of greatest size is positive.
    """
    centre = Centre(s.n, s.sums)
    basis, _ = np.linalg.qr(s.vectors)
    n, sums, products = moments(rows, size, lambda b: centre.floats(centre.scaled(_matrix(b.column(1), size))) @ basis, size)
    mean = sums / n
    values, turn = np.linalg.eigh(products / n - np.outer(mean, mean))
    vectors = basis @ turn
    values, vectors = values[::-1], vectors[:, ::-1]
    lead = vectors[np.abs(vectors).argmax(0), np.arange(size)]
    return values, vectors * np.where(lead < 0, -1.0, 1.0)


def whiten(spark: SparkSession, table: DataFrame, components: int = 32, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """(id, n, deviation, whitened, explained, identity_error): a row for each vector that takes part.

    An entry c becomes x = floor(64 * c) + 1000000. ``whitened`` has the components of x - S / n along the unit eigenvectors of
    the covariance (divisor n), by falling eigenvalue e, each over sqrt(e), up to ``components`` of them; ``explained`` has e
    over the trace; ``deviation`` is the sum of (n * x - S)**2, null if it exceeds 64 bits; ``identity_error`` is the largest absolute
    entry of the whitened values' covariance minus the identity. A component without variance (e not above rounding)
    is null in ``whitened`` and left out of that error; without any variance ``explained`` is null too.

    Rows whose vector is null, empty, holds a null or non-finite entry or one beyond 64 bits, or has another
    length than most (of two equally frequent lengths the lesser counts) take no part. Rows with a null id and repeated rows
    do. Without any vector there are no rows. Other columns may have any names and are left out. The method
    keeps a square matrix of the vectors' length a task and takes time by the cube of the length for each distinct vector of a
    batch; vectors of some hundred entries are what it is for.
    """
    rows, size = vectors_of(table, id_col, vector_col)
    rows = rows.select(F.spark_partition_id().cast("long").alias("place"), "v", "id")
    width = min(components, size)
    fields = [T.StructField(id_col, rows.schema["id"].dataType), T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
              T.StructField("whitened", T.ArrayType(T.DoubleType())), T.StructField("explained", T.ArrayType(T.DoubleType())),
              T.StructField("identity_error", T.DoubleType())]
    schema = T.StructType(fields)
    spectrum = fit(rows, size) if size else None
    if spectrum is None:
        return spark.createDataFrame([], schema)
    values, vectors = refine(rows, size, spectrum)
    values = np.maximum(values, 0)
    total = float(values.sum())
    some = values[:width] > size * EPS * values[0]
    centre = Centre(spectrum.n, spectrum.sums)
    turn = np.where(some, vectors[:, :width] / np.sqrt(np.where(some, values[:width], 1)), 0.0)

    def white(scaled: np.ndarray) -> np.ndarray:
        return centre.floats(scaled) @ turn

    n, sums, products = moments(rows, size, lambda b: white(centre.scaled(_matrix(b.column(1), size))), width)
    mean = sums / n
    off = (products / n - np.outer(mean, mean) - np.eye(width))[np.ix_(some, some)]
    error = float(np.abs(off).max(initial=0.0))
    explained = [float(e) / total if total else None for e in values[:width]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k = b.num_rows
            scaled = centre.scaled(_matrix(b.column(1), size))
            w = pa.array(white(scaled).ravel(), pa.float64(), mask=np.tile(~some, k))
            yield pa.RecordBatch.from_arrays(
                [b.column(2), pa.array([centre.n] * k, pa.int64()), pa.array(centre.deviation(scaled), pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.arange(k + 1) * width, pa.int32()), w),
                 pa.array([explained] * k, pa.list_(pa.float64())), pa.array([error] * k, pa.float64())], names=schema.names)

    return rows.mapInArrow(run, schema)
