"""Whitening of embeddings by Chebyshev-filtered subspace iteration (operator 12).

The leading eigenvectors of the covariance come from products V Q alone: each is
one distributed pass that sums Xc'(Xc Q) over the centred rows, so neither the
covariance nor the vectors leave the executors. A Chebyshev recurrence over such
products damps the unwanted part of the spectrum, QR and Rayleigh-Ritz turn the
block into eigenpairs, and this repeats until the residuals certify them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.staging import Staging

SCALE = 256
COMPONENTS = 4
# Columns of the iterated block: the wanted ones and what separates them.
BLOCK = 24
DEGREE = 10
# Residual over the largest eigenvalue: reached, or acceptable once rounding
# keeps it from falling further.
CERTIFIED = 1e-13
STALLED = 1e-10
MOST_ROUNDS = 200
# Directions with less of the largest variance are none.
LEAST_VARIANCE = 1e-12


def scaled(vector: Column) -> Column:
    """floor(256 c) of each entry; null for a null vector or one with a null or
    non-finite entry."""
    finite = F.forall(
        vector, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False))
    )
    return F.when(finite, F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE)))


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


class Fit:
    """The distinct scaled vectors, their number and sums, and products with
    their covariance. ``rows`` is a staged table with the one column x."""

    def __init__(self, rows: DataFrame, width: int):
        self.rows, self.width = rows, width

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, total = 0, np.zeros(width, np.int64)
            for batch in batches:
                x = _matrix(batch, width)
                n += len(x)
                total += x.sum(axis=0)
            entries = np.arange(-1, width)
            yield pa.RecordBatch.from_arrays(
                [pa.array(entries), pa.array(np.concatenate([[n], total]))], names=["i", "s"]
            )

        found = self._summed(sums, "i BIGINT, s BIGINT", ["i"], F.col("s").cast("decimal(38,0)"))
        parts = {r["i"]: int(r["s"]) for r in found}
        self.n = parts.get(-1, 0)
        self.sums = [parts.get(i, 0) for i in range(width)]
        # Whole and fraction apart: each difference is rounded once.
        self.mean = np.array([s / self.n for s in self.sums]) if self.n else np.zeros(width)

    def _summed(self, partial: Callable, schema: str, keys: list[str], value: Column) -> list:
        """Sums of what each task adds up by itself, at most width x BLOCK rows."""
        tasks = self.rows.mapInArrow(partial, schema)
        return tasks.groupBy(*keys).agg(F.sum(value).alias("s")).collect()

    def product(self, q: np.ndarray) -> tuple[np.ndarray, float]:
        """V q and the trace of V, the covariance with divisor n."""
        width, mean, columns = self.width, self.mean, q.shape[1]

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, square = np.zeros((width, columns)), 0.0
            for batch in batches:
                x = _matrix(batch, width) - mean
                total += x.T @ (x @ q)
                square += float(np.einsum("ij,ij->", x, x))
            i, j = np.divmod(np.arange(width * columns), columns)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.append(i, -1)),
                    pa.array(np.append(j, -1)),
                    pa.array(np.append(total.ravel(), square)),
                ],
                names=["i", "j", "v"],
            )

        out, trace = np.zeros((width, columns)), 0.0
        schema = "i BIGINT, j BIGINT, v DOUBLE"
        for r in self._summed(partial, schema, ["i", "j"], F.col("v")):
            if r["i"] < 0:
                trace = r["s"] / self.n
            else:
                out[r["i"], r["j"]] = r["s"] / self.n
        return out, trace


def chebyshev(
    product: Callable[[np.ndarray], np.ndarray], q: np.ndarray, vq: np.ndarray, cut: float,
    top: float, degree: int,
) -> np.ndarray:
    """T(V) q for the Chebyshev polynomial of the interval from 0 to ``cut``,
    scaled to be 1 at ``top``. ``vq`` is V q."""
    half = centre = cut / 2
    first = sigma = half / (top - centre)
    before, now = q, (vq - centre * q) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        step = (product(now) - centre * now) * (2 * after / half)
        before, now, sigma = now, step - sigma * after * before, after
    return now


def leading_eigenpairs(
    product: Callable[[np.ndarray], np.ndarray], width: int, wanted: int, block: int = BLOCK,
    degree: int = DEGREE,
) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a positive semidefinite operator,
    falling, and their unit eigenvectors as columns. Starts from fixed random
    numbers. Raises if the residuals do not certify the pairs in MOST_ROUNDS."""
    size, wanted = min(width, max(block, wanted)), min(width, wanted)
    q, _ = np.linalg.qr(np.random.default_rng(width).standard_normal((width, size)))
    last = np.inf
    for _ in range(MOST_ROUNDS):
        vq = product(q)
        small = q.T @ vq
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        top = values[0]
        off = np.linalg.norm(vq[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0).max()
        # A block as wide as the space, and no variance at all, are exact.
        if size == width or top <= 0 or off <= CERTIFIED * top:
            return values[:wanted], q[:, :wanted]
        if off > last / 2 and off <= STALLED * top:
            return values[:wanted], q[:, :wanted]
        last = off
        cut = max(values[-1], LEAST_VARIANCE * top)
        if cut >= top:  # nothing in the block stands out; a power step widens it
            q = vq
        else:
            q = chebyshev(product, q, vq, cut, top, degree)
        q, _ = np.linalg.qr(q)
    raise RuntimeError(f"eigenpairs not certified: residual {off} of {top}")


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, list[int | None]]:
    """(n x - S) of each row and the exact sums of squares, None beyond a BIGINT."""
    reach = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if reach * reach * max(1, x.shape[1]) < 1 << 63:
        off = n * x - np.array(sums, np.int64)
        return off, (off * off).sum(axis=1).tolist()
    off = n * x.astype(object) - np.array(sums, object)
    squares = (off * off).sum(axis=1).tolist()
    return off, [s if s < 1 << 63 else None for s in squares]


def whiten(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
    staging: Staging | None = None,
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row
    per vector that stays and component.

    Vectors that are null, empty or hold null or non-finite entries go; so do
    those of another length than most of the distinct ones (of equally many, the
    longer). Repeated rows and null ids come back row by row, while each distinct
    vector counts once in the fit. There are fewer components where the variance
    has fewer dimensions, so none, and no rows, if all vectors are equal.
    ``deviation`` is null where it does not fit a BIGINT.
    """
    spark = vectors.sparkSession
    staging = staging or Staging(spark)
    rows = vectors.select(F.col(id_col).alias("id"), scaled(F.col(vector_col)).alias("x")).where(
        "size(x) > 0"
    )
    kind = vectors.select(F.col(id_col).alias("id")).schema["id"].dataType.simpleString()
    distinct = staging.save(rows.select("x").distinct(), "fit")
    width = (
        distinct.groupBy(F.size("x").alias("width"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.desc("width"))
        .first()
    )
    empty = spark.createDataFrame(
        [],
        f"id {kind}, component INT, n BIGINT, deviation BIGINT, whitened DOUBLE, "
        "explained DOUBLE, identity_error DOUBLE",
    )
    if width is None:
        return empty
    fit = Fit(distinct.where(F.size("x") == width["width"]), width["width"])
    values, axes = leading_eigenpairs(lambda q: fit.product(q)[0], fit.width, components)
    keep = values > LEAST_VARIANCE * max(values[0], 0)
    values, axes = values[keep], axes[:, keep]
    if not len(values):
        return empty
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(len(values))])
    weights = axes / np.sqrt(values)
    spread, trace = fit.product(weights)
    error = float(np.abs(weights.T @ spread - np.eye(len(values))).max())
    explained = F.array(*[F.lit(float(v / trace)) for v in values])
    n, sums = fit.n, fit.sums

    @F.pandas_udf("deviation BIGINT, whitened ARRAY<DOUBLE>")
    def project(parts: pd.Series) -> pd.DataFrame:
        if not len(parts):
            return pd.DataFrame({"deviation": pd.Series(dtype="Int64"), "whitened": []})
        off, squares = _deviation(np.stack(parts.to_list()).astype(np.int64), n, sums)
        placed = (off / n).astype(float) @ weights
        return pd.DataFrame(
            {"deviation": pd.array(squares, dtype="Int64"), "whitened": list(placed)}
        )

    return (
        rows.where(F.size("x") == fit.width)
        .select("id", project("x").alias("of"))
        .select("id", "of.deviation", F.posexplode("of.whitened").alias("place", "whitened"))
        .select(
            "id",
            (F.col("place") + 1).alias("component"),
            F.lit(n).cast("bigint").alias("n"),
            "deviation",
            "whitened",
            F.get(explained, F.col("place")).alias("explained"),
            F.lit(error).alias("identity_error"),
        )
    )
