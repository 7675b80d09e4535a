"""Whitening of embeddings by a spectral divide-and-conquer eigendecomposition.

Sums and the centred scatter matrix come from one Arrow pass each, in which every task sends one fixed-size row. The
covariance, whose size depends on the dimension alone, is decomposed on the driver: the unitary polar factor U of a
shifted covariance, found by QR-based dynamically weighted Halley iterations, gives the projector (U + I) / 2 on the
eigenvectors above the shift; the two invariant subspaces are split further until single components are left. The
projection, a small matrix, is sent to the workers, which whiten row by row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from roadbook.llm.frames import empty, written

#: Entry c becomes floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 1024, 100_000
#: Components whose eigenvalue is below this share of the greatest have no variance to be scaled to one.
FLAT = 1e-12
#: Entries beyond this cannot be told from their neighbours as scaled integers any more.
LARGEST = float(1 << 40)
_COLUMNS = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
_EPS = np.finfo(float).eps


# --- eigenvectors by polar decompositions ---------------------------------------------------------------------------

def polar(a: np.ndarray) -> np.ndarray:
    """The unitary polar factor of a symmetric matrix, by Halley iterations with weights from a bound on the spectrum."""
    n = len(a)
    x = a / max(np.linalg.norm(a), np.finfo(float).tiny)
    # a lower bound of the least singular value: 1 / |X^-1| by norms, or the rounding level where X is as good as singular
    r = np.abs(np.diag(np.linalg.qr(x, mode="r")))
    low = min(max(r.min() / np.sqrt(n), _EPS), 1.0)
    for _ in range(60):
        square = low * low
        d = np.cbrt(4 * (1 - square) / square**2)
        a_k = np.sqrt(1 + d) + np.sqrt(max(8 - 4 * d + 8 * (2 - square) / (square * np.sqrt(1 + d)), 0.0)) / 2
        b_k = (a_k - 1) ** 2 / 4
        c_k = a_k + b_k - 1
        q, _ = np.linalg.qr(np.concatenate([np.sqrt(c_k) * x, np.eye(n)]))
        following = (b_k / c_k) * x + (a_k - b_k / c_k) / np.sqrt(c_k) * (q[:n] @ q[n:].T)
        moved = np.linalg.norm(following - x)
        x = following
        low = min(low * (a_k + b_k * square) / (1 + c_k * square), 1.0)
        if abs(1 - low) <= 10 * _EPS and moved <= np.cbrt(10 * _EPS):
            break
    return (x + x.T) / 2


def split(a: np.ndarray) -> tuple[np.ndarray, int] | None:
    """An orthogonal basis whose first k columns span an invariant subspace, and k; None for a multiple of the identity.

    Shifts: the median of the diagonal, which halves well, then the mean eigenvalue and places around it, which lie
    inside the spectrum. The most accurate split of those that divide is taken as soon as it is at rounding level.
    """
    n, norm = len(a), np.linalg.norm(a)
    centre = np.trace(a) / n
    spread = np.linalg.norm(a - centre * np.eye(n)) / np.sqrt(n)
    if spread <= n * _EPS * norm:
        return None
    best: tuple[float, np.ndarray, int] | None = None
    start = np.random.default_rng(n).standard_normal((n, n))
    for shift in [float(np.median(np.diag(a))), *[centre + f * spread for f in (0, 0.1, -0.1, 0.3, -0.3, 0.7, -0.7, 0.01)]]:
        upper = (polar(a - shift * np.eye(n)) + np.eye(n)) / 2
        k = round(float(np.trace(upper)))
        if not 0 < k < n:
            continue
        basis = start
        for _ in range(3):  # subspace iterations; the projector has eigenvalues one and zero only
            first, _ = np.linalg.qr(upper @ basis[:, :k])
            basis, _ = np.linalg.qr(np.concatenate([first, start[:, k:]], axis=1))
        off = np.linalg.norm(basis[:, k:].T @ a @ basis[:, :k]) / norm
        if best is None or off < best[0]:
            best = (off, basis, k)
        if best[0] <= 10 * n * _EPS:
            break
    return best and best[1:]


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order, and unit eigenvectors as columns, of a symmetric matrix."""
    a = (a + a.T) / 2
    n = len(a)
    found = split(a) if n > 1 else None
    if found is None:
        values, vectors = np.diag(a).copy(), np.eye(n)
    else:
        basis, k = found
        sides = [(basis[:, :k], *eigen(basis[:, :k].T @ a @ basis[:, :k])), (basis[:, k:], *eigen(basis[:, k:].T @ a @ basis[:, k:]))]
        vectors = np.concatenate([side @ inner for side, _, inner in sides], axis=1)
        values = np.concatenate([inner for _, inner, _ in sides])
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


# --- passes over the vectors ----------------------------------------------------------------------------------------

def usable(df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``id`` and ``x``, the scaled integers, of the rows whose vector is there and has finite entries only."""
    entries = F.col(f"`{vector_column}`").cast("array<double>")
    finite = F.forall(entries, lambda v: F.coalesce((F.abs(v) < float("inf")) & ~F.isnan(v), F.lit(False)))
    wide = F.exists(entries, lambda v: F.abs(v) > LARGEST)
    # an entry that is too large to scale stops the job instead of giving a wrong sum
    scaled = F.transform(entries, lambda v: F.floor(v * SCALE).cast("long") + OFFSET)
    checked = F.when(wide, F.raise_error(F.lit("an entry of a vector is beyond 2^40")).cast("array<bigint>")).otherwise(scaled)
    return df.where(entries.isNotNull() & finite).select(F.col(f"`{id_column}`").alias("id"), checked.alias("x"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The vectors of a batch as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _summed(vectors: DataFrame, cells: int, kind: str, add: Callable[[np.ndarray], np.ndarray], dims: int) -> np.ndarray:
    """Sum over all vectors of what ``add`` gives for a block of them: one row a task, added up place by place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.int64 if kind == "bigint" else np.float64)
        for batch in batches:
            total += add(_matrix(batch.column(0), dims))
        offsets = pa.array([0, cells], pa.int32())
        yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, pa.array(total))], names=["cells"])

    parts = vectors.select("x").mapInArrow(run, f"cells array<{kind}>")
    rows = parts.select(F.posexplode("cells").alias("cell", "v")).groupBy("cell").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(cells, np.int64 if kind == "bigint" else np.float64)
    for row in rows:  # as many as cells, whatever the number of vectors
        out[row["cell"]] = row["v"]
    return out


@dataclass(frozen=True)
class Whitener:
    """What is known of all vectors: their number, sums by dimension, and the projection to whitened components."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray  # one column each, unit length
    values: np.ndarray
    trace: float

    def apply(self, vectors: DataFrame) -> DataFrame:
        """``id``, ``whitened`` (one entry per component) and ``parts``, from which the deviation is put together."""
        n, sums, mean = self.n, np.array(self.sums, np.int64), np.array(self.sums) / max(self.n, 1)
        projection, dims = self.components / np.sqrt(self.values), len(self.sums)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _matrix(batch.column(1), dims)
                white = (x - mean) @ projection
                moved = n * x - sums
                high, low = moved >> 26, moved & ((1 << 26) - 1)
                parts = [(high * high).sum(1), (high * low).sum(1), (low * low).sum(1)]
                offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * white.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(white.ravel())), *map(pa.array, parts)],
                    names=["id", "whitened", "high", "mixed", "low"],
                )

        kind = vectors.schema["id"].dataType.simpleString()
        rows = vectors.select("id", "x").mapInArrow(run, f"id {kind}, whitened array<double>, high long, mixed long, low long")
        deviation = F.expr(
            f"cast(high AS decimal(20,0)) * {1 << 52} + cast(mixed AS decimal(20,0)) * {1 << 27} + low"
        ).cast("decimal(38,0)")
        return rows.select("id", "whitened", deviation.alias("deviation"))


def fit(vectors: DataFrame, top: int = 8) -> Whitener:
    """Mean, covariance and the ``top`` components of all vectors (``x`` of :func:`usable`), of one length.

    Components without variance are left out. No vector at all gives no component.
    """
    shape = vectors.agg(F.count(F.lit(1)).alias("n"), F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("most")).first()
    if shape["n"] and shape["least"] != shape["most"]:
        raise ValueError(f"vectors have {shape['least']} to {shape['most']} entries; they have to be of one length")
    n, dims = shape["n"], shape["most"] or 0
    if not n or not dims:
        return Whitener(n, (0,) * dims, np.zeros((dims, 0)), np.zeros(0), 0.0)
    sums = _summed(vectors, dims, "bigint", lambda x: x.sum(axis=0), dims)
    mean = sums / n

    def scatter(x: np.ndarray) -> np.ndarray:
        centred = x - mean
        return (centred.T @ centred).ravel()

    covariance = _summed(vectors, dims * dims, "double", scatter, dims).reshape(dims, dims) / n
    values, components = eigen(covariance)
    kept = np.flatnonzero(values[:top] > FLAT * max(values[0], 0)) if values[0] > 0 else np.zeros(0, int)
    return Whitener(n, tuple(int(s) for s in sums), components[:, kept], values[kept], float(np.trace(covariance)))


def identity_error(rows: DataFrame, count: int) -> float:
    """Largest absolute entry of the covariance of ``whitened``, less the identity.

    The means are taken in a pass of their own, so that the products are of centred values.
    """
    means = rows.agg(*[F.avg(F.col("whitened")[i]).alias(f"m{i}") for i in range(count)]).first()
    centred = [F.col("whitened")[i] - F.lit(means[i]) for i in range(count)]
    pairs = [(i, j) for i in range(count) for j in range(i + 1)]
    products = rows.agg(*[F.avg(centred[i] * centred[j]).alias(f"p{i}_{j}") for i, j in pairs]).first()
    return max(abs(p - (i == j)) for p, (i, j) in zip(products, pairs, strict=True))


def whiten(df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", top: int = 8) -> DataFrame:
    """One row per usable vector and component: ``id``, ``component`` from 1, ``n``, ``deviation``, ``whitened``,
    ``explained``, ``identity_error``.

    Vectors that are null or hold a null or a non-finite entry are left out; repeated rows count each. All others have
    to be of one length, and no entry may lie beyond 2^40. ``deviation`` is exact, as decimal. Equal eigenvalues leave
    open which vectors of their space are the components; components without variance are not given, so vectors that
    are all equal, a single vector or no vector give no rows. Null ids are kept; other columns do not matter.
    """
    vectors = usable(df, id_column, vector_column)
    model = fit(vectors, top)
    if not len(model.values):
        kind = vectors.schema["id"].dataType.simpleString()
        return empty(df.sparkSession, f"id {kind}, {_COLUMNS}")
    rows, _ = written(model.apply(vectors), "whitened")
    count = len(model.values)
    error = identity_error(rows, count)
    shares = F.array(*[F.lit(float(v / model.trace)) for v in model.values]).cast("array<double>")
    return rows.select("id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        shares[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"),
    )
