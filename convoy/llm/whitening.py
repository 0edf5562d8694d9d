"""Whitening of embeddings by shifted CholeskyQR.

The rows to fit on are the distinct vectors. Every pass adds up the Gram matrix of the centred rows after the
triangular solves of the passes before; its Cholesky factor is the next solve. The first factor is taken of a
shifted matrix, so that it exists however ill-conditioned the rows are. The product of the factors is R of a QR
decomposition, and the singular value decomposition of R gives the components.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm.tables import stored
from convoy.llm.vectors import finite, matrix, usual_length, whole
from convoy.llm.vectors import sums as sums_of

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
#: Gram passes at most; the third one usually finds orthonormal rows already.
PASSES = 6
#: Partial sums are merged in this many tasks before they reach the driver.
MERGERS = 16
_UNIT = np.finfo(float).eps / 2


def added_up(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray], width: int, size: int) -> np.ndarray:
    """Sum of ``part`` (``size`` numbers) over blocks of the rows of column ``x``.

    A task sends one partial sum, MERGERS tasks add those up; the driver gets as many arrays, whatever the
    number of rows.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += part(matrix(batch.column(0), width))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for value in batch.column(0):
                total += np.frombuffer(value.as_py(), float)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

    parts = rows.select("x").mapInArrow(partial, "total binary")
    parts = parts.repartition(MERGERS, F.xxhash64("total")).mapInArrow(merge, "total binary")
    found = sorted(bytes(r[0]) for r in parts.collect())
    return np.sum([np.frombuffer(r, float) for r in found], axis=0) if found else np.zeros(size)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n. Whole numbers are subtracted first, so no digits are lost to their size."""
    mid = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s - n * int(m)) / n for s, m in zip(sums, mid)])
    return (x - mid).astype(float) - rest


def _solve(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """Rows times the inverse of each upper triangular factor in turn, column by column."""
    for r in factors:
        out = np.empty_like(rows)
        for j in range(r.shape[0]):
            out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
        rows = out
    return rows


def components(fit: DataFrame, n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (as columns) of the covariance of column ``x``.

    Directions in which the rows do not vary make a Gram matrix singular; there its symmetric root takes the
    place of the Cholesky factor in the last pass, and such components are left out.
    """
    d = len(sums)
    factors: list[np.ndarray] = []
    whole_r, spread = np.eye(d), 0.0
    for i in range(PASSES):
        send = list(factors)
        gram = added_up(fit, lambda x: _gram(_solve(centred(x, n, sums), send)), d, d * d).reshape(d, d)
        gram = (gram + gram.T) / 2
        spread = spread or float(np.trace(gram))
        if spread == 0:
            return np.zeros(0), np.zeros((d, 0))
        if i and np.abs(gram - np.eye(d)).max() < 1e-13 * d:
            break
        shift = 11 * (n * d + d * (d + 1)) * _UNIT * np.linalg.norm(gram, 2) if i == 0 else 0.0
        try:
            r = np.linalg.cholesky(gram + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            break
        if r.diagonal().min() < 1e-7 * r.diagonal().max() and i:
            break
        factors.append(r)
        whole_r = r @ whole_r
    values, turned = np.linalg.eigh(gram)
    root = np.sqrt(np.maximum(values, 0))[:, None] * turned.T
    _, stretch, axes = np.linalg.svd(root @ whole_r)
    real = stretch > 1e-9 * stretch[0]
    axes = axes[real].T
    # one sign for all rows: the greatest entry of a component is positive
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])
    return stretch[real] ** 2 / n, axes


def _gram(q: np.ndarray) -> np.ndarray:
    return (q.T @ q).ravel()


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of (n*x - S)^2, exact; null where it does not fit a long."""
    s = np.array(sums, object)
    greatest = max(int(np.abs(x - np.array([v // n for v in sums], np.int64)).max(initial=0)) + 1, 1) * n
    if greatest * greatest * len(sums) < 2**63 and abs(x).max(initial=0) * n < 2**62:
        off = n * x - np.array(sums, np.int64)
        return (off * off).sum(axis=1).tolist()
    exact = [sum(v * v for v in (n * row.astype(object) - s)) for row in x]
    return [v if v < 2**63 else None for v in exact]


def whitened(rows: DataFrame, vector: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """One row per remaining row of ``rows`` and component: vec_id, component, n, deviation, whitened, explained,
    identity_error.

    Rows whose vector is null, empty, or has null or non-finite entries drop out, and so do vectors of another
    length than the most frequent one. Repeated rows are answered each and fitted once; vec_id may be null or repeat.
    Components without variance are left out, so a table of one distinct vector, or an empty one, gives no
    rows. Sums are whole numbers; entries beyond 2^53 / 64 count as that. Other columns of ``rows`` are not read.
    """
    rows = rows.select("vec_id", F.col(vector).alias("x")).filter(finite(F.col("x")))
    rows = rows.select("vec_id", whole(F.col("x"), SCALE, SHIFT).alias("x"))
    rows = usual_length(rows, "x")
    fit = stored(rows.select("x").distinct(), "whitening")
    totals = sums_of(fit, "x")
    out = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not totals:
        return rows.sparkSession.createDataFrame([], out)
    n, sums = totals[0][0], [t[1] for t in totals]
    values, axes = components(fit, n, sums)
    d, k = len(sums), min(most, len(values))
    if not k:
        return rows.sparkSession.createDataFrame([], out)
    # every component carries its share of all variance, not only of those returned
    explained = values[:k] / values.sum()
    scaled = axes[:, :k] / np.sqrt(values[:k])

    def white(x: np.ndarray) -> np.ndarray:
        return centred(x, n, sums) @ scaled

    moments = added_up(fit, lambda x: white(x).sum(axis=0), d, k) / n
    spread = added_up(fit, lambda x: _gram(white(x) - moments), d, k * k).reshape(k, k) / n
    error = float(np.abs(spread - np.eye(k)).max())

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                part = batch.slice(a, 4096)
                m = part.num_rows
                x = matrix(part.column(1), d)
                columns = [
                    part.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n)),
                    pa.array(_deviations(x, n, sums), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(white(x).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    return rows.select(F.col("vec_id").cast("long"), "x").mapInArrow(answer, out)
