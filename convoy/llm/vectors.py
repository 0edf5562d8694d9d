"""Vectors of a table as arrays of whole numbers."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Whether a vector is there, not empty, and without null or non-finite entries."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~bad, F.lit(False))


def whole(vector: Column, scale: int, shift: int = 0) -> Column:
    """floor(scale * entry) + shift of every entry, as long. Products beyond 2^53 count as 2^53."""
    most = float(2**53)

    def one(c: Column) -> Column:
        scaled = F.greatest(F.least(F.lit(float(scale)) * c.cast("double"), F.lit(most)), F.lit(-most))
        return F.floor(scaled).cast("long") + F.lit(shift)

    return F.transform(vector, one)


def usual_length(rows: DataFrame, column: str) -> DataFrame:
    """The rows whose vector has the most frequent length (the greater of equally frequent ones)."""
    lengths = rows.groupBy(F.size(column).alias("length")).count()
    best = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    return rows.filter(F.size(column) == (best["length"] if best else 0))


def sums(rows: DataFrame, column: str) -> list[tuple[int, int, int, int, float]]:
    """Per dimension of equally long vectors: rows, exact sum, least, greatest, sum of squares.

    Each task adds up its rows and sends one row per dimension.
    """

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, found = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(0), len(batch.column(0)[0]))
            high, low = (x >> 26).sum(axis=0), (x & (2**26 - 1)).sum(axis=0)  # neither half can overflow
            new = [high, low, x.min(axis=0), x.max(axis=0), (x.astype(float) ** 2).sum(axis=0)]
            merge = (np.add, np.add, np.minimum, np.maximum, np.add)
            found = new if found is None else [f(a, b) for f, a, b in zip(merge, found, new)]
            n += len(x)
        if found is not None:
            columns = [np.arange(len(found[0])), np.full(len(found[0]), n), *found]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["i", "n", "high", "low", "least", "most", "squares"])

    schema = "i long, n long, high long, low long, least long, most long, squares double"
    parts = rows.select(column).mapInArrow(part, schema).groupBy("i")
    whole_sum = F.sum(F.col("high").cast("decimal(38,0)")) * 2**26 + F.sum(F.col("low").cast("decimal(38,0)"))
    found = parts.agg(F.sum("n"), whole_sum, F.min("least"), F.max("most"), F.sum("squares")).orderBy("i").collect()
    return [(r[1], int(r[2]), r[3], r[4], r[5]) for r in found]


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column whose lists all have ``width`` entries."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
