"""Keep the newest row of every key."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: list[str], newest: list[str]) -> DataFrame:
    """One whole row per key: the greatest by ``newest``, an unknown value counting as newest.

    Rows that tie are told apart by their other columns, so the answer never depends on
    the order of the input. Written as ``max(struct)`` rather than ``row_number``: the maximum
    is combined on the map side, so a key with very many copies sends one row per map task
    to its reducer instead of all of them.
    """
    rest = [c for c in df.columns if c not in keys and c not in newest]
    parts = []
    for name in newest:
        parts += [F.col(name).isNull().alias(f"{name}_unknown"), F.col(name)]
    newest_row = F.max(F.struct(*parts, *rest)).alias("newest_row")
    return (
        df.groupBy(*keys)
        .agg(newest_row)
        .select(*[F.col(c) if c in keys else F.col(f"newest_row.{c}").alias(c) for c in df.columns])
    )
