"""As-of join: the latest right row at or before each left row."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Pieces of time, coarse to fine, in which rows of a key meet.
SEGMENTS = ("HOUR", "MINUTE")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    values: list[str],
    segments: tuple[str, ...] = SEGMENTS,
) -> DataFrame:
    """Left outer as-of join on ``key``: adds ``values`` of the right row with the greatest
    ``right_time <= left_time``; the greatest values win among right rows of the same instant.

    The question is answered once per distinct (key, instant), on narrow rows: distinct instants and the
    greatest match per instant are combined on the map side, a window carries matches forward inside the
    finest of ``segments`` only, and what earlier segments leave behind takes one row per segment
    and level. The rows pick up the answer by an equality join, which adaptive execution splits when one
    instant is hot. Rows without key or time match nothing and are not shuffled.
    There is one plan for all sizes.
    """
    match = F.struct(*values).alias("_match")
    matches = right.select(F.col(key).alias("_key"), F.col(right_time).alias("_time"), match)
    matches = matches.filter("_key is not null and _time is not null")
    matches = matches.groupBy("_key", "_time").agg(F.max("_match").alias("_match"))
    rows = left.withColumns({"_key": F.col(key), "_time": F.col(left_time)})
    placed = F.col("_key").isNotNull() & F.col("_time").isNotNull()
    instants = rows.filter(placed).select("_key", "_time").distinct()
    answers = _carry_forward(instants, matches, segments)
    found = rows.filter(placed).join(answers, ["_key", "_time"], "left")
    chosen = [F.col(f"_match.{v}").alias(v) for v in values]
    unplaced = rows.filter(~placed).withColumn("_match", F.lit(None).cast(answers.schema["_match"].dataType))
    columns = [*left.columns, *chosen]
    return found.select(*columns).unionByName(unplaced.select(*columns))


def _carry_forward(instants: DataFrame, matches: DataFrame, segments: tuple[str, ...]) -> DataFrame:
    """``instants`` with the ``_match`` of the latest match of their ``_key`` up to their ``_time``."""
    cuts = {f"_segment{i}": F.date_trunc(unit, "_time") for i, unit in enumerate(segments)}
    instants, matches = instants.withColumns(cuts), matches.withColumns(cuts)
    names = ["_key", *cuts]
    both = instants.withColumn("_is_row", F.lit(True)).unionByName(
        matches.withColumn("_is_row", F.lit(False)), allowMissingColumns=True
    )
    so_far = (
        Window.partitionBy(*names)
        .orderBy("_time", "_is_row")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    answers = both.withColumn("_match", F.last("_match", ignorenulls=True).over(so_far)).filter("_is_row")
    for level in range(len(names), 1, -1):
        before = _last_before(instants, matches, names[:level])
        answers = answers.join(before, names[:level], "left").withColumn(
            "_match", F.coalesce("_match", "_inherited")
        )
        answers = answers.drop("_inherited")
    return answers.select("_key", "_time", "_match")


def _last_before(instants: DataFrame, matches: DataFrame, segment: list[str]) -> DataFrame:
    """``_inherited``: the latest match before each segment inside the next coarser one (the key, at
    last); one row per segment."""
    ends = matches.groupBy(*segment).agg(F.max(F.struct("_time", "_match")).alias("_end"))
    asked = instants.select(*segment).distinct()
    before = (
        Window.partitionBy(*segment[:-1])
        .orderBy(segment[-1])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return asked.join(ends, segment, "full").select(
        *segment, F.last("_end._match", ignorenulls=True).over(before).alias("_inherited")
    )
