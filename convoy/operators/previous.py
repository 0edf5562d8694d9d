"""Previous row of the same key, without sorting a whole key in one task."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_previous(
    df: DataFrame,
    keys: list[str],
    order_by: list[str],
    values: list[str],
    segments: list[Column],
    distinct: bool = False,
) -> DataFrame:
    """Add ``prev_<value>``: what ``lag(value)`` over the keys, nulls first, gives.

    ``segments`` cut the order of a key into consecutive pieces, from coarse to fine (hour, then
    minute). Rows meet by key and finest piece; only the first and the last row of every piece go on
    to the next coarser one, where the first rows find their predecessors among the last ones,
    and at most two rows per coarsest piece meet per key. There is one plan for all sizes.

    Identical rows are folded into one before anything is shuffled and given back afterwards, so a
    key, hour or instant that is full of copies is no larger than its different rows. ``distinct``
    tells that ``df`` has no identical rows and saves that step.
    """
    cuts = {f"_segment{i}": cut for i, cut in enumerate(segments)}
    groups = [[*keys, *list(cuts)[:n]] for n in range(len(cuts), -1, -1)]
    columns = [*df.columns, *_previous(values)]
    if distinct:
        return _linked(df.withColumns(cuts), groups, order_by, values).select(*columns)
    folded = df.groupBy(*df.columns).agg(F.count("*").alias("_copies")).withColumns(cuts)
    return _unfold(_linked(folded, groups, order_by, values), values).select(*columns)


def _previous(values: list[str]) -> list[str]:
    return [f"prev_{v}" for v in values]


def _scan(rows: DataFrame, group: list[str], order_by: list[str], values: list[str]) -> DataFrame:
    """``lag`` inside each group, and whether a row is the first or the last of its group.

    Of rows equal in ``order_by`` those still without a predecessor come first.
    """
    order = [F.col(c).asc_nulls_first() for c in order_by] + [F.col("_open").desc()]
    inside = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumns(
        {
            **{f"prev_{v}": F.lag(v).over(inside) for v in values},
            "_first": F.lag(F.lit(True)).over(inside).isNull(),
            "_last": F.lead(F.lit(True)).over(inside).isNull(),
        }
    )


def _linked(
    rows: DataFrame, groups: list[list[str]], order_by: list[str], values: list[str]
) -> DataFrame:
    """``lag`` over the widest of ``groups``, found level by level from the narrowest.

    Both uses of the scanned rows of a level read the same shuffle files.
    """
    rows = rows.withColumn("_open", F.lit(True))
    done = []
    for group in groups[:-1]:
        scanned = _scan(rows, group, order_by, values)
        done.append(scanned.filter("_open and not _first").drop("_open", "_first", "_last"))
        edges = scanned.filter("_first or _last").withColumn("_open", F.col("_open") & F.col("_first"))
        rows = edges.drop("_first", "_last", *_previous(values))
    found = _scan(rows, groups[-1], order_by, values).filter("_open").drop("_open", "_first", "_last")
    for part in done:
        found = found.unionByName(part)
    return found


def _unfold(rows: DataFrame, values: list[str]) -> DataFrame:
    """Give folded copies back: the first has the predecessor found, the others follow each other.

    Copies leave in portions that are spread over the tasks before they are written out.
    """
    portion = 100_000
    folded = rows.filter("_copies > 1").withColumns({f"prev_{v}": F.col(v) for v in values})
    portions = folded.withColumn(
        "_portion", F.explode(F.sequence(F.lit(0), F.ceil((F.col("_copies") - 1) / portion) - 1))
    ).repartition(*folded.columns, "_portion")
    size = F.least(F.lit(portion), F.col("_copies") - 1 - F.col("_portion") * portion)
    copies = portions.withColumn("_copy", F.explode(F.sequence(F.lit(1), size)))
    return rows.unionByName(copies.drop("_portion", "_copy"))
