"""Connected components of an edge table, by alternating large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm.tables import discard, stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of each node below the least of them (large: only greater neighbours;
    small: only lesser ones and the node itself). ``edges`` is a stored table; it is removed."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    # joined from a table, so that a node with very many neighbours can be split
    least = stored(least, "least")
    hung = both.join(least, "u").select("u", "v", "m")
    if large:
        hung = hung.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        hung = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    found = stored(hung.filter("u != v").distinct(), "stars")
    discard(least, edges)
    return found


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node hangs below one other, which hangs below none."""
    if not edges.groupBy("u").count().filter("count > 1").isEmpty():
        return False
    return edges.join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (u, v): the least node that can be reached."""
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = stored(edges.filter("u != v").distinct(), "edges")
    while not _are_stars(edges):
        edges = _stars(_stars(edges, True), False)
    pairs = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.unionByName(roots)


def merged_once(edges: DataFrame) -> DataFrame:
    """(node, component) after two steps of taking the least neighbour: nodes of one ``component`` are connected, but
    connected nodes may still differ. Two shuffles and no loop, for callers that only want less work later."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    first = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    # what a node hears is the least that a neighbour, or itself, has heard
    heard = both.join(first, "u").select(F.col("v").alias("node"), "m")
    own = first.select(F.col("u").alias("node"), "m")
    return heard.unionByName(own).groupBy("node").agg(F.min("m").alias("component"))
