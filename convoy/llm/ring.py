"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Keys and virtual nodes lie on a ring of ``cells``. A key belongs to the first virtual node clockwise. A shard
takes its keys in ring order until it is full; the rest continues clockwise to the next virtual
node of a shard that has room. Capacities are one row apart and add up to the number of rows, so all
shards end equally full, and rows move only where a shard overflows.

Who goes where depends on the number of rows per cell only. Spark counts cells and ranks rows inside
their cells; the walk round the ring works on at most ``cells`` counts and gives at most
``cells * (shards + 1)`` intervals of ranks, which are broadcast.
"""

from bisect import bisect_left

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from convoy.llm.tables import stored

CELLS = 4096
VIRTUAL = 64


def virtual_nodes(shards: int, virtual: int = VIRTUAL, cells: int = CELLS) -> list[tuple[int, int]]:
    """(cell, shard) of the virtual nodes, clockwise. A node's place depends on its own number only."""
    mask, places = (1 << 64) - 1, {}
    for shard in range(shards):
        for k in range(virtual):
            x = (shard * 1_000_003 + k + 1) * 0x9E3779B97F4A7C15 & mask
            x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & mask
            x = (x ^ x >> 27) * 0x94D049BB133111EB & mask
            places.setdefault((x ^ x >> 31) % cells, shard)  # of two in one cell the lower shard stays
    return sorted(places.items())


def capacities(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def walk(counts: dict[int, int], shards: int, virtual: int = VIRTUAL, cells: int = CELLS) -> list[tuple]:
    """(cell, from, to, shard, slot of the first): which ranks of a cell go to which shard."""
    nodes = virtual_nodes(shards, virtual, cells)
    at = [c for c, _ in nodes]
    room = capacities(sum(counts.values()), shards)
    filled = [0] * shards
    waiting = [(bisect_left(at, c) % len(nodes), c, 0, n) for c, n in sorted(counts.items()) if n]
    found = []
    while waiting:
        later = []
        for node, cell, a, b in waiting:
            shard = nodes[node][1]
            taken = min(b - a, room[shard])
            if taken:
                found.append((cell, a, a + taken, shard, filled[shard]))
                room[shard] -= taken
                filled[shard] += taken
            if taken < b - a:
                # on to the next node whose shard has room
                step = next(i for i in range(1, len(nodes) + 1) if room[nodes[(node + i) % len(nodes)][1]])
                later.append(((node + step) % len(nodes), cell, a + taken, b))
        waiting = later
    return found


def balanced_shards(
    docs: DataFrame, shards: int = 8, id_column: str = "doc_id", text_column: str = "text", cells: int = CELLS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is ``rows``: shards differ by one row at most, whatever the ids and texts. ``size`` is the number
    of bytes plus one, null counting as none, ``text_crc32`` of a null text that of the empty one. ``slot`` counts the
    rows of a shard from 0 without gaps. Rows without an id are placed by their text; repeated
    rows are placed one after the other, and which is which is then of no account. ``grown_shard`` is null. An empty table
    gives an empty result; further columns are ignored.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    place = F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.struct("text_crc32", "size")))
    rows = rows.withColumn("cell", F.pmod(place, F.lit(cells)).cast("int")).withColumn("place", place)
    # rows that repeat id and text are counted before they meet, and spread again afterwards
    same = ["cell", "place", "doc_id", "size", "text_crc32"]
    kinds = stored(rows.groupBy(*same).agg(F.count(F.lit(1)).alias("copies")), "ring")
    counts = {r[0]: r[1] for r in kinds.groupBy("cell").agg(F.sum("copies")).collect()}  # cells rows at most
    plan = walk(counts, shards, cells=cells)
    spark = docs.sparkSession
    plan = spark.createDataFrame(plan, "cell int, a long, b long, shard int, first long")
    plan = plan.groupBy("cell").agg(F.collect_list(F.struct("a", "b", "shard", "first")).alias("plan"))
    order = Window.partitionBy("cell").orderBy("place", "doc_id", "text_crc32", "size")
    before = F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, -1))
    ranked = kinds.withColumn("before", F.coalesce(before, F.lit(0)))
    ranked = ranked.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    ranked = ranked.withColumn("rank", F.col("before") + F.col("copy") - 1)
    placed = ranked.join(F.broadcast(plan), "cell")  # a row per cell
    own = F.filter("plan", lambda p: (p["a"] <= F.col("rank")) & (F.col("rank") < p["b"]))[0]
    placed = placed.withColumn("own", own)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("own.shard").alias("shard"),
        (F.col("own.first") + F.col("rank") - F.col("own.a")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
