"""Exact duplicates by deterministic block naming.

Every text is cut into blocks of a fixed number of bytes. All distinct blocks of the corpus
get integer names; adjacent names are paired, distinct pairs are named, and so on until each text has
one name. Blocks and pairs are sorted inside each partition only, so names are unique but follow the
partitioning, not one order of all blocks. Texts of one height with one name are equal, and only those.

Blocks travel to the place of naming once, after a map-side combine, so a group of copies sends one
block per map task. There each block is known by a 128-bit key; the naming job compares the bytes
of all blocks of a key, and another seed is taken if two blocks ever shared one. Names are thus
free of collisions although only keys are joined afterwards.

DataFrame functions only. One hot text makes hot join keys on the document side, which adaptive
execution splits; everything else is combined before it is shuffled.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy.llm.tables import lower_ascii, stored

BLOCK_BYTES = 4096


def _blocks(text: Column, size: int) -> Column:
    data = text.cast("binary")
    last = F.greatest((F.octet_length(text) + F.lit(size - 1)).cast("long"), F.lit(size)) / size
    return F.transform(
        F.sequence(F.lit(0), F.floor(last).cast("int") - 1),
        lambda i: F.substring(data, i * size + 1, F.lit(size)),
    )


def _key(block: Column, seed: int) -> Column:
    return F.struct(
        F.xxhash64(F.lit(2 * seed), block).alias("a"), F.xxhash64(F.lit(2 * seed + 1), block).alias("b")
    )


def _name_blocks(texts: DataFrame, size: int, seed: int) -> DataFrame:
    """(key, name, clash): names follow the order of the blocks' bytes inside a partition only."""
    blocks = texts.select(F.explode(_blocks(F.col("text"), size)).alias("block"))
    firsts = blocks.groupBy(_key(F.col("block"), seed).alias("key")).agg(
        F.min("block").alias("block"), F.max("block").alias("other")
    )
    named = firsts.sortWithinPartitions("block").select(
        "key",
        F.monotonically_increasing_id().alias("name"),
        (F.col("block") != F.col("other")).alias("clash"),
    )
    return stored(named, "block-names")


def _name_pairs(pairs: DataFrame) -> DataFrame:
    """(first, second, name): the distinct pairs, in order inside a partition only."""
    distinct = pairs.select("first", "second").distinct().sortWithinPartitions("first", "second")
    return stored(distinct.withColumn("name", F.monotonically_increasing_id()), "pair-names")


def identities(texts: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """The rows of ``texts`` without ``text`` but with a unique ``row``, and (row, height, name): two
    rows agree in height and name exactly if their texts are equal. ``text`` must not be null."""
    seed = 0
    names = _name_blocks(texts, block_bytes, seed)
    while not names.filter("clash").isEmpty():
        seed += 1
        names = _name_blocks(texts, block_bytes, seed)
    keys = F.transform(_blocks(F.col("text"), block_bytes), lambda b: _key(b, seed))
    rows = stored(
        texts.withColumns({"row": F.monotonically_increasing_id(), "keys": keys}).drop("text"), "rows"
    )
    keyed = rows.select("row", F.posexplode("keys").alias("at", "key"), F.size("keys").alias("n"))
    level = stored(keyed.join(names, "key").select("row", "at", "n", "name"), "names")
    ended = level.filter("n <= 1").select("row", F.lit(0).alias("height"), "name")
    level = level.filter("n > 1")
    for height in range(1, 64):
        if level.isEmpty():
            break
        even = F.col("at") % 2 == 0
        pairs = level.groupBy("row", F.floor(F.col("at") / 2).alias("at"), "n").agg(
            F.max(F.when(even, F.col("name"))).alias("first"),
            F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("second"),
        )
        pairs = stored(pairs, "pairs")
        # the last block of an odd row has no partner: -1 is no name
        level = stored(
            pairs.join(_name_pairs(pairs), ["first", "second"]).select("row", "at", "n", "name"), "names"
        )
        done = F.col("n") <= 2**height
        ended = ended.unionByName(
            level.filter(done).select("row", F.lit(height).alias("height"), "name")
        )
        level = level.filter(~done)
    return rows.drop("keys"), ended


def exact_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z only; null counts as empty. The row with
    the greatest id of a group stays. Repeated rows of one id count each in ``group_size`` and share
    the decision. Rows without an id lose to any id; a group without ids has ``keep_id`` null and all
    of it is kept. An empty table gives an empty result; further columns of ``docs`` are ignored.
    """
    text = lower_ascii(F.coalesce(F.col(text_column), F.lit("")))
    source = docs.select(F.col(id_column).alias("doc_id"), text.alias("text"))
    sha = F.sha2(F.col("text").cast("binary"), 256)
    rows, named = identities(source.withColumn("text_sha256", sha), block_bytes)
    found = rows.join(named, "row")
    groups = found.groupBy("height", "name").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    groups = stored(groups, "groups")  # so that the join below can split a hot group
    return found.join(groups, ["height", "name"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
