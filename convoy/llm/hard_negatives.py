"""Hard negatives of anchors among all vectors, exact, over blocks in the order of a Hilbert curve.

The rows of each label are put in the order of a Hilbert curve over their most varied dimensions and written as
Parquet blocks, one folder each. A zone map keeps the least and greatest entry per dimension of a block; interval
arithmetic turns it into bounds of an anchor's scores in the block. A block is read only if, for some
anchor, its bounds meet a window that can still change the answer. Scores are whole numbers, compared exactly.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convoy.llm.hilbert import hilbert_key
from convoy.llm.tables import stored
from convoy.llm.vectors import finite, matrix, sums, usual_length, whole
from convoy.session import work_folder

SCALE = 256
BLOCK_ROWS = 4096
#: The curve runs over this many dimensions with so many bits each.
AXES, BITS = 8, 7
#: Anchors that are sent to the tasks at once (at most one more block's), and blocks they are held against.
ANCHORS_AT_ONCE, BLOCKS_AT_ONCE = 4096, 16384
#: Blocks, spread over the order, that are read first to learn how good an answer must be.
PROBES = 2
POSITIVES, NEGATIVES = 5, 3
#: Positive's score times these, over 100, bounds a negative's score.
LEAST, MOST = 50, 95
_ANCHORS_PER_STEP = 256
_FAR = 2**63 - 1


def blocks_of(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows (vec_id, label, x, anchor) with ``block``, stored in folders by block."""
    found = sums(rows, "x")
    n = found[0][0] if found else 0
    spread = [r[4] / r[0] - (r[1] / r[0]) ** 2 for r in found]
    axes = sorted(range(len(spread)), key=lambda i: (-spread[i], i))[:AXES]
    low = np.array([found[i][2] for i in axes], float)
    wide = np.array([found[i][3] - found[i][2] for i in axes], float) + 1
    width = len(found)

    def place(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for x in batches:
            cells = (matrix(x, width)[:, axes] - low) / wide * 2**BITS if len(x) else np.zeros((0, len(axes)))
            yield pa.array(hilbert_key(np.clip(cells, 0, 2**BITS - 1).astype(np.int64), BITS))

    order = ["label", "place", "vec_id"]
    placed = rows.withColumn("place", F.arrow_udf(place, "long")(F.col("x")))
    count = max(1, -(-n // block_rows))
    ordered = placed.repartitionByRange(count, *order).sortWithinPartitions(*order).drop("place")
    path = work_folder(rows.sparkSession, "blocks")
    ordered.withColumn("block", F.spark_partition_id()).write.partitionBy("block").parquet(path)
    schema = rows.select("vec_id", "label", "x", "anchor").schema.add("block", "integer")
    return rows.sparkSession.read.schema(schema).parquet(path)


def zone_maps(blocks: DataFrame, width: int) -> DataFrame:
    """Per block: rows, anchors, least and greatest label, least and greatest entry of every dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = batch.column("block").to_numpy()
            cuts = np.r_[0, np.flatnonzero(np.diff(block)) + 1, len(block)] if len(block) else np.zeros(1, int)
            for a, b in zip(cuts[:-1], cuts[1:]):
                part = batch.slice(a, b - a)
                x = matrix(part.column("x"), width)
                label = part.column("label").to_numpy()
                anchors = int(part.column("anchor").to_numpy(zero_copy_only=False).sum())
                values = [int(block[a]), b - a, anchors, int(label.min()), int(label.max())]
                columns = [pa.array([v]) for v in values]
                columns += [pa.array([v.tobytes()], pa.binary()) for v in (x.min(axis=0), x.max(axis=0))]
                yield pa.RecordBatch.from_arrays(columns, ["block", "n", "anchors", "l0", "l1", "lo", "hi"])

    schema = "block long, n long, anchors long, l0 long, l1 long, lo binary, hi binary"
    return stored(blocks.mapInArrow(run, schema), "zones")


def bounds(anchors: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest possible score of each anchor in each block, widened by the rounding of doubles."""
    up, down = np.maximum(anchors, 0).astype(float), np.minimum(anchors, 0).astype(float)
    lo, hi = lo.astype(float).T, hi.astype(float).T
    slack = 1e-12 * (np.abs(anchors).astype(float) @ np.maximum(np.abs(lo), np.abs(hi))) + 1
    return up @ lo + down @ hi - slack, up @ hi + down @ lo + slack


def dots(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact; beyond a long they stay at its limits."""
    greatest = int(np.abs(a).max(initial=0)) * int(np.abs(x).max(initial=0)) * max(1, a.shape[1])
    if greatest < 2**53:
        return (a.astype(float) @ x.T.astype(float)).astype(np.int64)
    if greatest < 2**63:
        return a @ x.T
    return np.clip(a.astype(object) @ x.T.astype(object), -_FAR, _FAR).astype(np.int64)


def _scan(blocks: DataFrame, needed: dict[int, np.ndarray], chunk: dict, windows: dict, k: int) -> DataFrame:
    """Rows (anchor, window, score, vec_id): for each window the best ``k`` of each block, if they reach its floor.

    ``needed`` names the blocks to read and for each the anchors that need it. ``windows`` has least and
    greatest score per anchor and window, and whether it asks for rows of the anchor's own label.
    """
    sent = blocks.sparkSession.sparkContext.broadcast((needed, chunk, windows))
    width = chunk["x"].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        needed, chunk, windows = sent.value
        for batch in batches:
            block = batch.column("block").to_numpy()
            cuts = np.r_[0, np.flatnonzero(np.diff(block)) + 1, len(block)] if len(block) else np.zeros(1, int)
            for a, b in zip(cuts[:-1], cuts[1:]):
                part = batch.slice(a, b - a)
                ids, labels = part.column("vec_id").to_numpy(), part.column("label").to_numpy()
                x = matrix(part.column("x"), width)
                wanted = needed[int(block[a])]
                for i in range(0, len(wanted), _ANCHORS_PER_STEP):
                    found = _best(wanted[i : i + _ANCHORS_PER_STEP], chunk, windows, ids, labels, x, k)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["anchor", "window", "score", "vec_id"])

    some = blocks.filter(F.col("block").isin(list(needed))).select("block", "vec_id", "label", "x")
    return some.mapInArrow(run, "anchor long, window long, score long, vec_id long")


def _best(who: np.ndarray, chunk: dict, windows: dict, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, k: int) -> list:
    score = dots(chunk["x"][who], x)
    same = chunk["label"][who][:, None] == labels
    usable = same & (chunk["vec_id"][who][:, None] != ids) if windows["same"] else ~same
    rows = []
    for w in range(windows["least"].shape[1]):
        low, high = windows["least"][who, w], windows["most"][who, w]
        i, j = np.nonzero(usable & (score >= low[:, None]) & (score <= high[:, None]))
        value, name = score[i, j], ids[j]
        order = np.lexsort((name, -value, i))
        i, value, name = i[order], value[order], name[order]
        keep = np.arange(len(i)) - np.searchsorted(i, i) < k
        rows.append((who[i[keep]], np.full(keep.sum(), w), value[keep], name[keep]))
    return [np.concatenate(c).astype(np.int64) for c in zip(*rows)]


def _top(rows: DataFrame, k: int) -> DataFrame:
    """The best ``k`` rows of each anchor and window with their rank."""
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _search(blocks: DataFrame, zones: list, chunk: dict, windows: dict, k: int, probe: list[np.ndarray]) -> DataFrame:
    """Best ``k`` rows of every window of a chunk of anchors: probes first, then what can still matter.

    ``probe`` has for each block the anchors that read it first. Floors rise with what was found.
    """
    pieces = []
    n = len(chunk["vec_id"])
    least = windows["least"].copy()
    open_ = windows["least"] <= windows["most"]
    seen = np.zeros((len(zones), n), bool)
    for b, who in enumerate(probe):
        seen[b, who] = True
    for first in (True, False):
        needed = {}
        for a in range(0, len(zones), BLOCKS_AT_ONCE):
            some = zones[a : a + BLOCKS_AT_ONCE]
            low, high = bounds(chunk["x"], np.stack([z["lo"] for z in some]), np.stack([z["hi"] for z in some]))
            l0, l1 = np.array([z["l0"] for z in some]), np.array([z["l1"] for z in some])
            label = chunk["label"][:, None]
            can = (label >= l0) & (label <= l1) if windows["same"] else ~((label == l0) & (label == l1))
            meets = np.zeros_like(can)
            for w in range(least.shape[1]):
                meets |= open_[:, [w]] & (high >= least[:, [w]]) & (low <= windows["most"][:, [w]])
            can &= meets & (seen[a : a + len(some)].T == first)
            needed |= {z["block"]: np.flatnonzero(can[:, i]) for i, z in enumerate(some) if can[:, i].any()}
        if not needed:
            continue
        found = stored(_scan(blocks, needed, chunk, windows | {"least": least}, k), "candidates")
        pieces.append(found)
        if first:
            for r in _top(found, k).filter(F.col("rank") == k).collect():  # one row a window of the chunk
                least[r["anchor"], r["window"]] = max(least[r["anchor"], r["window"]], r["score"])
    if not pieces:
        empty = "anchor long, window long, score long, vec_id long, rank int"
        return blocks.sparkSession.createDataFrame([], empty)
    whole_rows = pieces[0].unionByName(pieces[1]) if len(pieces) > 1 else pieces[0]
    return _top(whole_rows, k)


def _chunks(zones: list, most: int) -> Iterator[list[int]]:
    """Runs of blocks with about ``most`` anchors each."""
    run, held = [], 0
    for i, z in enumerate(zones):
        if z["anchors"] and held and held + z["anchors"] > most:
            yield run
            run, held = [], 0
        if z["anchors"]:
            run.append(i)
            held += z["anchors"]
    if run:
        yield run


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    label: str = "label",
    vector: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    at_once: int = ANCHORS_AT_ONCE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of every anchor and positive.

    A row's score is its inner product with the anchor, entries taken as floor(256 * entry). Positives are the
    best POSITIVES other rows of the anchor's label, negatives the best NEGATIVES rows of other labels with
    LEAST % to MOST % of the positive's score; equal scores go by vec_id. ``is_anchor`` is evaluated on ``rows``.

    Rows with a null vec_id, label or vector, or a null or non-finite entry, or a vector of another length than the
    most frequent one, take no part. Identical rows count once. Different rows of one vec_id all take part, as
    anchors each for itself, but are no positives of each other. An empty table gives no rows. Other columns
    are not read.
    """
    spark = rows.sparkSession
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    usable = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col(label).cast("long").alias("label"),
        F.col(vector).alias("x"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    ).filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite(F.col("x")))
    usable = usable.withColumn("x", whole(F.col("x"), SCALE))
    usable = usual_length(usable, "x").distinct()
    usable = stored(usable, "vectors")
    head = usable.select(F.size("x")).first()
    if head is None:
        return spark.createDataFrame([], out)
    blocks = blocks_of(usable, block_rows)
    zones = _merged(zone_maps(blocks, head[0]).orderBy("block").collect())
    path = work_folder(spark, "negatives")
    written = False
    for run in _chunks(zones, at_once):
        names = [zones[i]["block"] for i in run]
        held = blocks.filter(F.col("block").isin(names) & F.col("anchor")).select("vec_id", "label", "x", "block")
        held = sorted(held.collect(), key=lambda r: (r["block"], r["label"], r["vec_id"], r["x"]))
        chunk = {
            "vec_id": np.array([r["vec_id"] for r in held], np.int64),
            "label": np.array([r["label"] for r in held], np.int64),
            "x": np.array([r["x"] for r in held], np.int64),
        }
        home = np.array([r["block"] for r in held])
        n = len(held)
        whole_range = np.full((n, 1), -_FAR), np.full((n, 1), _FAR)
        own = [np.flatnonzero(home == z["block"]) for z in zones]
        asked = {"least": whole_range[0], "most": whole_range[1], "same": True}
        near = _search(blocks, zones, chunk, asked, POSITIVES, own).collect()  # POSITIVES rows an anchor
        positive = {(r["anchor"], r["rank"]): (r["vec_id"], r["score"]) for r in near}
        least, most = np.ones((n, POSITIVES), np.int64), np.zeros((n, POSITIVES), np.int64)
        for (a, rank), (_, score) in positive.items():
            least[a, rank - 1], most[a, rank - 1] = -(-LEAST * score // 100), MOST * score // 100
        step = max(1, len(zones) // PROBES)
        everyone = np.arange(n)
        probe = [everyone if i % step == step // 2 else everyone[:0] for i in range(len(zones))]
        found = _search(blocks, zones, chunk, {"least": least, "most": most, "same": False}, NEGATIVES, probe)
        pairs = [(a, rank - 1, int(chunk["vec_id"][a]), v, s) for (a, rank), (v, s) in positive.items()]
        if not pairs:
            continue
        pairs = spark.createDataFrame(pairs, "anchor long, window long, anchor_id long, positive_id long, positive_score long")
        # at most POSITIVES rows for each of at_once anchors
        named = found.join(F.broadcast(pairs), ["anchor", "window"])
        named = named.withColumns({"negative_id": F.col("vec_id"), "negative_score": F.col("score")})
        wanted = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        named.select(*wanted).write.mode("append").parquet(path)
        written = True
    return spark.read.schema(out).parquet(path) if written else spark.createDataFrame([], out)


def _merged(rows: list) -> list[dict]:
    """One zone per block, whatever the batches it was read in."""
    found: dict[int, dict] = {}
    for r in rows:
        lo, hi = np.frombuffer(r["lo"], np.int64), np.frombuffer(r["hi"], np.int64)
        z = found.setdefault(r["block"], dict(block=r["block"], n=0, anchors=0, l0=r["l0"], l1=r["l1"], lo=lo, hi=hi))
        z["n"], z["anchors"] = z["n"] + r["n"], z["anchors"] + r["anchors"]
        z["l0"], z["l1"] = min(z["l0"], r["l0"]), max(z["l1"], r["l1"])
        z["lo"], z["hi"] = np.minimum(z["lo"], lo), np.maximum(z["hi"], hi)
    return [found[k] for k in sorted(found)]


def mined(embeddings: DataFrame) -> DataFrame:
    """Hard negatives of the rows whose vec_id is divisible by 50; where it is divisible by 7 the label moves on."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = embeddings.select("vec_id", moved.alias("label"), "embedding")
    return hard_negatives(rows, F.col("vec_id") % 50 == 0)
