"""Near-duplicate documents by b-bit MinHash.

1. Every document's set of shingles is hashed; of each of 512 minima, mixed once more, one bit is kept, packed into
   words, and 32 bands of four whole minima give the keys of buckets. Documents with equal sets
   become one node.
2. In every bucket some nodes are hubs. Pairs of a hub and another node of its bucket that are not
   yet in one component are candidates; in small buckets all such pairs are. The collision-corrected similarity, estimated from the
   packed bits by bit counts, drops pairs of more than 128 shingles that are five standard deviations below the
   threshold, and a bitmap of the shingles those of any size that cannot have enough in common.
3. The others are confirmed on the full sets. Links join components, and what is seen to have become one
   component (by two steps of label propagation) needs no further comparing.
4. A hub is done with its bucket; buckets in which all that is left is seen to lie in one component are done.
   The next round takes more hubs per bucket. So every pair of a bucket is either
   compared or already linked when the rounds end, however large the bucket, and no round makes more
   rows than hubs times members.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy.llm.components import components, merged_once
from convoy.llm.tables import discard, stored
from convoy.llm.words import NOT_SPACE, chained, flat, mixed, runs, words

WORDS = 5
THRESHOLD_PERCENT = 75
BANDS, BAND_SIZE = 32, 4
MINIMA = 512  # the bands use the first of them
BITS = 1
PLANES = [f"p{i}" for i in range(BITS * MINIMA // 64)]
MAP_BITS = 512
MAPS = [f"m{i}" for i in range(MAP_BITS // 64)]
#: Pairs of sets up to this size are left to the bitmap, which is the sharper bound there and never wrong.
FEW = 128
#: Texts whose minima are held at once.
TEXTS_AT_ONCE = 4096
#: Up to so many ids are broadcast to pick out the documents of candidate pairs (8 MB).
BROADCAST_IDS = 1_000_000

_SEEDS = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, (2, MINIMA), dtype=np.uint64)
XOR = (_SEEDS[0] >> np.uint64(16)).astype(np.uint32)
TIMES = (_SEEDS[1] >> np.uint64(16)).astype(np.uint32) | np.uint32(1)


def shingle_sets(texts: pa.Array, n: int = WORDS):
    """For runs of texts: (hashes, first): each text's distinct shingles in order, one after the other,
    and where they begin. Fewer words than ``n`` are one shingle; no words, none."""
    data, offsets = flat(texts)
    for a, b in runs(offsets, texts=TEXTS_AT_ONCE):
        part = offsets[a : b + 1]
        w = words(data[part[0] : part[-1]], part - part[0], NOT_SPACE)
        counts = np.diff(w.first)
        every = chained(w.hashes, n)
        sizes = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
        found = np.empty(int(sizes.sum()), np.uint64)
        ends = np.cumsum(sizes)
        for x, size, m, to in zip(w.first.tolist(), sizes.tolist(), counts.tolist(), ends.tolist()):
            if m >= n:
                own = found[to - size : to]
                own[:] = every[x : x + size]
                own.sort()
            elif m:
                found[to - 1] = chained(w.hashes[x : x + m], m)[0] + np.uint64(m)
        new = np.ones(len(found), bool)
        new[1:] = found[1:] != found[:-1]
        starts = (ends - sizes)[sizes > 0]
        new[starts] = True
        first = np.r_[0, np.cumsum(new)][np.r_[0, ends]]
        yield found[new], first


def fingerprints(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """128 bits for each set: sums of two independent hashes of its members."""
    prints = np.zeros((len(first) - 1, 2), np.uint64)
    filled = np.flatnonzero(np.diff(first) > 0)
    if len(filled):
        for k in range(2):
            member = mixed(hashes * _SEEDS[k, 0] + _SEEDS[k, 1])
            prints[filled, k] = np.add.reduceat(member, first[:-1][filled])
    return prints.view(np.int64)


def _scattered(x: np.ndarray) -> np.ndarray:
    """Bits that depend on the whole of each minimum: the low bits of an odd multiple follow the member alone."""
    x = x ^ (x >> np.uint32(16))
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def signatures(hashes: np.ndarray, first: np.ndarray):
    """(band keys, words of bit planes and bitmap) of each set; sets without shingles get zeros."""
    n = len(first) - 1
    filled = np.flatnonzero(np.diff(first) > 0)
    starts = first[:-1][filled]
    minima = np.zeros((n, MINIMA), np.uint32)
    if len(filled):
        small = (hashes >> np.uint64(32)).astype(np.uint32)
        for k in range(MINIMA):
            minima[filled, k] = np.minimum.reduceat((small ^ XOR[k]) * TIMES[k], starts)
    keys = np.zeros((n, BANDS), np.uint64)
    for j in range(BAND_SIZE):
        own = minima[:, j : BANDS * BAND_SIZE : BAND_SIZE].astype(np.uint64)
        keys = mixed(keys ^ own + np.arange(BANDS, dtype=np.uint64))
    bits = np.zeros((n, BITS * MINIMA + MAP_BITS), np.uint8)
    minima = _scattered(minima)
    for bit in range(BITS):
        bits[:, bit * MINIMA : (bit + 1) * MINIMA] = (minima >> np.uint32(bit)) & 1
    text = np.repeat(np.arange(n), np.diff(first))
    bits[text, BITS * MINIMA + (hashes % np.uint64(MAP_BITS)).astype(np.int64)] = 1
    return keys.view(np.int64), np.packbits(bits, axis=1).view(np.uint64).view(np.int64)


def _lists(values: np.ndarray) -> pa.Array:
    flat_values = pa.array(np.ascontiguousarray(values).reshape(-1))
    return pa.ListArray.from_arrays(
        np.arange(len(values) + 1, dtype=np.int32) * values.shape[1], flat_values
    )


def _sketch(batches):
    for batch in batches:
        ids, at = batch.column("doc_id"), 0
        carried = [c for c in batch.schema.names if c not in ("doc_id", "text")]
        for hashes, first in shingle_sets(batch.column("text")):
            keys, bits = signatures(hashes, first)
            prints = fingerprints(hashes, first)
            n = len(first) - 1
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(at, n),
                    *(batch.column(c).slice(at, n) for c in carried),
                    pa.array(np.diff(first)),
                    pa.array(prints[:, 0].copy()),
                    pa.array(prints[:, 1].copy()),
                    _lists(keys),
                    *(pa.array(np.ascontiguousarray(bits[:, i])) for i in range(bits.shape[1])),
                ],
                names=["doc_id", *carried, "n_shingles", "f1", "f2", "bands", *PLANES, *MAPS],
            )
            at += n


def _full_sets(batches):
    for batch in batches:
        for hashes, first in shingle_sets(batch.column("text")):
            sizes = np.diff(first)
            sets = pa.ListArray.from_arrays(first.astype(np.int32), pa.array(hashes.view(np.int64)))
            prints = fingerprints(hashes, first)
            arrays = [pa.array(sizes), pa.array(prints[:, 0].copy()), pa.array(prints[:, 1].copy()), sets]
            yield pa.RecordBatch.from_arrays(arrays, names=["n_shingles", "f1", "f2", "shingles"])


def estimate(a: str, b: str) -> Column:
    """Similarity estimated from the packed bits of two rows' minima, corrected for equal bits of
    different minima."""
    per = MINIMA // 64
    different = F.lit(0)
    for word in range(per):
        planes = [F.col(f"{a}.{PLANES[i * per + word]}").bitwiseXOR(F.col(f"{b}.{PLANES[i * per + word]}")) for i in range(BITS)]
        any_plane = planes[0]
        for p in planes[1:]:
            any_plane = any_plane.bitwiseOR(p)
        different = different + F.bit_count(any_plane)
    equal = 1 - different / MINIMA
    return (equal - 0.5**BITS) / (1 - 0.5**BITS)


def _least_estimate(threshold: float) -> float:
    equal = threshold + (1 - threshold) * 0.5**BITS
    return threshold - 5 * (equal * (1 - equal) / MINIMA) ** 0.5 / (1 - 0.5**BITS)


def _may_reach(a: str, b: str, percent: int) -> Column:
    """Whether two sets can be similar enough: a bit that only one bitmap has is a shingle that only that
    set has."""

    def own(x: str, y: str) -> Column:
        alone = F.lit(0)
        for m in MAPS:
            alone = alone + F.bit_count(F.col(f"{x}.{m}").bitwiseAND(F.bitwise_not(F.col(f"{y}.{m}"))))
        return F.col(f"{x}.n_shingles") - alone

    both = F.col(f"{a}.n_shingles") + F.col(f"{b}.n_shingles")
    return F.least(own(a, b), own(b, a)) * (100 + percent) >= both * percent


_SET = ["n_shingles", "f1", "f2"]
_BITS = [*PLANES, *MAPS]
_NO_ID = -(2**63)


def _sets(docs: DataFrame, nodes: DataFrame, members: DataFrame) -> DataFrame:
    """(node, shingles) of the members of crowded buckets, from one more reading of their texts."""
    used = members.select("node").distinct()
    wanted = nodes.join(used, "node").select("node", *_SET, F.coalesce("least_id", F.lit(_NO_ID)).alias("id"))
    wanted = stored(wanted, "wanted")
    ids = wanted.select("id").distinct()
    ids = F.broadcast(ids) if wanted.count() <= BROADCAST_IDS else ids
    of_ids = docs.withColumn("id", F.coalesce("doc_id", F.lit(_NO_ID))).join(ids, "id", "left_semi").select("text")
    sets = of_ids.mapInArrow(_full_sets, "n_shingles long, f1 long, f2 long, shingles array<long>")
    # an id may repeat with the same or another text
    sets = stored(sets.join(wanted, _SET).select("node", "shingles").dropDuplicates(["node"]), "sets")
    discard(wanted)
    return sets


def _confirmed(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, ...) of nodes whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("s"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("t"))
    common = F.size(F.array_intersect("s", "t"))
    union = F.size("s") + F.size("t") - common
    return pairs.join(left, "a").join(right, "b").filter(common * 100 >= union * percent).select(*pairs.columns)


def near_duplicates(docs: DataFrame, percent: int = THRESHOLD_PERCENT, carry: str | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept. ``carry`` names a
    string column that is handed on, to tell rows of one id apart.

    Sets of five-word shingles (A-Z lower-cased, words between white space) are linked if
    100 * intersection >= percent * union. ``component_id`` is the smallest id that links reach. Null and
    wordless texts have no shingles and stay alone; equal sets are always linked. Rows that repeat an id
    count by their own texts. Rows without an id take part in links; a component without any id has
    ``component_id`` null and is kept. An empty table gives an empty result; further columns are ignored.
    """
    more = [F.col(carry).alias("carried")] if carry else []
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *more)
    kinds = "doc_id long, " + ("carried string, " if carry else "") + "n_shingles long, f1 long, f2 long, bands array<long>, "
    kinds += ", ".join(f"{c} long" for c in _BITS)
    rows = stored(docs.mapInArrow(_sketch, kinds), "sketches")
    # equal sets have equal bands and planes: any of them will do
    groups = rows.filter("n_shingles > 0").groupBy(*_SET).agg(
        F.min("doc_id").alias("least_id"), *[F.any_value(c).alias(c) for c in ("bands", *_BITS)]
    )
    nodes = stored(groups.withColumn("node", F.monotonically_increasing_id()), "nodes")

    found = components(_bucket_links(docs, nodes, percent))
    of_node = stored(
        nodes.join(found, "node", "left").select(
            *_SET, "least_id", F.coalesce("component", "node").alias("component")
        ),
        "components",
    )
    least = of_node.groupBy("component").agg(F.min("least_id").alias("least_id"))
    root = stored(of_node.drop("least_id").join(least, "component").drop("component"), "roots")
    discard(nodes, of_node)
    component = F.when(F.col("n_shingles") > 0, F.col("least_id")).otherwise(F.col("doc_id"))
    return (
        rows.join(root, _SET, "left")
        .select(
            "doc_id",
            "n_shingles",
            component.alias("component_id"),
            F.col("doc_id").eqNullSafe(component).alias("kept"),
            *([F.col("carried").alias(carry)] if carry else []),
        )
    )


#: Buckets of so many nodes are compared pair by pair, at most 120 pairs each; larger ones by hubs.
SMALL_BUCKET = 16


def _rounds():
    """(which buckets, hubs per bucket) of each round. The first two find most links, so that the later ones
    compare little. Small buckets are done with in the second."""
    yield F.col("band") < BANDS // 8, 1
    yield F.col("size") > SMALL_BUCKET, 1
    hubs = 16
    while True:
        yield F.lit(True), hubs
        hubs *= 16


def _near(members: DataFrame, others: DataFrame, bits: DataFrame, percent: int, different: bool = False) -> DataFrame:
    """Pairs (a, b) of nodes of one bucket that may be similar, and the components (u, v) they are in.

    A pair that meets in many buckets is a candidate in the first of them only; so a row carries half of the
    keys of the bands before its own.
    """

    def with_bits(rows: DataFrame) -> DataFrame:
        earlier = F.slice("halves", F.lit(1), F.col("band")).alias("earlier")
        return rows.join(bits, "node").select("bucket", "node", "component", "n_shingles", earlier, *_BITS)

    m, h = with_bits(members).alias("m"), with_bits(others).alias("h")
    wanted = (F.col("m.bucket") == F.col("h.bucket")) & (F.col("m.component") != F.col("h.component"))
    if different:
        wanted = wanted & (F.col("m.node") < F.col("h.node"))
    small, great = F.least("m.n_shingles", "h.n_shingles"), F.greatest("m.n_shingles", "h.n_shingles")
    wanted = wanted & (small * 100 >= great * percent)
    few = great <= FEW
    wanted = wanted & (few | (estimate("m", "h") >= _least_estimate(percent / 100))) & _may_reach("m", "h", percent)
    met_before = F.exists(F.zip_with("m.earlier", "h.earlier", lambda a, b: a == b), lambda x: x)
    return m.join(h, wanted & ~met_before).select(
        F.least("m.node", "h.node").alias("a"),
        F.greatest("m.node", "h.node").alias("b"),
        F.least("m.component", "h.component").alias("u"),
        F.greatest("m.component", "h.component").alias("v"),
    )


def _bucket_links(docs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) that connect what the threshold connects, from the rounds described above."""
    placed = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    crowded = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    crowded = stored(crowded, "crowded")
    members = placed.join(crowded, "bucket").withColumn("component", F.col("node"))
    members = stored(members, "members")
    discard(crowded)
    links = docs.sparkSession.createDataFrame([], "u long, v long")
    if members.isEmpty():
        return links
    sets = _sets(docs, nodes, members)
    halves = F.transform("bands", lambda b: b.bitwiseAND(F.lit(2**31 - 1)).cast("int")).alias("halves")
    bits = nodes.select("node", "n_shingles", halves, *_BITS)
    bits = stored(bits.join(members.select("node").distinct(), "node"), "bucket-nodes")
    for number, (part, slots) in enumerate(_rounds()):
        slot = F.pmod(F.xxhash64(F.lit(slots), "node", "bucket"), F.lit(slots))
        order = F.xxhash64(F.lit(-slots), "node", "bucket").alias("order")
        hubs = members.filter(part).groupBy("bucket", slot.alias("slot")).agg(
            F.min(F.struct(order, "node", "component", "band")).alias("hub")
        )
        hubs = stored(hubs.select("bucket", "hub.node", "hub.component", "hub.band"), "hubs")
        near = _near(members, hubs, bits, percent)
        rest = members
        if number == 1:
            small = members.filter(F.col("size") <= SMALL_BUCKET)
            near = near.unionByName(_near(small, small, bits, percent, different=True))
            rest = members.filter(F.col("size") > SMALL_BUCKET)
        new = stored(_confirmed(sets, near.distinct(), percent), "new-links")
        done = [hubs, members]
        rest = rest.join(hubs.select("bucket", "node"), ["bucket", "node"], "left_anti")
        if not new.isEmpty():
            links = links.unionByName(new.select(F.col("a").alias("u"), F.col("b").alias("v")))
            # most of what is joined now; only those nodes have to be looked at
            joined = stored(merged_once(new.select("u", "v")), "joined")
            done.append(joined)
            joined = joined.select(F.col("node").alias("component"), F.col("component").alias("whole"))
            rest = rest.join(joined, "component", "left")
            rest = rest.withColumn("component", F.coalesce("whole", "component")).drop("whole")
        rest = stored(rest.select(members.columns), "rest")
        split = rest.groupBy("bucket").agg(F.min("component").alias("a"), F.max("component").alias("b"))
        unlike = split.filter("a != b").select("bucket")
        members = stored(rest.join(unlike, "bucket", "left_semi").select(members.columns), "members")
        discard(*done, rest)
        if members.isEmpty():
            discard(members, sets, bits)
            return links
