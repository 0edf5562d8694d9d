"""Benchmark passages in documents by Wu-Manber multi-pattern search over words.

Patterns are the windows of the benchmark items. All documents of a batch are searched at once: each
stretch of a document has a cursor, a table of shifts tells for the block of words that ends at the
cursor how far no pattern can end, and cursors jump by it. Where the shift is zero, the hash of the
block names the bucket of patterns that end so, and these are compared word by word, on the bytes.

The patterns of one search are broadcast; ``BROADCAST_BYTES`` bounds them. A greater benchmark is
searched in several blocks of items, whose findings are merged per document.
"""

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm.tables import stored
from convoy.llm.words import PLACE, WORD_SIGNS, Words, flat, mixed, runs, words

WINDOW = 13
BROADCAST_BYTES = 16 << 20
STRETCH = 512  # words that one cursor goes through
TABLE_BITS = 18


@dataclass(frozen=True)
class Patterns:
    """Patterns of one length with their tables."""

    length: int
    block: int
    shifts: np.ndarray
    buckets: dict[int, list[int]]
    texts: list[bytes]
    items: list[list[int]]


def block_hash(hashes: np.ndarray, at: np.ndarray, block: int) -> np.ndarray:
    """Place in the tables of the block of words that ends at each position."""
    total = hashes[at] * PLACE[0]
    for i in range(1, block):
        total = total + hashes[at - i] * PLACE[i]
    return (mixed(total) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def compile_patterns(items: list[tuple[int, str]], window: int = WINDOW) -> list[Patterns]:
    """Windows of the items, by length: all runs of ``window`` words, or the whole of a shorter item."""
    owners: dict[int, dict[bytes, set[int]]] = defaultdict(lambda: defaultdict(set))
    hashes: dict[bytes, np.ndarray] = {}
    for item, text in items:
        w = words(*flat(pa.array([text], pa.string())), WORD_SIGNS)
        n = len(w.starts)
        length = min(n, window)
        raw = w.data.tobytes()
        for i in range(n - length + 1 if n else 0):
            key = b" ".join(raw[a:b] for a, b in zip(w.starts[i : i + length], w.ends[i : i + length]))
            owners[length][key].add(item)
            hashes[key] = w.hashes[i : i + length]
    found = []
    for length, own in sorted(owners.items()):
        block = min(2, length)
        shifts = np.full(1 << TABLE_BITS, length - block + 1, np.int64)
        buckets: dict[int, list[int]] = defaultdict(list)
        for k, key in enumerate(own):
            ends = np.arange(block - 1, length)
            np.minimum.at(shifts, (slots := block_hash(hashes[key], ends, block)), length - 1 - ends)
            buckets[int(slots[-1])].append(k)
        found.append(Patterns(length, block, shifts, dict(buckets), list(own), [sorted(own[k]) for k in own]))
    return found


def occurrences(w: Words, patterns: Patterns) -> Iterator[tuple[int, int]]:
    """(first word, pattern) of every occurrence in the texts."""
    length, raw = patterns.length, None
    counts = np.diff(w.first)
    # a cursor for every stretch: the last words of patterns are sought at from..to-1
    per = np.maximum(0, -(-(counts - length + 1) // STRETCH))
    text = np.repeat(np.arange(len(counts)), per)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
    cursor = w.first[text] + nth * STRETCH + length - 1
    to = np.minimum(cursor + STRETCH, w.first[text + 1])
    while len(cursor):
        slot = block_hash(w.hashes, cursor, patterns.block)
        shift = patterns.shifts[slot]
        for i in np.flatnonzero(shift == 0).tolist():
            bucket = patterns.buckets.get(int(slot[i]))
            if bucket:
                raw = w.data.tobytes() if raw is None else raw
                a = int(cursor[i]) - length + 1
                found = b" ".join(
                    raw[x:y] for x, y in zip(w.starts[a : a + length].tolist(), w.ends[a : a + length].tolist())
                )
                for k in bucket:
                    if patterns.texts[k] == found:
                        yield a, k
        cursor = cursor + np.maximum(shift, 1)
        going = cursor < to
        cursor, to = cursor[going], to[going]


def search(texts: pa.Array, compiled: list[Patterns]) -> Iterator[tuple[int, list[list[int]], list[int]]]:
    """Per text: number of words, maximal hit runs of words as [from, to), and the items found."""
    data, offsets = flat(texts)
    for a, b in runs(offsets):
        part = offsets[a : b + 1]
        w = words(data[part[0] : part[-1]], part - part[0], WORD_SIGNS)
        change = np.zeros(len(w.starts) + 1, np.int64)
        items: dict[int, set[int]] = defaultdict(set)
        for patterns in compiled:
            for at, k in occurrences(w, patterns):
                change[at] += 1
                change[at + patterns.length] -= 1
                items[int(np.searchsorted(w.first, at, "right")) - 1].update(patterns.items[k])
        hit = np.cumsum(change)[:-1] > 0
        for i in range(b - a):
            x, y = int(w.first[i]), int(w.first[i + 1])
            spans: list[list[int]] = []
            if i in items:
                own = np.diff(np.r_[False, hit[x:y], False].astype(np.int8))
                spans = np.column_stack([np.flatnonzero(own == 1), np.flatnonzero(own == -1)]).tolist()
            yield y - x, spans, sorted(items.get(i, ()))


FOUND = pa.struct(
    [("n_words", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))), ("items", pa.list_(pa.int64()))]
)


def _searched(items: list[tuple[int, str]], window: int):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        compiled = compile_patterns(items, window)
        for batch in batches:
            rows = list(search(batch, compiled))
            yield pa.array([dict(zip(("n_words", "spans", "items"), r)) for r in rows], FOUND)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "n_words long, spans array<array<long>>, items array<long>")


def item_blocks(benchmark: DataFrame, most: int = BROADCAST_BYTES) -> Iterator[list[tuple[int, str]]]:
    """Items as (item_id, text) in lists of at most ``most`` bytes of text on average; one at least."""
    texts = benchmark.filter("item_id is not null and text is not null").select(
        F.col("item_id").cast("long"), "text"
    )
    # a window repeats up to 13 times what the item has
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = -(-size * WINDOW // most)
    for k in range(max(1, blocks)):
        own = texts.filter(F.pmod(F.xxhash64("item_id"), F.lit(max(1, blocks))) == k)
        yield [(r[0], r[1]) for r in own.collect()]


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, out: str = "found") -> DataFrame:
    """``docs`` with a struct column ``out``: n_words, spans (hit runs of words as [from, to]), items.

    Needs ``text`` in both tables and ``item_id``. Null and wordless texts have no words and no hits;
    items without words, text or id have no window. Equal windows of several items name all of them;
    repeated items count once. An empty benchmark hits nothing. ``out`` replaces a column of its name.
    """
    blocks = item_blocks(benchmark)
    found = docs.withColumn(out, _searched(next(blocks), window)(F.col("text").cast("string")))
    for items in blocks:
        # fixed-size blocks of patterns: one more column each time, merged word by word
        more = _searched(items, window)(F.col("text").cast("string"))
        found = stored(found.withColumn("__more", more), "contamination")
        merged = F.struct(
            F.col(out)["n_words"].alias("n_words"),
            merged_spans(F.concat(F.col(out)["spans"], F.col("__more")["spans"])).alias("spans"),
            F.array_sort(F.array_union(F.col(out)["items"], F.col("__more")["items"])).alias("items"),
        )
        found = found.withColumn(out, merged).drop("__more")
    return found


def merged_spans(spans):
    """Maximal runs covered by any of the spans."""
    return F.aggregate(
        F.array_sort(spans),
        F.expr("cast(array() as array<array<bigint>>)"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (s[0] <= F.element_at(done, -1)[1]),
            F.concat(
                F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))),
                F.array(F.array(F.element_at(done, -1)[0], F.greatest(F.element_at(done, -1)[1], s[1]))),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )


def n_hit(found) -> F.col:
    """Number of hit words."""
    return F.aggregate(found["spans"], F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])


def is_contaminated(found) -> F.col:
    """At least one hit word, and one of twenty words hit."""
    return (n_hit(found) > 0) & (n_hit(found) * 20 >= found["n_words"])


def contamination_digests(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    f = F.col("found")
    names = F.array_sort(F.transform(f["items"], lambda i: i.cast("string")))
    return contamination(docs.select("doc_id", "text"), benchmark).select(
        "doc_id",
        f["n_words"].alias("n_words"),
        n_hit(f).alias("n_hit"),
        F.size(f["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        is_contaminated(f).alias("contaminated"),
    )
