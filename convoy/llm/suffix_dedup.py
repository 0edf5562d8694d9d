"""Removal of long strings that occur more than once, by sorted suffixes of shards.

1. Every 400-byte string owns an anchor: the short gram of least hash in it, the first of equals. Equal
   strings have the same anchor at the same distance. Starts that share an anchor form a stretch: the
   bytes of all strings that begin there.
2. Stretches whose anchor occurs once hold nothing repeated. Equal stretches are folded to one, with its
   count: all that begins in a stretch met twice is repeated.
3. What is left, different stretches around equal anchors, is cut in two by the side of the
   anchor on which a string has 200 bytes, and sharded by anchor and those bytes, so that equal strings meet in one shard.
4. The suffixes of a shard are put in order by external induced sorting; neighbours with 400 bytes in common are
   repeated. A group of stretches too large for one task is answered by counting its strings instead.
5. Repeated starts go back to all places of their stretch, and the bytes they cover are removed.

Texts are read three times and shuffled only where something repeats; between the readings only places, hashes
and the stretches of step 3 move.

Passages are repeated words, whatever their bytes: ``shared_passages`` takes steps 1 to 3 over words instead of bytes
and names the texts with a run of so many words that another row has as well. It removes nothing.
"""

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm.induced import suffix_array
from convoy.llm.tables import discard, stored
from convoy.llm.words import LETTER, NOT_SPACE, STEP, UNSTEP, Words, flat, mixed, runs, words

LENGTH = 400
GRAM = 24
SHARD_BYTES = 4 << 20
MEMORY_BYTES = 16 << 20  # of a shard that is sorted without queues on disk
#: Stretches of one group that are sorted in one task at most; of more, the strings are counted by Spark.
MOST_STRETCHES = 20_000
BROADCAST_KEYS = 1_000_000  # 16 bytes each
PASSAGE_WORDS = 51  # passages of over 50 words
PASSAGE_GRAM = 8


def anchors(letters: np.ndarray, length: int, gram: int):
    """For texts one after the other, as a random number for each unit: the anchor of every start, and the
    hash of every gram."""
    n, width = len(letters), length - gram + 1
    powers = np.full(n, STEP)
    powers[0] = 1
    np.cumprod(powers, out=powers)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(letters * powers, out=sums[1:])
    powers = np.full(n, UNSTEP)
    powers[0] = 1
    np.cumprod(powers, out=powers)
    hashes = mixed((sums[gram:] - sums[:-gram]) * powers[: n - gram + 1])
    ranked = (hashes >> np.uint64(32) << np.uint64(32)) | np.arange(len(hashes), dtype=np.uint64)
    # least of every window from the least before and after block borders
    blocks = np.full((-(-len(ranked) // width) + 1) * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[: len(ranked)] = ranked
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = max(0, len(ranked) - width + 1)
    least = np.minimum(behind[:starts], ahead[width - 1 : width - 1 + starts])
    return (least & np.uint64(0xFFFFFFFF)).astype(np.int64), hashes


def _as_long(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def stretches(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> Iterator[tuple]:
    """(text, start, number of starts, anchor, gram hash, two halves of the stretch's hash)."""
    if len(data) < length:
        return
    chosen, hashes = anchors(LETTER[data], length, gram)
    view = memoryview(np.ascontiguousarray(data))
    for i, (s, e) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        if e - s < length:
            continue
        own = chosen[s : e - length + 1]
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        for x, y, a in zip(first.tolist(), [*first[1:].tolist(), len(own)], own[first].tolist()):
            h = xxhash.xxh3_128_intdigest(view[s + x : s + y - 1 + length])
            yield i, x, y - x, a - s, int(hashes[a].view(np.int64)), _as_long(h >> 64), _as_long(h & (1 << 64) - 1)


def _places(length: int, gram: int):
    names = ["t1", "t2", "start", "starts", "anchor", "g", "c1", "c2"]

    def run(batches):
        for batch in batches:
            data, offsets = flat(batch.column("text"))
            keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("t1", "t2")]
            for a, b in runs(offsets):
                part = offsets[a : b + 1]
                rows = list(stretches(data[part[0] : part[-1]], part - part[0], length, gram))
                if rows:
                    text, *rest = (np.array(c, np.int64) for c in zip(*rows))
                    columns = [keys[0][a + text], keys[1][a + text], *rest]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return run


def _halves(length: int):
    """Cut stretches at the anchor's side and read their bytes from the text."""
    half = length // 2

    def run(batches):
        for batch in batches:
            out = []
            for text, wanted in zip(batch.column("text"), batch.column("wanted").to_pylist()):
                raw = memoryview(text.as_buffer() if text.is_valid else b"")
                for w in wanted:
                    lo, to, a = w["start"], w["start"] + w["starts"], w["anchor"]
                    middle = max(lo, min(to, a - half))
                    for side, x, y in ((0, lo, middle), (1, middle, to)):
                        if y > x:
                            near = raw[a - half : a] if side == 0 else raw[a : a + half]
                            key = xxhash.xxh3_64_intdigest(near, seed=(w["g"] + side) & (1 << 64) - 1)
                            out.append((_as_long(key), w["c1"], w["c2"], x - lo, y - x, w["copies"], bytes(raw[x : y - 1 + length])))
            columns = list(zip(*out)) if out else [[]] * 7
            kinds = [pa.int64()] * 6 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["key", "c1", "c2", "first", "starts", "copies", "bytes"],
            )

    return run


def repeated_starts(parts: list[bytes], starts: list[int], length: int, folder: str | None = None) -> list[np.ndarray]:
    """For each part, which of its first ``starts`` strings of ``length`` bytes occur twice among all."""
    sizes = np.array([len(p) for p in parts], np.int64)
    at = np.r_[0, np.cumsum(sizes + 1)]
    if folder is None:
        text = np.zeros(at[-1] + 1, np.int16)
    else:
        text = np.memmap(f"{folder}/text", np.int16, "w+", shape=(int(at[-1]) + 1,))
    wanted = np.zeros(len(text), bool)
    for p, a, n in zip(parts, at.tolist(), starts):
        text[a : a + len(p)] = np.frombuffer(p, np.uint8)
        text[a : a + len(p)] += 2
        text[a + len(p)] = 1
        wanted[a : a + n] = True
    text[-1] = 0
    order = suffix_array(text, 258, folder)
    order = order[wanted[order]]
    # neighbours with the whole length in common, eight bytes at a time
    raw = np.zeros(len(text) + 8, np.uint8)
    raw[: len(text)] = np.maximum(np.asarray(text) - 2, 0)
    words = np.lib.stride_tricks.as_strided(raw[:8].view(np.uint64), (len(text),), (1,))
    left = np.arange(len(order) - 1)
    for j in range(0, length, 8):
        j = min(j, length - 8)
        left = left[words[order[left] + j] == words[order[left + 1] + j]]
    twice = np.zeros(len(text), bool)
    twice[order[left]] = True
    twice[order[left + 1]] = True
    return [twice[a : a + n] for a, n in zip(at.tolist(), starts)]


def _spans(flags: np.ndarray, first: int, length: int) -> list[list[int]]:
    """Covered bytes [from, to) of the repeated starts, counted from ``first``."""
    change = np.diff(np.r_[False, flags, False].astype(np.int8))
    froms, tos = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    return [[first + int(a), first + int(b) - 1 + length] for a, b in zip(froms, tos)]


_FOUND = ["c1", "c2", "spans"]
_FOUND_SCHEMA = "c1 long, c2 long, spans array<array<long>>"


def _found(rows: list[tuple[int, int, list]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[], [], []]
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=_FOUND)


def _sort_shards(length: int, shard_bytes: int, memory_bytes: int):
    """Rows come ordered by key; whole groups are gathered to shards of about ``shard_bytes``."""

    def answer(rows):
        def of(folder):
            flags = repeated_starts([r["bytes"] for r in rows], [r["starts"] for r in rows], length, folder)
            return _found(
                [(r["c1"], r["c2"], s) for r, f in zip(rows, flags) if (s := _spans(f, r["first"], length))]
            )

        if sum(len(r["bytes"]) for r in rows) <= memory_bytes:
            return of(None)
        with tempfile.TemporaryDirectory() as folder:  # scratch of this task alone
            return of(folder)

    def run(batches):
        held, size, last = [], 0, None
        for batch in batches:
            for r in batch.to_pylist():
                if r["key"] != last and size >= shard_bytes:
                    yield answer(held)
                    held, size = [], 0
                last = r["key"]
                held.append(r)
                size += len(r["bytes"])
        if held:
            yield answer(held)

    return run


def _strings(length: int):
    """Every string of large groups by a 128-bit hash."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                view = memoryview(r["bytes"])
                hashes = [xxhash.xxh3_128_intdigest(view[i : i + length]) for i in range(r["starts"])]
                columns = [
                    [r["key"]] * len(hashes),
                    [_as_long(h >> 64) for h in hashes],
                    [_as_long(h & (1 << 64) - 1) for h in hashes],
                    [r["c1"]] * len(hashes),
                    [r["c2"]] * len(hashes),
                    list(range(r["first"], r["first"] + len(hashes))),
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], names=["key", "s1", "s2", "c1", "c2", "at"]
                )

    return run


def _count_strings(parts: DataFrame, length: int) -> DataFrame:
    strings = stored(
        parts.mapInArrow(_strings(length), "key long, s1 long, s2 long, c1 long, c2 long, at long"), "strings"
    )
    own = ["key", "s1", "s2"]
    twice = stored(strings.groupBy(*own).count().filter("count > 1").select(*own), "twice")
    return strings.join(twice, own, "left_semi").select(
        "c1", "c2", F.array(F.array("at", F.col("at") + length)).alias("spans")
    )


def _semi(docs: DataFrame, keys: DataFrame, on: tuple[str, ...] = ("t1", "t2")) -> DataFrame:
    """Texts whose key is among ``keys``, which are broadcast only if they are few."""
    keys = keys.select(*on).distinct()
    few = keys.count() <= BROADCAST_KEYS
    return docs.join(F.broadcast(keys) if few else keys, [*on], "left_semi")


def _merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


_REMOVED_SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _remove(with_text: bool, with_passage: bool):
    def run(batches):
        for batch in batches:
            rows = []
            for i, text, spans in zip(
                batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("spans").to_pylist()
            ):
                raw = memoryview(text.as_buffer() if text.is_valid else b"")
                spans = _merged(spans)
                kept, end = [], 0
                for a, b in spans:
                    kept.append(raw[end:a])
                    end = b
                kept = b"".join([*kept, raw[end:]])
                row = (i, len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
                rows.append((*row, kept) if with_text else row)
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            kinds = [pa.int64()] * 4 + [pa.string()]
            if with_text:
                names, kinds = [*names, "kept"], [*kinds, pa.binary()]
            columns = list(zip(*rows)) if rows else [[]] * len(names)
            columns = [pa.array(c, k) for c, k in zip(columns, kinds)]
            if with_passage:
                names, columns = [*names, "repeats_passage"], [*columns, batch.column("repeats_passage")]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def passages(w: Words, length: int, gram: int):
    """The stretches of texts' words: text, first start, number of starts, anchor's hash, hash of all words; and
    the hash of the string of ``length`` words at every start."""
    n = len(w.hashes)
    if n < length:
        return [np.empty(0, np.int64)] * 6
    chosen, hashes = anchors(w.hashes, length, gram)
    powers, back = np.full(n, STEP), np.full(n, UNSTEP)
    powers[0] = back[0] = 1
    np.cumprod(powers, out=powers)
    np.cumprod(back, out=back)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(w.hashes * powers, out=sums[1:])
    text = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    inside = text[: len(chosen)] == text[length - 1 :]
    new = np.ones(len(chosen) + 1, bool)
    new[1:-1] = (chosen[1:] != chosen[:-1]) | (inside[1:] != inside[:-1]) | (text[1 : len(chosen)] != text[: len(chosen) - 1])
    borders = np.flatnonzero(new)
    own = inside[borders[:-1]]
    x, y = borders[:-1][own], borders[1:][own]
    content = mixed((sums[y - 1 + length] - sums[x]) * back[x])
    strings = mixed((sums[length:] - sums[: len(chosen)]) * back[: len(chosen)])
    return text[x], x, y - x, hashes[chosen[x]].view(np.int64), content.view(np.int64), strings.view(np.int64)


def _words_of(batch: pa.RecordBatch) -> Iterator[tuple[int, Words]]:
    """Some texts of a batch at a time: the first one's number, and the words."""
    data, offsets = flat(batch.column("text"))
    for a, b in runs(offsets):
        part = offsets[a : b + 1]
        yield a, words(data[part[0] : part[-1]], part - part[0], NOT_SPACE)


def _passage_places(length: int, gram: int):
    def run(batches):
        for batch in batches:
            keys = batch.column("t1").to_numpy(zero_copy_only=False)
            for a, w in _words_of(batch):
                text, x, _, g, c, _ = passages(w, length, gram)
                columns = [keys[a + text], g, c, x == w.first[text]]
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in columns], names=["t1", "g", "c", "leads"])

    return run


def _passage_strings(length: int, gram: int):
    """Every string of the wanted stretches of a text."""

    def run(batches):
        for batch in batches:
            keys, wanted = batch.column("t1").to_pylist(), batch.column("wanted")
            for a, w in _words_of(batch):
                text, x, n, g, c, strings = passages(w, length, gram)
                cuts = np.searchsorted(text, np.arange(len(w.first)))
                for i in range(len(w.first) - 1):
                    asked = {(r["g"], r["c"]): r for r in wanted[a + i].as_py()}
                    rows = [
                        (asked[k], s, s + m)
                        for k, s, m in zip(
                            zip(g[cuts[i] : cuts[i + 1]].tolist(), c[cuts[i] : cuts[i + 1]].tolist()),
                            x[cuts[i] : cuts[i + 1]].tolist(),
                            n[cuts[i] : cuts[i + 1]].tolist(),
                        )
                        if k in asked
                    ]
                    if not rows:
                        continue
                    sizes = [e - s for _, s, e in rows]
                    columns = [
                        np.repeat(np.array([r["g"] for r, _, _ in rows], np.int64), sizes),
                        np.concatenate([strings[s:e] for _, s, e in rows]),
                        np.full(sum(sizes), keys[a + i], np.int64),
                        np.repeat(np.array([r["b"] for r, _, _ in rows], np.int64), sizes),
                        np.repeat(np.array([r["open"] for r, _, _ in rows], bool), sizes),
                    ]
                    yield pa.RecordBatch.from_arrays([pa.array(v) for v in columns], names=["g", "s", "a", "b", "open"])

    return run


def shared_passages(texts: DataFrame, length: int = PASSAGE_WORDS, gram: int = PASSAGE_GRAM) -> DataFrame:
    """t1 of the texts (t1, text) with ``length`` words in a row that another row has as well; a repeat inside one
    row alone does not count. Words are divided by white space, A-Z in lower case. t1 is a 64-bit key of the text,
    so rows with the same one are copies. Strings of words are compared by 128 bits of hashes."""
    texts = texts.filter(F.octet_length("text") >= 2 * length - 1).select("t1", "text")
    places = stored(
        texts.mapInArrow(_passage_places(length, gram), "t1 long, g long, c long, leads boolean"), "passage-places"
    )
    least, most = F.min("t1").alias("a"), F.max("t1").alias("b")
    grams = stored(places.groupBy("g").agg(least, most).filter("a <> b").select("g"), "passage-anchors")
    shared = stored(places.join(grams, "g", "left_semi").select("t1", "g", "c").distinct(), "shared-passages")
    copies = places.filter("leads").groupBy("t1").count().filter("count > 1").select("t1")
    kinds = stored(shared.groupBy("g", "c").agg(least, most), "passages")
    whole = shared.join(kinds.filter("a <> b"), ["g", "c"], "left_semi").select("t1")
    known = stored(copies.union(whole).distinct(), "passage-texts")
    # what is left: texts not known yet, whose stretches equal no other text's as a whole but may in part
    named = known.select(F.col("t1").alias("a"), F.lit(True).alias("known"))
    kinds_known = kinds.join(named, "a", "left").withColumn("open", F.expr("a = b AND known IS NULL"))
    groups = kinds_known.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.max("open").alias("o")).filter("n > 1 AND o")
    wanted = kinds_known.join(groups, "g", "left_semi").groupBy(F.col("a").alias("t1")).agg(
        F.collect_list(F.struct("g", "c", "b", "open")).alias("wanted")  # of one text
    )
    wanted = stored(wanted, "wanted-passages")
    sources = _semi(texts, wanted, ("t1",)).join(wanted, "t1")
    strings = stored(
        sources.mapInArrow(_passage_strings(length, gram), "g long, s long, a long, b long, open boolean"),
        "passage-strings",
    )
    twice = strings.groupBy("g", "s").agg(F.min("a").alias("a"), F.max("b").alias("b"), F.max("open").alias("o"))
    twice = twice.filter("a <> b AND o").select("g", "s")
    more = strings.filter("open").join(twice, ["g", "s"], "left_semi").select(F.col("a").alias("t1"))
    found = stored(known.union(more).distinct(), "texts-with-passages")
    discard(places, grams, shared, kinds, known, wanted, strings)
    return found


def repeated_spans(
    texts: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    shard_bytes: int = SHARD_BYTES,
    memory_bytes: int = MEMORY_BYTES,
    most_stretches: int = MOST_STRETCHES,
) -> DataFrame:
    """(t1, t2, spans) of texts (t1, t2, text) with repeated strings; spans are [from, to) in bytes and may
    overlap. The pair (t1, t2) is a 128-bit key of the text."""
    long_texts = texts.filter(F.octet_length("text") >= length)
    schema = ", ".join(f"{c} long" for c in ("t1", "t2", "start", "starts", "anchor", "g", "c1", "c2"))
    places = stored(long_texts.mapInArrow(_places(length, gram), schema), "places")
    content = F.struct("c1", "c2")
    shared = places.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min(content).alias("a"), F.max(content).alias("b"))
    shared = stored(shared.filter("n > 1").select("g", (F.col("a") != F.col("b")).alias("unlike")), "anchors")
    places = stored(places.join(shared, "g"), "shared-places")

    kinds = places.groupBy("g", "c1", "c2").agg(
        F.count(F.lit(1)).alias("copies"),
        F.max("unlike").alias("unlike"),
        F.max("starts").alias("starts"),
        F.min(F.struct("t1", "t2", "start", "starts", "anchor")).alias("one"),
    )
    kinds = stored(kinds, "stretches")
    whole = kinds.filter("copies > 1").select(
        "c1", "c2", F.array(F.array(F.lit(0).cast("long"), F.col("starts") - 1 + length)).alias("spans")
    )

    wanted = kinds.filter("unlike").select("one.*", "g", "c1", "c2", "copies").groupBy("t1", "t2").agg(
        F.collect_list(F.struct("start", "starts", "anchor", "g", "c1", "c2", "copies")).alias("wanted")  # of one text
    )
    wanted = stored(wanted, "wanted")
    sources = _semi(long_texts, wanted).join(wanted, ["t1", "t2"]).select("text", "wanted")
    parts = sources.mapInArrow(
        _halves(length), "key long, c1 long, c2 long, first long, starts long, copies long, bytes binary"
    )
    parts = stored(parts, "parts")
    # texts with copies gave the same parts several times
    groups = parts.select("key", "c1", "c2").distinct().groupBy("key").count().filter("count > 1")
    groups = stored(groups.withColumnRenamed("count", "members"), "groups")
    parts = parts.join(groups, "key")
    one = stored(parts.dropDuplicates(["key", "c1", "c2"]), "distinct-parts")
    usual, large = one.filter(F.col("members") <= most_stretches), one.filter(F.col("members") > most_stretches)
    size = usual.agg(F.sum(F.octet_length("bytes").cast("long"))).first()[0] or 0
    shards = max(1, min(-(-size // shard_bytes), 1 << 20))
    ordered = usual.repartition(int(shards), "key").sortWithinPartitions("key")
    sorted_out = ordered.mapInArrow(_sort_shards(length, shard_bytes, memory_bytes), _FOUND_SCHEMA)
    found = whole.unionByName(sorted_out)
    if not large.isEmpty():
        found = found.unionByName(_count_strings(large, length))
    found = stored(found, "found")
    spans = found.groupBy("c1", "c2").agg(F.flatten(F.collect_list("spans")).alias("spans"))  # of one stretch
    placed = places.select("t1", "t2", "start", "c1", "c2").distinct().join(stored(spans, "spans"), ["c1", "c2"])
    moved = F.transform("spans", lambda s: F.array(s[0] + F.col("start"), s[1] + F.col("start")))
    return placed.select("t1", "t2", moved.alias("spans")).groupBy("t1", "t2").agg(
        F.flatten(F.collect_list("spans")).alias("spans")  # of one text
    )


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, with_text: bool = False, passage_words: int | None = None, **options
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256, the
    remaining bytes as ``kept`` if ``with_text``, and, if ``passage_words``, ``repeats_passage``: whether so many words in
    a row are in another row as well, removed or not.

    A byte goes if a string of ``length`` bytes that covers it also starts anywhere else, in the same text or
    another, as the texts were given. Null counts as empty; texts shorter than ``length`` lose nothing;
    copies, repeated rows and rows without id are texts like others, so all of a text that occurs twice goes. An
    empty table gives an empty result; further columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(
        F.col("doc_id").cast("long"),
        text.alias("text"),
        F.xxhash64(F.lit(1), text).alias("t1"),
        F.xxhash64(F.lit(2), text).alias("t2"),
    )
    passage = shared_passages(texts.select("t1", "text"), passage_words) if passage_words else None
    spans = repeated_spans(texts.select("t1", "t2", "text"), length, **options)
    schema = _REMOVED_SCHEMA + (", kept binary" if with_text else "") + (", repeats_passage boolean" if passage_words else "")
    if passage is not None:
        passage = passage.withColumn("repeats_passage", F.lit(True))
        here = F.coalesce("repeats_passage", F.lit(False))
        spans = spans.join(passage, "t1", "left").withColumn("repeats_passage", here)
    spans = stored(spans, "text-spans")
    touched = _semi(texts, spans).join(spans, ["t1", "t2"]).drop("t1", "t2")
    raw = F.col("text").cast("binary")
    rest = texts if with_text else texts.select(
        "doc_id", "t1", "t2", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(raw, 256).alias("kept_sha256")
    )
    rest = rest.join(spans.select("t1", "t2"), ["t1", "t2"], "left_anti")
    if with_text:
        rest = rest.withColumns(
            {"n_bytes": F.octet_length("text").cast("long"), "kept_sha256": F.sha2(raw, 256), "kept": raw}
        )
    if passage is not None:
        rest = rest.join(passage, "t1", "left").withColumn("repeats_passage", here)
    zero = F.lit(0).cast("long")
    rest = rest.withColumn("n_removed", zero).withColumn("n_spans", zero)
    touched = touched.mapInArrow(_remove(with_text, passage is not None), schema)
    return touched.unionByName(rest.select(*touched.columns))
