"""Exact and near duplicates, and repeated strings, against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from convoy.llm import induced
from convoy.llm.bbit_minhash import near_duplicates
from convoy.llm.components import components
from convoy.llm.naming import exact_duplicates
from convoy.llm.queries import QUERIES
from convoy.llm.suffix_dedup import remove_repeats
from tests.llm.conftest import LOWER, null_first, prose


def exact_by_hand(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").encode().translate(LOWER)].append(i)
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        for i in ids:
            yield i, keep, len(ids), i == keep, hashlib.sha256(text).hexdigest()


@pytest.mark.parametrize("block", [4096, 64])
def test_exact_duplicates(hard, hard_rows, block):
    got = exact_duplicates(hard.select("doc_id", "text", "row", "keys", "name"), block_bytes=block)
    assert null_first(map(tuple, got.collect())) == null_first(exact_by_hand(hard_rows))


def test_exact_duplicates_of_texts_that_differ_in_one_byte(spark):
    rng = random.Random(3)
    text = prose(rng, 3000)
    rows = [(i, text[:i] + "#" + text[i + 1 :]) for i in range(0, 9000, 500)] * 1 + [(9, text), (8, text), (7, text + " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, exact_duplicates(docs, block_bytes=512).collect()))
    assert got == sorted(exact_by_hand(rows))


def shingles(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def near_by_hand(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    of = list(range(len(sets)))

    def root(x):
        while of[x] != x:
            x = of[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and 100 * len(a & b) >= 75 * len(a | b):
                of[root(x)] = root(y)
    least = {}
    for x, (i, _) in enumerate(sets):
        if i is not None:
            least[root(x)] = min(i, least.get(root(x), i))
    for x, (i, s) in enumerate(sets):
        component = least.get(root(x)) if s else i
        yield i, len(s), component, i == component


def test_near_duplicates(hard, hard_rows):
    got = near_duplicates(hard)
    assert null_first(map(tuple, got.collect())) == null_first(near_by_hand(hard_rows))


def test_near_duplicates_of_a_crowd(spark):
    """A chain of edits, a crowd around one text, and a crowd just below the threshold."""
    rng = random.Random(8)
    rows, text = [], prose(rng, 120, 10_000).split()
    for i in range(60):
        rows.append((i, " ".join(text)))
        text[rng.randrange(120)] = f"e{i}"
    base = prose(rng, 200, 10_000).split()
    for i in range(150):
        own = list(base)
        for _ in range(rng.choice((1, 3, 8, 12))):
            own[rng.randrange(200)] = f"f{rng.randrange(10**6)}"
        rows.append((100 + i, " ".join(own)))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect())) == sorted(near_by_hand(rows))


def test_near_duplicates_of_short_documents(spark):
    """Pairs of 7 to 20 words, each with words of its own, at 0.75 to 0.8."""
    rows = []
    for i in range(150):
        for n, more in ((7, 1), (8, 1), (10, 2), (13, 3), (16, 4), (16, 3)):
            text = [f"p{len(rows)}x{k}" for k in range(n + more)]
            rows += [(len(rows), " ".join(text[:n])), (len(rows) + 1, " ".join(text))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_duplicates(docs).collect()}
    assert [i for i in range(0, len(rows), 2) if got[i + 1] != i] == []


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (300, 200)]
    rng = random.Random(1)
    rng.shuffle(edges)
    df = spark.createDataFrame([e if rng.random() < 0.5 else e[::-1] for e in edges], "u long, v long")
    got = dict(map(tuple, components(df).collect()))
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200: 200, 300: 200}
    assert got == want


def repeats_by_hand(rows, length):
    counts = Counter()
    for _, t in rows:
        b = (t or "").encode()
        counts.update(b[i : i + length] for i in range(len(b) - length + 1))
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        end = 0
        for k in range(len(b) - length + 1):
            if counts[b[k : k + length]] > 1:
                gone[max(k, end) : k + length] = b"\1" * (k + length - max(k, end))
                end = k + length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        yield i, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("options", [{}, {"most_stretches": 1}, {"memory_bytes": 0, "shard_bytes": 1}])
def test_remove_repeats(hard, hard_rows, options):
    rows = [r for r in hard_rows if r[0] != 13]
    got = remove_repeats(hard.filter("doc_id is null or doc_id != 13"), length=100, **options)
    assert null_first(map(tuple, got.collect())) == null_first(repeats_by_hand(rows, 100))


def test_remaining_bytes(spark):
    rng = random.Random(2)
    passage = prose(rng, 100)
    rows = [(1, "begin " + passage + " end"), (2, passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id: bytes(r.kept) for r in remove_repeats(docs, with_text=True).collect()}
    assert kept == {1: b"begin  end", 2: b""}


def passages_by_hand(rows, length):
    found, strings = defaultdict(set), []
    for n, (_, t) in enumerate(rows):
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().translate(LOWER))
        strings.append({tuple(w[i : i + length]) for i in range(len(w) - length + 1)})
        for s in strings[-1]:
            found[s].add(n)
    return [(i, any(len(found[s]) > 1 for s in strings[n])) for n, (i, _) in enumerate(rows)]


@pytest.mark.parametrize("words", [51, 12])
def test_passages_of_other_rows(spark, hard_rows, words):
    """Runs of one word less, as many and more, alone and twice, at the ends and within; once in one row only."""
    rng = random.Random(6)
    rows = [r for r in hard_rows if r[0] != 13]
    for i in range(60):
        size = words + rng.choice((-1, -1, 0, 1, 9, 3 * words))
        run = prose(rng, size, 10**6).split()
        for k in range(rng.choice((2, 2, 5))):
            cut = run[rng.randrange(3) :] if k else run
            before, after = prose(rng, rng.choice((0, 30)), 10**6), prose(rng, rng.choice((0, 90)), 10**6)
            rows.append((len(rows) + 100, f"{before} {' '.join(cut).upper() if k == 3 else ' '.join(cut)}\n {after}"))
    alone = prose(rng, 60, 10**6)
    rows.append((99, f"{alone} between {alone}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = remove_repeats(docs, passage_words=words).select("doc_id", "repeats_passage")
    assert null_first(map(tuple, got.collect())) == null_first(passages_by_hand(rows, words))


def test_query_names_passages_of_over_50_words_below_400_bytes(spark, tmp_path):
    rng = random.Random(7)
    passage = " ".join(f"{rng.randrange(10**4):04}" for _ in range(51))
    rows = [(1, prose(rng, 90) + " " + passage), (2, passage + " " + prose(rng, 90)), (3, prose(rng, 90))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op3_induced_suffixes"](spark, str(tmp_path))
    assert got.columns[:5] == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.repeats_passage) for r in got.collect()}
    assert found == {i: (len(t), 0, i < 3) for i, t in rows}


@pytest.mark.parametrize("listed", [0, induced.LISTED])
def test_suffix_array(tmp_path, monkeypatch, listed):
    monkeypatch.setattr(induced, "LISTED", listed)
    rng = np.random.default_rng(4)
    texts = [rng.integers(1, s, n) for n in (0, 1, 2, 30, 200) for s in (2, 3, 2000)]
    texts += [np.tile(rng.integers(1, 4, 3), 40), np.arange(3000, 0, -1), np.tile(np.arange(1, 1500), 3)]
    for t in texts:
        t = np.r_[t, 0]
        plain = t.tolist()
        want = sorted(range(len(t)), key=lambda i: plain[i:])
        assert induced.suffix_array(t, int(t.max()) + 1).tolist() == want
        assert induced.suffix_array(t, int(t.max()) + 1, str(tmp_path), 5).tolist() == want


def test_empty_tables(empty):
    assert exact_duplicates(empty).count() == 0
    assert near_duplicates(empty).count() == 0
    assert remove_repeats(empty).count() == 0


def test_a_third_of_all_rows_are_copies(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("the very same text of a few words, long enough to be cut " * 10))
        .otherwise(F.concat(F.lit("own "), F.sha2(F.col("id").cast("string"), 512), F.lit(" words")))
        .alias("text"),
    )
    exact = exact_duplicates(docs).groupBy("kept").count().collect()
    assert {r[0]: r[1] for r in exact} == {True: 2001, False: 999}
    near = near_duplicates(docs).filter("component_id = 0").count()
    assert near == 1000


def test_short_strings_of_names_are_ordered_by_ranks(monkeypatch):
    """One induction sorts the substrings, one all suffixes, however often names repeat."""
    rng = np.random.default_rng(5)
    text = np.r_[np.tile(rng.integers(1, 4, 50), 8), rng.integers(1, 4, 300), np.tile([2, 1], 60), 0]
    want = sorted(range(len(text)), key=lambda i: text[i:].tolist())
    calls, induce = [], induced._by_queues
    monkeypatch.setattr(induced, "_by_queues", lambda *a: calls.append(len(a[0])) or induce(*a))
    assert induced.suffix_array(text, 4).tolist() == want
    assert calls == [len(text)] * 2
