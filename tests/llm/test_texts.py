"""Operators that look at one text at a time, against libraries and brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from convoy.llm import pii, queries, wu_manber
from convoy.llm.bpe import encode, encoding_digests
from convoy.llm.latent_quality import learn as learn_quality
from convoy.llm.latent_quality import quality, score
from convoy.llm.ppm_language import language, learn, predict
from convoy.llm.ring import balanced_shards, capacities, virtual_nodes, walk
from convoy.llm.token_counts import token_counts
from tests.llm.conftest import LOWER, null_first, prose


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def odd_texts():
    rng = random.Random(1)
    signs = "ab 'sSΣİé\t\n\x1c\x85 　 1²,.!中\U0001f600​\x00"
    special = ["<|endoftext|>", "<|startoftext|>", "'ll", "don't", "  ", "\n\n", "ΣΣ", "aaaaaaa", " \n "]
    return [
        "".join(rng.choice(special) if rng.random() < 0.1 else rng.choice(signs) for _ in range(rng.randint(0, 50)))
        for _ in range(1500)
    ]


def test_tokens_as_the_library_has_them(spark, hard, hard_rows):
    texts = odd_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs = docs.unionByName(hard.select("doc_id", "text"))
    texts = [*enumerate(texts), *hard_rows]
    plain = [t or "" for _, t in texts]

    library = Tokenizer.from_file(path("byte_bpe_50k.json"))
    counts = [len(e.ids) for e in library.encode_batch(plain, add_special_tokens=False)]
    want = [(i, len(t.encode()), n, n > 1024) for (i, _), t, n in zip(texts, plain, counts)]
    got = token_counts(docs, path("byte_bpe_50k.json")).collect()
    assert null_first(map(tuple, got)) == null_first(want)

    library = Tokenizer.from_file(path("word_bpe_49k.json"))
    ids = [e.ids for e in library.encode_batch(plain, add_special_tokens=False)]
    want = [
        (i, len(x), sha(" ".join(map(str, x))), sha(library.decode(x, skip_special_tokens=False)))
        for (i, _), x in zip(texts, ids)
    ]
    got = encoding_digests(docs, path("word_bpe_49k.json")).collect()
    assert null_first(map(tuple, got)) == null_first(want)


def test_encode_keeps_other_columns(hard, hard_rows):
    done = encode(hard, path("word_bpe_49k.json"))
    assert done.columns == [c for c in hard.columns if c != "__encoded"]
    library = Tokenizer.from_file(path("word_bpe_49k.json"))
    for r in done.collect():
        assert r.encoding.ids == library.encode(r.text or "", add_special_tokens=False).ids
        assert r.encoding.ids_sha256 == sha(" ".join(map(str, r.encoding.ids)))


def word_list(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().translate(LOWER))


def contamination_by_hand(docs, items):
    windows = {}
    for i, t in items:
        w = word_list(t)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(i)
    for d, t in docs:
        w, hit, found = word_list(t), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    found |= windows[tuple(w[k : k + n])]
                    hit |= set(range(k, k + n))
        names = ",".join(sorted(map(str, found)))
        yield d, len(w), len(hit), len(found), sha(names), len(hit) > 0 and 20 * len(hit) >= len(w)


@pytest.mark.parametrize("most", [wu_manber.BROADCAST_BYTES, 3000])
def test_contamination(spark, hard, hard_rows, monkeypatch, most):
    rng = random.Random(2)
    items = [(i, prose(rng, rng.randint(0, 20), 6)) for i in range(20)] + [(90, None), (91, ""), (92, "One")]
    items += [(92, "One"), (93, hard_rows[7][1][:150]), (94, "é" * 900), (None, "one")]
    docs = hard.unionByName(
        spark.createDataFrame([(500 + i, prose(rng, 900, 6)) for i in range(5)], "doc_id long, text string"),
        allowMissingColumns=True,
    )
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    real = wu_manber.item_blocks
    monkeypatch.setattr(wu_manber, "item_blocks", lambda b: real(b, most))
    got = wu_manber.contamination_digests(docs, benchmark)
    want = contamination_by_hand(rows, [i for i in items if i[0] is not None])
    assert null_first(map(tuple, got.collect())) == null_first(want)


def test_no_benchmark(hard, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert wu_manber.contamination_digests(hard, none).filter("n_hit > 0 or contaminated").count() == 0


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def base_by_hand(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    found = [(*m.span(), "email") for m in EMAIL.finditer(text)]
    found += [(*m.span(), "ip") for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    found += [
        (*m.span(), "card") for m in CARD.finditer(text) if 12 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))
    ]
    found += [(*m.span(), "phone") for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(found, key=lambda s: (s[0], pii.KINDS.index(s[2])))


def test_base_spans():
    rng = random.Random(5)
    for _ in range(30_000):
        text = "".join(rng.choice("0123456789.1.2-+ ()@aZ_é%٣ ") for _ in range(rng.randint(0, 60)))
        assert pii.base_spans(text) == base_by_hand(text)
    assert pii.luhn("4539578763621486") and not pii.luhn("4539578763621487")


def test_patterns_propose_words_that_break_every_rule(spark):
    """Identifiers that no rule describes, in contexts that seeds have shown; precision on words that only look alike."""
    rng = random.Random(9)
    rows, planted = [], {}
    for i in range(40):
        rows.append((i, f"{prose(rng, 8)} please write to user{i}@mail{i}.org today {prose(rng, 5)}"))
        rows.append((100 + i, f"{prose(rng, 8)} my number is +1 555 010 {1000 + i} {prose(rng, 5)}"))
        word = f"handle{i}(at)host" if i % 2 else f"x{'y' * 300}{i}#host"
        text = f"{prose(rng, 8)} please write to {word} today {prose(rng, 5)}"
        planted[200 + i] = f"email:{text.index(word)}:{text.index(word) + len(word)}"
        rows.append((200 + i, text))
        rows.append((300 + i, f"{prose(rng, 8)} the year {1900 + i} was w{i} good {prose(rng, 5)}"))
    got = {r.doc_id: r.spans for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == span for i, span in planted.items())
    assert all(got[300 + i] == "" for i in range(40))


def test_graph_scores_as_by_hand(spark):
    rng = random.Random(2)
    edges = [
        (f"p{rng.randrange(6)}", f"i{k % 25}", rng.choice(pii.KINDS[:2]) if role < 2 else "", role, rng.randrange(1, 5))
        for k in range(120)
        for role in [rng.choice([0, 0, 1, 2])]
    ]
    edges = [(p, i, k, r, sum(e[4] for e in edges if e[:4] == (p, i, k, r))) for p, i, k, r in sorted({e[:4] for e in edges})]
    sure = Counter()
    different, every = Counter(), Counter()
    for p, _, k, r, n in edges:
        every[p] += n
        if r == 0:
            sure[p, k] += n
            different[p, k] += 1
    good = {key for key in sure if different[key] >= pii.LEAST_SEEDS}
    confidence = {(p, k): sure[p, k] / (every[p] + 1) for p, k in good}
    for _ in range(pii.ROUNDS - 1):
        doubt, holds = {}, []
        for p, i, k, r, n in edges:
            for kind in [k] if r == 1 else pii.KINDS if r == 2 else []:
                if (p, kind) in good:
                    doubt[i, kind] = doubt.get((i, kind), 1.0) * (1 - confidence[p, kind])
                    holds.append((p, i, kind, n))
        believed = Counter()
        for p, i, kind, n in holds:
            believed[p, kind] += n * (1 - doubt[i, kind])
        confidence = {(p, k): (sure[p, k] + believed[p, k]) / (every[p] + 1) for p, k in good}
    table = spark.createDataFrame(edges, "pattern string, instance string, kind string, role int, n long")
    got = {(r.pattern, r.kind): r.confidence for r in pii.scores(table).collect()}
    assert got.keys() == confidence.keys() and len(got) > 3
    assert all(math.isclose(got[key], confidence[key], rel_tol=1e-9) for key in got)


def test_neighbours_cost_no_more_than_the_text():
    text = "1.2.3.4," * 20_000 + " a@b.cd " + "4539578763621486;" * 10_000
    base, found = pii.mentions(text)
    assert len(found) >= len(base) > 20_000


def test_patterns_find_unseen_identifiers(spark, hard, hard_rows):
    rows = [(1000 + i, f"please write to user{i}@mail{i}.example.org today, thanks") for i in range(12)]
    rows += [(2000, "please write to admin@localhost today, thanks"), (2001, "buy admin@localhost now")]
    docs = hard.unionByName(spark.createDataFrame(rows, "doc_id long, text string"), allowMissingColumns=True)
    got = {r.doc_id: r for r in pii.personal_data(docs).filter("doc_id is not null").collect()}
    assert got[2000].spans == "email:16:31" and got[2000].n_email == 0
    assert got[2001].spans == ""
    for i, text in [*hard_rows, *rows]:
        if i is not None and i not in (17, 18):
            base = base_by_hand(text or "")
            shown = ",".join(f"{k}:{a}:{b}" for a, b, k in base)
            assert got[i].base_sha256 == sha(shown)
            assert set(filter(None, shown.split(","))) <= set(got[i].spans.split(","))
            assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(s[2] == k for s in base) for k in pii.KINDS]


def test_quality_of_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    done = queries.QUERIES["op5_latent_quality"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    seen = done.filter("held_out").join(labels, "doc_id").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")))
    assert seen.first()[0] >= 0.95
    assert done.filter("score < 0 or score > 1 or score is null").count() == 0


def test_quality_of_hard_rows(spark, hard, hard_rows):
    labels = spark.createDataFrame([(8, 1), (12, 0), (13, 1), (19, 0), (77, 0), (None, 1), (14, None)], "doc_id long, quality int")
    got = quality(hard, labels)
    assert got.count() == len(hard_rows) and got.filter("score is null or predicted is null").count() == 0
    no_labels = score(hard, learn_quality(hard, labels.limit(0).withColumnRenamed("quality", "label")))
    assert {r.score for r in no_labels.select("score").collect()} == {0.5}


def test_language_of_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    done = queries.QUERIES["op6_ppm_language"](spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    seen = done.filter("held_out").join(docs, "doc_id").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int")))
    assert seen.first()[0] >= 0.97


def test_language_of_hard_rows(hard, hard_rows):
    got = {r.doc_id: r for r in language(hard).filter("doc_id is not null").collect()}
    assert got[1].lang_pred == got[2].lang_pred == got[3].lang_pred == "und"
    assert got[14].lang_pred == "xx" and got[14].score == 1
    assert got[12].lang_pred == "xx"


def test_code_lengths_prefer_the_own_language(spark):
    rows = [("aa", "abab abab abab"), ("bb", "cdcd cdcd cdcd"), (None, "abab"), ("cc", None)]
    tree = learn(spark.createDataFrame(rows, "lang string, text string"))
    assert tree.languages == ["aa", "bb"]
    texts = spark.createDataFrame([("abab",), ("cd cd",), ("",), ("12",)], "text string")
    assert [r.language.lang_pred for r in predict(texts, tree).collect()] == ["aa", "bb", "und", "und"]


def lengths_by_hand(learnt, text):
    """Bits of ``text`` in each language, by the definition."""
    seen = {}
    for lang, t in learnt:
        b = b"   " + t.encode().translate(LOWER)
        for i in range(3, len(b)):
            for k in range(4):
                seen.setdefault(lang, {}).setdefault(b[i - k : i], Counter())[b[i]] += 1
    b = b"   " + text.encode().translate(LOWER)
    found = {}
    for lang, contexts in seen.items():
        chance = 1.0
        for i in range(3, len(b)):
            for k in range(3, -1, -1):
                if c := contexts.get(b[i - k : i]):
                    room = c.total() + len(c)
                    chance *= (c[b[i]] or len(c)) / room
                    if c[b[i]]:
                        break
            else:
                chance /= 256
        found[lang] = -math.log2(chance)
    return found


def test_a_language_with_a_thousandth_of_the_rows(spark):
    """Its strings are rarer than 400,000 of the great language."""
    rng = random.Random(6)
    great = [("aa", "".join(chr(rng.randrange(97, 123)) for _ in range(500))) for _ in range(2000)]
    small = [("bb", "żółć gęślą jaźń")]
    tree = learn(spark.createDataFrame(great + small, "lang string, text string").repartition(4))
    assert tree.languages == ["aa", "bb"]
    texts = spark.createDataFrame([("gęślą jaźń",), ("qxkzjw vbn",)], "text string")
    assert [r.language.lang_pred for r in predict(texts, tree).collect()] == ["bb", "aa"]


@pytest.mark.parametrize("cells", [1 << 20, 20])
def test_code_lengths_by_definition(spark, cells):
    rng = random.Random(9)
    learnt = [(x, prose(rng, 12, 9) + " " + y * rng.randrange(9)) for x in ("aa", "bb", "cc") for y in ("ab", "Éc", "zq")]
    texts = ["w1 w2", "abÉ zqc", "w7 unseen £ 9", "x"]
    tree = learn(spark.createDataFrame(learnt, "lang string, text string"))
    got = predict(spark.createDataFrame([(t,) for t in texts], "text string"), tree, cells=cells).collect()
    for r in got:
        bits = lengths_by_hand(learnt, r.text)
        assert r.language.lang_pred == min(bits, key=lambda x: (bits[x], x))
        assert r.language.score == pytest.approx(1 / sum(2 ** (min(bits.values()) - x) for x in bits.values()), rel=1e-4)


@pytest.mark.parametrize("shards", [1, 8, 9])
def test_shards_are_equally_full(hard, hard_rows, shards):
    got = balanced_shards(hard, shards).collect()
    assert null_first((r.doc_id, r.size) for r in got) == null_first(
        (i, len((t or "").encode()) + 1) for i, t in hard_rows
    )
    sizes = []
    for s in range(shards):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
        sizes.append(len(slots))
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(hard_rows)


def test_a_new_shard_moves_few_rows():
    rng = random.Random(6)
    counts = {c: rng.randrange(200) for c in range(4096)}

    def where(shards):
        return {(c, k): s for c, a, b, s, _ in walk(counts, shards) for k in range(a, b)}

    old, new = where(8), where(9)
    assert sorted(set(new.values())) == list(range(9))
    total = len(old)
    moved = sum(old[k] != new[k] for k in old)
    assert total / 9 <= moved < 0.45 * total  # hashing modulo the number of shards moves 8 of 9
    assert capacities(10, 4) == [3, 3, 2, 2]
    assert len({s for _, s in virtual_nodes(8)}) == 8
    hot = walk({5: 1000, 4000: 1}, 8)
    assert sum(b - a for _, a, b, _, _ in hot) == 1001


def test_empty_tables(empty, spark):
    assert token_counts(empty, path("byte_bpe_50k.json")).count() == 0
    assert encoding_digests(empty, path("word_bpe_49k.json")).count() == 0
    assert language(empty).count() == 0
    assert balanced_shards(empty).count() == 0
    assert pii.personal_data(empty).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality(empty, labels).count() == 0
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert wu_manber.contamination_digests(empty, items).count() == 0


def test_search_of_one_batch():
    compiled = wu_manber.compile_patterns([(1, "a b"), (2, "A, b")], 13)
    assert list(wu_manber.search(pa.array(["x a b a b", None, "a"]), compiled)) == [(5, [[1, 5]], [1, 2]), (0, [], []), (1, [], [])]
