"""The clause grammar against a plain reading of clauses, and held-out accuracy of what is learnt."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from convoy.llm import toxicity as tox
from convoy.llm.toxicity import learn, logistic, score, toxicity
from tests.llm.conftest import prose

INSULTS = {"blarg": 2.0, "snorf": 1.0}


def read_plainly(text):
    """Matches of a text by kind, clause by clause and word by word."""
    found = np.zeros(tox.KINDS)
    classes = {w: s for s, words in tox.CLOSED.items() for w in words.split()}
    for clause in re.split(r"[.!?;:\n]", text):
        negated = said = quoted = modal = aimed = False
        hits = []
        for sign in re.findall(r'[^\W\d_]+|"', clause.lower()):
            kind = classes.get(sign)
            if sign == '"':
                quoted = not quoted
            elif sign in INSULTS:
                hits.append((0, negated + 2 * (said or quoted), INSULTS[sign]))
            elif kind == tox.VIOLENCE and modal:
                hits.append((8, negated + 2 * (said or quoted), tox.THREAT_STRENGTH))
            elif kind == tox.NEGATION:
                negated = not negated
            elif kind == tox.REPORT:
                said = True
            elif kind == tox.TURN:
                negated = said = False
            elif kind == tox.MODAL:
                modal = True
            elif kind == tox.TARGET:
                aimed = True
        for base, mode, weight in hits:
            found[base + 4 * aimed + mode] += weight
    return found


def read_by_grammar(texts, insults=INSULTS):
    data = pa.array(texts)
    closed, table = tox.closed_words(), tox.grammar()
    names = sorted(insults)
    whole = next(tox._pieces(pa.array(names))).words
    order = np.argsort(whole)
    parts = []
    for text in tox._pieces(data):
        strength = tox._strengths(text, whole[order], np.array([insults[names[i]] for i in order]))
        parts.append(tox.matches(text, strength, closed, table))
    return np.concatenate(parts)


def test_every_short_clause_is_read_as_word_by_word():
    words = ["blarg", "kill", "will", "you", "not", "said", "but", '"', "."]
    texts = [" ".join(t) for n in (1, 2, 3, 4) for t in itertools.product(words, repeat=n)]
    got = read_by_grammar(texts)
    for text, row in zip(texts, got):
        assert row.tolist() == read_plainly(text).tolist(), text


def test_long_texts_and_many_clauses():
    rng = random.Random(3)
    words = ["blarg", "Snorf", "KILL", "würde", "wird", "Du", "never", "pas", "dijo", "aber", '"', ".", "\n", "x", "écrit", "ÉCRIT"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([0, 3, 50, 4000]))) for _ in range(60)]
    texts += ["", "“you” blarg…", "blarg" + "x" * 100_000, "not " * 30_001 + "blarg you"]
    got = read_by_grammar(texts)
    for text, row in zip(texts, got):
        assert np.allclose(row, read_plainly(text)), text[:80]


def test_composition_is_one_after_the_other():
    rng = np.random.default_rng(5)
    parts = [tox.negation(), tox.reported(), tox.threat(), tox.target()]
    following, says = tox.grammar()
    for _ in range(300):
        state, states = 0, [0] * 4
        for symbol in rng.choice([1, 2, 3, 4, 5, 6, tox.INSULT, tox.VIOLENCE], 12):
            one = symbol
            for k, t in enumerate(parts):
                one, states[k] = t.out[states[k], one], t.next[states[k], one]
            assert says[state, symbol] == one
            state = following[state, symbol]


def test_regression_finds_the_least_loss():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 4))
    y = (x[:, 0] - 2 * x[:, 1] + rng.normal(size=300) > 0).astype(float)
    r, c = np.nonzero(np.ones_like(x))
    pull, start = np.array([1.0, 1.0, 5.0, 0.1]), np.array([0.0, 0.0, 1.0, 0.0])
    found = logistic((r, c, x[r, c], 300, 4), y, np.ones(300), pull, start)
    p = 1 / (1 + np.exp(-x @ found))
    assert np.abs(x.T @ (p - y) + pull * (found - start)).max() < 1e-4


def corpus(n, seed):
    rng = random.Random(seed)
    bad = ["zorgly", "mubnik", "frepper", "plonkish"]
    rows, labels = [], []
    for i in range(n):
        words = prose(rng, rng.randrange(5, 120)).split()
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        elif rng.random() < 0.2:
            words.insert(0, "never " + rng.choice(bad) + " .")
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_negated_insults(spark):
    rows, labels = corpus(1500, 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity(docs, known).collect()}
    truth = dict(labels)
    held = [r for r in got.values() if r.held_out]
    assert len(held) > 300
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())


def test_accuracy_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.toxic for r in got) / len(got) > 0.92
    assert not any(r.predicted and not r.toxic for r in got)


def test_labels_of_held_out_rows_are_not_learnt(spark):
    rows, labels = corpus(400, 2)
    docs = spark.createDataFrame(rows, "doc_id long, text string").cache()
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    turned = known.withColumn("toxic", F.when(tox.is_held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = sorted(map(tuple, toxicity(docs, known).collect()))
    assert a == sorted(map(tuple, toxicity(docs, turned).collect()))


def test_hard_rows(spark, hard, hard_rows):
    rows, labels = corpus(300, 3)
    train = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels + [(None, 1), (5, None), (6, 7), (99999, 1)], "doc_id long, label int")
    model = learn(train, known)
    got = score(hard, model).collect()
    assert len(got) == len(hard_rows)
    assert all(0 <= r.score <= 1 and r.lang == "xx" and r.label == 7 for r in got)
    by_text = {}
    for r in got:
        assert by_text.setdefault(r.text, r.score) == r.score
    assert by_text[None] == by_text[""]


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, 0), (2, 0)], [(1, 0), (2, 1), (3, None)]])
def test_empty_tables_and_few_labels(spark, empty, hard, labels):
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    assert toxicity(empty.select("doc_id", "text"), known).count() == 0
    assert toxicity(hard.select("doc_id", "text"), known).filter("score between 0 and 1").count() == hard.count()
