"""Hard negatives and whitening against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from convoy.llm import hard_negatives as hn
from convoy.llm.hard_negatives import bounds, dots, hard_negatives, mined
from convoy.llm.hilbert import hilbert_key
from convoy.llm.whitening import centred, whitened

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(n, d, seed, copies=0):
    """Clustered vectors; ties, exact copies, one hot vector, odd rows."""
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.4) for _ in range(d)] for _ in range(4)]
    rows = [(i, [c + rng.gauss(0, 0.15) for c in rng.choice(centres)], rng.randrange(5)) for i in range(n)]
    rows += [(n + i, rows[3][1], rng.randrange(2)) for i in range(copies)]
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [nan] * d, [inf] + [0.0] * (d - 1), [None] + [0.0] * (d - 1), [0.1] * (d + 1)]
    rows += [(10_000 + i, v, 1) for i, v in enumerate(odd)]
    return rows + [(20_000, rows[5][1], None), (None, rows[6][1], 1), rows[0], rows[0], rows[50]]


def sound(rows, d):
    return [r for r in rows if r[1] is not None and len(r[1]) == d and all(c is not None and np.isfinite(c) for c in r[1])]


def by_brute_force(rows, d):
    seen = {(i, (y + 1) % 10 if i % 7 == 0 else y, tuple(np.float32(v))) for i, v, y in sound(rows, d) if None not in (i, y)}
    seen = sorted(seen)
    x = np.floor(256 * np.array([r[2] for r in seen], np.float64)).astype(int).astype(object)
    out = []
    for a, (i, y, _) in enumerate(seen):
        if i % 50:
            continue
        score = x @ x[a]
        order = sorted(range(len(seen)), key=lambda j: (-score[j], seen[j][0]))
        for p in [j for j in order if seen[j][1] == y and seen[j][0] != i][:5]:
            fits = [j for j in order if seen[j][1] != y and 50 * score[p] <= 100 * score[j] <= 95 * score[p]][:3]
            out += [(i, seen[p][0], k + 1, seen[j][0], int(score[p]), int(score[j])) for k, j in enumerate(fits)]
    return sorted(out)


@pytest.mark.parametrize("block_rows,at_once", [(40, 3), (4096, 4096)])
def test_hard_negatives_as_by_brute_force(spark, block_rows, at_once):
    rows = vectors(400, 6, 1, copies=60)
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    table = table.withColumns({c: F.lit(1) for c in ["x", "anchor", "block", "place", "score", "rank", "window"]})
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    table = table.withColumn("label", moved)
    got = hard_negatives(table, F.col("vec_id") % 50 == 0, block_rows=block_rows, at_once=at_once)
    assert sorted(map(tuple, got.collect())) == by_brute_force(rows, 6)


def test_blocks_out_of_reach_are_not_read(spark, monkeypatch):
    """Tight clusters far apart: an anchor's windows reach a part of the blocks only, and the answer stays whole."""
    rng = random.Random(4)
    rows = []
    for i in range(600):
        axis = i % 6
        v = [rng.gauss(0, 0.01) for _ in range(6)]
        v[axis] += 1 + 0.02 * (i % 5)
        rows.append((i, v, i % 5))
    read = []
    scan = hn._scan
    monkeypatch.setattr(hn, "_scan", lambda b, needed, *a: read.append({k: len(v) for k, v in needed.items()}) or scan(b, needed, *a))
    got = mined_in_blocks(spark, rows)
    assert sorted(map(tuple, got)) == by_brute_force(rows, 6)
    pairs = sum(sum(r.values()) for r in read)
    assert pairs < 0.6 * 2 * 12 * 30


def mined_in_blocks(spark, rows):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    table = spark.createDataFrame(rows, SCHEMA).withColumn("label", moved)
    return hard_negatives(table, F.col("vec_id") % 50 == 0, block_rows=20).collect()


def test_negative_scores_and_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mined(empty).count() == 0
    rows = [(0, [-1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.0, 1.0], 2), (50, [0.0, 0.0], 1)]
    assert sorted(map(tuple, mined(spark.createDataFrame(rows, SCHEMA)).collect())) == by_brute_force(rows, 2)


def test_exact_products_of_great_numbers():
    a = np.array([[2**40, 1], [2**26, -1]])
    x = np.array([[2**20, 3], [2**22, 5]])
    assert dots(a, x).tolist() == [[2**60 + 3, 2**62 + 5], [2**46 - 3, 2**48 - 5]]
    assert dots(np.array([[2**50]]), np.array([[2**50]])).tolist() == [[2**63 - 1]]


def test_bounds_hold(spark):
    rng = np.random.default_rng(1)
    x, a = rng.integers(-300, 300, (500, 9)), rng.integers(-300, 300, (40, 9))
    low, high = bounds(a, x.min(axis=0)[None], x.max(axis=0)[None])
    assert (a @ x.T >= low).all() and (a @ x.T <= high).all()


@pytest.mark.parametrize("axes,bits", [(2, 4), (3, 3), (5, 2)])
def test_the_curve_visits_every_cell_and_neighbours_follow(axes, bits):
    cells = np.stack(np.meshgrid(*[np.arange(2**bits)] * axes), -1).reshape(-1, axes)
    key = hilbert_key(cells, bits)
    assert sorted(key) == list(range(len(cells)))
    ordered = cells[np.argsort(key)]
    assert (np.abs(np.diff(ordered, axis=0)).sum(axis=1) == 1).all()


def whitened_by_brute_force(rows, d):
    kept = sound(rows, d)
    x = np.floor(64 * np.array([np.float32(r[1]) for r in kept], np.float64)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = fit - s / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1], v[:, ::-1]
    return kept, n, ((n * x - s) ** 2).sum(axis=1), (x - s / n) @ v / np.sqrt(np.maximum(e, 1e-300)), e / e.sum()


@pytest.mark.parametrize("d,flat_dimensions", [(5, 0), (24, 0), (9, 3)])
def test_whitening_as_by_brute_force(spark, d, flat_dimensions):
    rng = random.Random(d)
    rows = vectors(300, d, d, copies=100)
    scale = [rng.choice([0.5, 1, 4, 9]) * (1 + i) for i in range(d)]

    def shaped(v):
        if v is None or len(v) != d or None in v:
            return v
        v = [c * s for c, s in zip(v, scale)]
        return v[: d - flat_dimensions] + [0.25] * flat_dimensions

    rows = [(i, shaped(v), y) for i, v, y in rows]
    odd = rows[400:406]  # a flat tail must not heal a broken vector
    rows = [r for r in rows if r not in odd] + vectors(0 + 51, d, 1)[51:56]
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    table = table.withColumns({c: F.lit(1) for c in ["x", "n", "component", "total", "i"]})
    got = whitened(table).collect()
    kept, n, deviation, z, explained = whitened_by_brute_force(rows, d)
    k = min(16, d - flat_dimensions)
    assert len(got) == len(kept) * k
    assert {r.n for r in got} == {n}
    assert all(r.identity_error < 1e-9 for r in got)
    assert all(abs(r.explained - explained[r.component - 1]) < 1e-9 for r in got)
    want = sorted((i if i is not None else -1, c + 1, int(dv), abs(zz[c])) for (i, _, _), dv, zz in zip(kept, deviation, z) for c in range(k))
    have = sorted((r.vec_id if r.vec_id is not None else -1, r.component, r.deviation, abs(r.whitened)) for r in got)
    for w, h in zip(want, have):
        assert w[:3] == h[:3] and abs(w[3] - h[3]) < 1e-6
    signs = {}
    for r in got:
        if r.vec_id is not None and abs(r.whitened) > 1e-3:
            i = [j for j, kr in enumerate(kept) if kr[0] == r.vec_id][0]
            signs.setdefault(r.component, set()).add(np.sign(r.whitened) * np.sign(z[i, r.component - 1]))
    assert all(len(s) == 1 for s in signs.values())


def test_whitening_of_nothing(spark):
    assert whitened(spark.createDataFrame([], SCHEMA)).count() == 0
    one = spark.createDataFrame([(1, [0.5, 1.0], 1), (2, [0.5, 1.0], 1), (3, None, 2)], SCHEMA)
    assert whitened(one).count() == 0
    two = spark.createDataFrame([(1, [0.0, 0.0], 1), (2, [1.0, 1.0], 1), (3, [1e38, float("inf")], 1)], SCHEMA)
    assert sorted((r.vec_id, r.component, round(abs(r.whitened), 9), r.deviation) for r in whitened(two).collect()) == [
        (1, 1, 1.0, 8192),
        (2, 1, 1.0, 8192),
    ]


def test_centred_rows_keep_their_digits():
    x = np.array([[10**12 + 1, 5]])
    assert np.abs(centred(x, 3, [3 * 10**12 + 1, 16]) - [[2 / 3, -1 / 3]]).max() < 1e-15
