"""The operators against brute force over random rows with many ties, nulls and hot keys."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from convoy.operators import asof_join, latest_by, with_previous

START = datetime(2026, 1, 1)


def minutes(n):
    return None if n is None else START + timedelta(minutes=n)


def random_rows(seed, n, keys=3, span=400, nulls=True):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # Key 0 holds about half of the rows.
        key = 0 if rng.random() < 0.5 else rng.randrange(keys)
        time = rng.randrange(span)
        if nulls and rng.random() < 0.05:
            time = None
        rows.append((None if nulls and rng.random() < 0.05 else f"k{key}", minutes(time), i))
    return rows


# --- latest_by ---------------------------------------------------------------


def test_latest_by_takes_the_newest_and_breaks_ties(frame):
    rows = frame(
        "id string, load timestamp, a string, b int",
        ("x", "2026-01-01 10:00:00", "p", 1),
        ("x", "2026-01-01 11:00:00", "p", 2),
        ("x", "2026-01-01 11:00:00", "q", 1),
        ("y", "2026-01-01 11:00:00", None, None),
    )
    found = {r.id: (r.a, r.b) for r in latest_by(rows, ["id"], ["load"]).collect()}
    assert found == {"x": ("q", 1), "y": (None, None)}


def test_latest_by_ranks_an_unknown_value_as_newest(frame):
    rows = frame("id string, load timestamp, a int", ("x", "2026-01-01 10:00:00", 1), ("x", None, 2))
    assert latest_by(rows, ["id"], ["load"]).first().a == 2


def test_latest_by_combines_before_the_shuffle(frame):
    rows = frame("id string, load timestamp", ("x", "2026-01-01 10:00:00"))
    plan = latest_by(rows, ["id"], ["load"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") > plan.index("Exchange")


# --- as-of join --------------------------------------------------------------


def brute_asof(left, right):
    answer = {}
    for key, time, i in left:
        candidates = [
            (t, v) for k, t, v in right if k == key and None not in (k, t, time) and t <= time
        ]
        answer[i] = max(candidates)[1] if candidates else None
    return answer


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("segments", [("HOUR", "MINUTE"), ("DAY",), ("MONTH", "DAY", "HOUR")])
def test_asof_join_equals_brute_force(spark, seed, segments):
    left = random_rows(seed, 150)
    right = [(k, t, f"d{i % 7}") for k, t, i in random_rows(seed + 100, 60)]
    joined = asof_join(
        spark.createDataFrame(left, "key string, time timestamp, i int"),
        spark.createDataFrame(right, "key string, since timestamp, driver string"),
        "key",
        "time",
        "since",
        ["driver"],
        segments,
    )
    assert joined.columns == ["key", "time", "i", "driver"]
    rows = joined.collect()
    assert len(rows) == len(left)
    assert {r.i: r.driver for r in rows} == brute_asof(left, right)


def test_asof_join_with_a_hot_instant(spark):
    left = [("k", minutes(90), i) for i in range(300)] + [("k", minutes(1), 300)]
    right = [("k", minutes(5), "early")] * 50 + [("k", minutes(60), "late")] * 50
    joined = asof_join(
        spark.createDataFrame(left, "key string, time timestamp, i int"),
        spark.createDataFrame(right, "key string, since timestamp, driver string"),
        "key",
        "time",
        "since",
        ["driver"],
    )
    found = {r.i: r.driver for r in joined.collect()}
    assert len(found) == 301 and found[300] is None
    assert {found[i] for i in range(300)} == {"late"}


def test_asof_join_keeps_a_null_value_of_the_match(spark):
    left = spark.createDataFrame([("k", minutes(9))], "key string, time timestamp")
    right = spark.createDataFrame(
        [("k", minutes(1), "a", 1), ("k", minutes(5), None, 2)],
        "key string, since timestamp, driver string, n int",
    )
    row = asof_join(left, right, "key", "time", "since", ["driver", "n"]).first()
    assert (row.driver, row.n) == (None, 2)


def test_asof_join_without_right_rows(spark):
    left = spark.createDataFrame(random_rows(1, 20), "key string, time timestamp, i int")
    right = spark.createDataFrame([], "key string, since timestamp, driver string")
    rows = asof_join(left, right, "key", "time", "since", ["driver"]).collect()
    assert len(rows) == 20 and {r.driver for r in rows} == {None}


# --- previous row ------------------------------------------------------------



CUTS = {
    "hours": [F.date_trunc, "HOUR"],
    "hours and minutes": [F.date_trunc, "HOUR", "MINUTE"],
    "days, hours and minutes": [F.date_trunc, "DAY", "HOUR", "MINUTE"],
}


def previous(df, cuts="hours and minutes", distinct=False):
    trunc, *units = CUTS[cuts]
    segments = [trunc(unit, "time") for unit in units]
    return with_previous(df, ["key"], ["time", "i"], ["time", "i"], segments, distinct)


def lagged(df):
    w = Window.partitionBy("key").orderBy(F.asc_nulls_first("time"), F.asc_nulls_first("i"))
    return df.withColumns({"prev_time": F.lag("time").over(w), "prev_i": F.lag("i").over(w)})


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("cuts", list(CUTS))
def test_previous_equals_lag(spark, seed, cuts):
    df = spark.createDataFrame(random_rows(seed, 200), "key string, time timestamp, i int")
    want = sorted(map(str, lagged(df).collect()))
    assert sorted(map(str, previous(df, cuts).collect())) == want
    unlike = df.distinct()
    want = sorted(map(str, lagged(unlike).collect()))
    assert sorted(map(str, previous(unlike, cuts, distinct=True).collect())) == want


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("cuts", list(CUTS))
def test_previous_with_crowded_segments(spark, seed, cuts):
    base = random_rows(seed, 120, span=130)
    rows = base + [("k0", minutes(30), i) for i in range(40)] + [("k0", minutes(31), 7)] * 25
    df = spark.createDataFrame(rows, "key string, time timestamp, i int")
    assert sorted(map(str, previous(df, cuts).collect())) == sorted(map(str, lagged(df).collect()))


def test_previous_of_one_row_and_of_none(spark):
    schema = "key string, time timestamp, i int"
    for distinct in (True, False):
        one = previous(spark.createDataFrame([("a", START, 1)], schema), distinct=distinct)
        assert one.first().prev_i is None
        assert previous(spark.createDataFrame([], schema), distinct=distinct).count() == 0


def test_building_a_query_starts_no_job(spark):
    left = spark.createDataFrame(random_rows(1, 10), "key string, time timestamp, i int")
    right = left.select("key", F.col("time").alias("since"), F.lit("d").alias("driver"))
    spark.sparkContext.setJobGroup("building", "no job may start")
    previous(left)
    asof_join(left, right, "key", "time", "since", ["driver"])
    started = spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    spark.sparkContext.setJobGroup("tests", "")
    assert list(started) == []


def test_previous_spreads_a_key_over_segments(spark):
    df = spark.createDataFrame(random_rows(1, 10), "key string, time timestamp, i int")
    plan = previous(df)._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning(key" in line]
    # The exchange of the rows is by key and segment; only segment edges move by key alone.
    assert any("_segment0" in line for line in wide)
