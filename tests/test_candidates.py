"""Candidates of sub-slots against a look at all rows of a key, and how one window's rows are spread."""

import random

import pytest
from pyspark.sql import functions as F

from burstguard.operators.candidates import count_candidates, pair_candidates, payment_candidates

SCHEMA = "k string, seq long, timestamp long, role string, ip string"


def made(seed, n, roles):
    rng = random.Random(seed)
    t, rows = -40_000, []
    for seq in range(n):
        t += rng.choice([0, 0, 1, 7, 40, 300, 3000])
        rows.append((rng.choice("aab"), seq, t, rng.choice(roles), rng.choice(["1.1", "1.1", "2.2", "x", "X", None, ""])))
    return rows


def before(rows, i, window):
    """Rows of the key up to i, in order, inside the window."""
    return [r for r in rows[:i] if r[0] == rows[i][0] and rows[i][2] - r[2] <= window]


def got(df, *columns):
    return sorted(tuple(r) for r in df.select("seq", *columns).collect())


@pytest.mark.parametrize("window", [1, 20, 33, 1000, 9999])
@pytest.mark.parametrize("threshold", [1, 2, 5])
def test_counts(spark, window, threshold):
    rows = made(window + threshold, 400, ["hit"])
    df = spark.createDataFrame(rows, SCHEMA).orderBy(F.rand(1))
    expected = []
    for i, r in enumerate(rows):
        near = [*before(rows, i, window), r]
        if len(near) >= threshold:
            expected.append((r[1], near[-threshold][2]))
    assert got(count_candidates(df, "k", threshold, window), "firstTimestamp") == sorted(expected)


@pytest.mark.parametrize("window", [1, 33, 1000, 9999])
def test_pairs(spark, window):
    rows = made(window, 400, ["first", "second", "second", "second"])
    df = spark.createDataFrame(rows, SCHEMA).orderBy(F.rand(1))
    expected = []
    for i, r in enumerate(rows):
        firsts = [x for x in before(rows, i, window) if x[3] == "first"]
        if r[3] == "second" and firsts:
            expected.append((r[1], firsts[-1][2]))
    assert got(pair_candidates(df, "k", window), "firstTimestamp") == sorted(expected)


@pytest.mark.parametrize("window, threshold", [(1, 1), (33, 1), (1000, 2), (9999, 3), (9999, 9)])
def test_payments(spark, window, threshold):
    rows = made(window + threshold, 500, ["login", "small", "small", "small", "large", "other"])
    df = spark.createDataFrame(rows, SCHEMA).orderBy(F.rand(1))
    expected = []
    for i, r in enumerate(rows):
        near = before(rows, i, window)
        smalls = [x for x in near if x[3] == "small"]
        logins = [x for x in near if x[3] == "login" and x[4] and r[4] and x[4].lower() != r[4].lower()]
        if r[3] == "large" and len(smalls) >= threshold and logins:
            expected.append((r[1], len(smalls), logins[-1][2]))
    assert got(payment_candidates(df, "k", threshold, window), "smallPayments", "loginTimestamp") == sorted(expected)


def test_one_window_of_one_key_is_spread(spark):
    """A hundred thousand rows of one key inside one window: no task sorts more than a small share of them."""
    df = spark.range(100_000).select(F.lit("k").alias("k"), F.col("id").alias("seq"), (F.col("id") / 2).cast("long").alias("timestamp"))
    found = count_candidates(df, "k", 4, 64_000)
    assert found.count() == 100_000 - 3
    subs = df.groupBy(F.floor(F.col("timestamp") / 2000)).count().agg(F.max("count")).first()[0]
    plan = found._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.split("\n") if "hashpartitioning" in line]
    assert subs <= 4000 and dealt and all("_sub" in line or "_group" in line for line in dealt)


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert count_candidates(df, "k", 3, 10).count() == pair_candidates(df, "k", 10).count() == payment_candidates(df, "k", 1, 10).count() == 0
