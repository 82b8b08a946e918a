"""Slots, their maps and matches against the plain machine on random sequences."""

import random

import pytest
from plain_machine import run
from pyspark.sql import functions as F

from burstguard.operators.sequence import select_matches

CASES = {
    "count": ["LOGIN_FAIL"],
    "pair": ["LOGIN", "LOGIN_SUCCESS", "CHANGE_PASSWORD", "WITHDRAW"],
    "pay": ["LOGIN", "PAYMENT", "PAYMENT", "PAYMENT", "PAYMENT_FRAUD"],
}


def role_of(detector, e):
    a = e["actionType"]
    if detector == "count":
        return "hit"
    if detector == "pair":
        return "first" if a.startswith("LOGIN") else "second"
    if a == "LOGIN":
        return "login"
    if a == "PAYMENT_FRAUD" or e["amount"] >= 1000:
        return "large"
    return "small" if e["amount"] < 100 else "other"


def make(seed, keys, style):
    rng = random.Random(seed)
    rows, expected, seq = [], [], 0
    for k in range(keys):
        detector = rng.choice(list(CASES))
        n = rng.randint(1, 4)
        w = rng.choice([1000, 4000, 20000])
        key = f"{detector}-{seed}-{k}"
        t, events = 1_700_000_000_000, []
        for _ in range(rng.randint(5, 60)):
            t += {
                "sparse": rng.choice([300, 900, 2500, w, w + 1, w + 5000, w + 5001, 40000]),
                "dense": rng.choice([1, 50, 300, w // 3]),
                "ties": rng.choice([0, 0, 0, 1, 1, 300, w, w + 5000, w + 5001]),
            }[style]
            events.append(
                {
                    "userId": f"u{rng.randint(0, 3)}",
                    "actionType": rng.choice(CASES[detector]),
                    "ip": rng.choice(["10.0.0.1", "10.0.0.2", "A", "a", None, ""]),
                    "deviceId": rng.choice([None, "d1"]),
                    "timestamp": t,
                    "seq": seq,
                    "amount": rng.choice([5.0, 50.0, 50.0, 500.0, 1500.0]),
                }
            )
            seq += 1
        for e in events:
            rows.append((key, detector, e["timestamp"], e["seq"], e["userId"], e["ip"], e["deviceId"], detector,
                         role_of(detector, e), w, n))
        for m in run(events, detector, w, n):
            expected.append((key, detector, m[0]["userId"], m[0]["ip"], m[0]["deviceId"], len(m), m[0]["timestamp"],
                             max(e["timestamp"] for e in m), tuple(e["seq"] for e in m)))
    return rows, sorted(expected, key=str)


SCHEMA = ("groupKey string, ruleId string, timestamp long, seq long, userId string, ip string, deviceId string, "
          "detector string, role string, windowSizeMs long, threshold int")


def collect(df):
    return sorted([tuple(r[:-1]) + (tuple(r[-1]),) for r in df.collect()], key=str)


@pytest.mark.parametrize("slot_reaches, block_slots", [(8, 4096), (1, 1), (1, 3), (2, 2)])
@pytest.mark.parametrize("style", ["sparse", "dense", "ties"])
def test_matches_equal_machine(spark, style, slot_reaches, block_slots):
    rows, expected = make(7 + slot_reaches, 100, style)
    df = spark.createDataFrame(rows, SCHEMA).orderBy(F.rand(1))
    assert len(expected) > 50
    assert collect(select_matches(df, slot_reaches, block_slots)) == expected


def plain_rows(events, key, w, n):
    return [(key, "count", e["timestamp"], e["seq"], "u", "i", None, "count", "hit", w, n) for e in events]


def machine_matches(events, key, w, n):
    return [(key, "count", "u", "i", None, n, m[0]["timestamp"], m[-1]["timestamp"], tuple(e["seq"] for e in m))
            for m in run(events, "count", w, n)]


def test_crowded_milliseconds_at_the_border_of_the_cut(spark):
    """Keys of different thresholds whose milliseconds hold just as many rows as are kept, one fewer, and more, after a
    match, while held, and when a held key is let go."""
    rows, expected, seq = [], [], 0
    rng = random.Random(3)
    for n in (1, 2, 3, 5):
        for crowd in (2 * n - 1, 2 * n, 2 * n + 1, 2 * n + 2, 2 * n + 3, 6 * n):
            for gap in (1, 1000, 6000, 6001, 11000):
                events, t = [], 1_700_000_000_000 + rng.randrange(50_000)
                for _ in range(6):
                    for _ in range(rng.choice([crowd, crowd, 1, n])):
                        events.append({"timestamp": t, "seq": seq, "actionType": "x"})
                        seq += 1
                    t += gap
                key = f"{n}-{crowd}-{gap}"
                rows += plain_rows(events, key, 1000, n)
                expected += machine_matches(events, key, 1000, n)
    df = spark.createDataFrame(rows, SCHEMA).orderBy(F.rand(2))
    for shape in ((8, 4096), (1, 2)):
        assert collect(select_matches(df, *shape)) == sorted(expected, key=str)


def test_long_key_without_gaps(spark):
    """One key of many slots and blocks: what a slot starts in depends on all before it."""
    events, t = [], 1_700_000_000_000
    rng = random.Random(9)
    for seq in range(6000):
        t += rng.choice([0, 0, 1, 200, 350])
        events.append({"timestamp": t, "seq": seq, "actionType": "x"})
    df = spark.createDataFrame(plain_rows(events, "k", 1000, 7), SCHEMA).orderBy(F.rand(4))
    expected = sorted(machine_matches(events, "k", 1000, 7), key=str)
    assert len(expected) > 100
    for shape in ((8, 4096), (1, 4)):
        assert collect(select_matches(df, *shape)) == expected


def test_slots_of_times_before_the_epoch_and_empty_input(spark):
    events = [{"timestamp": t, "seq": i, "actionType": "x"} for i, t in enumerate(range(-30_000, 30_000, 700))]
    df = spark.createDataFrame(plain_rows(events, "k", 3000, 4), SCHEMA)
    starts = [r["firstEventTimestamp"] for r in select_matches(df, 1).collect()]
    assert sorted(starts) == list(range(-30_000, 30_000 - 3 * 700, 4 * 700))
    assert select_matches(df.limit(0)).count() == 0


def test_groups_longer_than_arrow_batches(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    rows, expected = make(21, 40, "ties")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert collect(select_matches(spark.createDataFrame(rows, SCHEMA), 2, 2)) == expected
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_no_job_runs_while_the_plan_is_built(spark):
    rows, _ = make(5, 5, "dense")
    df = spark.createDataFrame(rows, SCHEMA)
    spark.sparkContext.setJobGroup("plan-only", "")
    try:
        select_matches(df)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plan-only")
    finally:
        spark.sparkContext.setJobGroup("", "")
