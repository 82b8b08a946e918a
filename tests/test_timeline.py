"""The incremental machine of one key against the plain one, and what an arrival costs."""

import random

import pytest
from plain_machine import run

from burstguard.streaming.timeline import KeyBuffer

T0 = 1_700_000_000_000
ACTIONS = {
    "count": ["LOGIN_FAIL"],
    "pair": ["LOGIN", "LOGIN_SUCCESS", "CHANGE_PASSWORD", "WITHDRAW"],
    "pay": ["LOGIN", "LOGIN", "PAYMENT", "PAYMENT", "PAYMENT", "PAYMENT_FRAUD"],
}


def role(detector, e):
    action = e["actionType"]
    if detector == "count":
        return "hit"
    if detector == "pair":
        return "first" if action.startswith("LOGIN") else "second"
    if action == "LOGIN":
        return "login"
    if action == "PAYMENT_FRAUD" or e["amount"] >= 1000:
        return "large"
    return "small" if e["amount"] < 100 else "other"


def events(rng, detector, n, window, disorder):
    t, out = T0, []
    for seq in range(n):
        t += rng.choice([0, 0, 1, 40, 300, window // 3, window, window + 5001])
        late = rng.choice([0, 0, 1, 250, 5000, window, window + 4999, window + 9000]) if rng.random() < disorder else 0
        out.append(
            {"seq": seq, "actionType": rng.choice(ACTIONS[detector]), "timestamp": t - late,
             "ip": rng.choice(["1.1.1.1", "1.1.1.1", "2.2.2.2", "a", "A", None, ""]), "amount": rng.choice([5.0, 50.0, 500.0, 1500.0])}
        )
    return out


def taken(buffer, rows, detector, window, threshold):
    out = []
    for e in rows:
        found = buffer.arrive(e["timestamp"], role(detector, e), e["ip"], e, detector, window, threshold)
        if found:
            out.append([x["seq"] for x in found])
    return out


@pytest.mark.parametrize("detector", list(ACTIONS))
@pytest.mark.parametrize("disorder", [0.0, 0.3, 0.9])
def test_equals_plain_machine(detector, disorder):
    rng = random.Random(f"{detector}{disorder}")
    matches = 0
    for _ in range(400):
        window, threshold = rng.choice([1, 900, 4000, 20000]), rng.randint(1, 4)
        rows = events(rng, detector, rng.randint(2, 60), window, disorder)
        expected = [[e["seq"] for e in m] for m in run(rows, detector, window, threshold)]
        assert taken(KeyBuffer(), rows, detector, window, threshold) == expected
        matches += len(expected)
    assert matches > 60


@pytest.mark.parametrize("detector", list(ACTIONS))
def test_restored_buffers_go_on_as_before(detector):
    """A buffer that is written and read back after every few events, as between micro-batches."""
    rng = random.Random(detector)
    for _ in range(150):
        rows = events(rng, detector, 40, 4000, 0.4)
        buffer, out = KeyBuffer(), []
        for begin in range(0, 40, 5):
            out += taken(buffer, rows[begin : begin + 5], detector, 4000, 2)
            again = KeyBuffer()
            for name in ("newest", "emitted", "arrived", "clean", "shape", "floor"):
                setattr(again, name, getattr(buffer, name))
            for key in sorted(buffer.events):
                again.restore(key, *buffer.events[key])
            buffer = again
        assert out == [[e["seq"] for e in m] for m in run(rows, detector, 4000, 2)]


def test_a_new_rule_version_meets_the_events_that_are_there():
    """Threshold down, then window up: old events count under the new values (the plain machine with changing values)."""
    buffer = KeyBuffer()
    for i in range(4):
        assert buffer.arrive(T0 + i * 1000, "hit", None, i, "count", 10_000, 9) is None
    assert buffer.arrive(T0 + 9_000, "hit", None, 4, "count", 10_000, 3) == [0, 1, 2]
    buffer = KeyBuffer()
    for i in range(4):
        buffer.arrive(T0 + i * 1000, "hit", None, i, "count", 500, 2)
    assert buffer.arrive(T0 + 4_000, "hit", None, 4, "count", 4_000, 5) == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("detector, parts", [("count", ["hit"]), ("pair", ["first", "second"]), ("pay", ["login", "small", "large", "login"])])
def test_a_hundred_thousand_live_events_cost_what_they_displace(detector, parts):
    """One key whose window holds everything and which never matches, nine of ten events in order of time."""
    rng, buffer, n = random.Random(1), KeyBuffer(), 100_000
    for i in range(n):
        late = rng.choice([1, 5, 20]) if i % 10 == 0 else 0
        part = parts[i % len(parts)] if detector != "pair" else "first" if i > n // 2 else "second"
        buffer.arrive(T0 + i - late, part, "1.1.1.1", i, detector, 10**9, 10**6)
    assert len(buffer.events) == n
    assert buffer.looked < 4 * n


def test_a_held_key_is_not_searched_again_and_again():
    """After a match more rows of its time make one that may not end: it is found at once at every arrival."""
    buffer = KeyBuffer()
    assert [buffer.arrive(T0, "hit", None, i, "count", 1000, 2) for i in range(2)] == [None, [0, 1]]
    for i in range(20_000):
        assert buffer.arrive(T0 + i // 4000, "hit", None, i, "count", 1000, 2) is None
    assert buffer.looked < 45_000
    assert buffer.arrive(T0 + 6001, "hit", None, "x", "count", 1000, 2) is not None
