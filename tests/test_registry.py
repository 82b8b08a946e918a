"""Detectors, rule types and keys of a user's own, through batch, replay and stream."""

import pytest
from pyspark.sql import functions as F

from burstguard.functions import keys
from burstguard.operators import registry
from burstguard.operators.detect import detect
from burstguard.operators.match import match_rules
from burstguard.operators.rules import lint_rules, rules_frame
from burstguard.sources.decode import decode_rules
from burstguard.streaming.arrival import replay_matches
from burstguard.streaming.detection import detect_stream
from burstguard.streaming.rulebook import detect_live
from test_rulebook import files, run_to
from test_streaming import event_frame

T0 = 1_700_000_000_000


def device_counter():
    """A detector as a user writes it; nested, so that it travels to workers that cannot import this file."""

    def many_devices(events, window_ms, threshold):
        """The earliest events that end a span with so many different devices."""
        for end in range(len(events)):
            near = [e for e in events[: end + 1] if events[end]["timestamp"] - e["timestamp"] <= window_ms]
            if len({e["deviceId"] for e in near if e["deviceId"]}) >= threshold:
                return near
        return None

    return many_devices


@pytest.fixture
def own(monkeypatch):
    monkeypatch.setattr(registry, "RULE_TYPES", dict(registry.RULE_TYPES))
    monkeypatch.setattr(registry, "FINDERS", {})
    monkeypatch.setattr(keys, "OTHER_KEYS", {})
    registry.register_detector("many-devices", device_counter())
    registry.register_rule_type("DEVICE_HOPPING", registry.RuleType("many-devices", ("LOGIN", "VIEW")))
    registry.register_rule_type(
        "CART_THEN_REFUND",
        registry.RuleType("pair", ("ADD_CART", "REFUND"), lambda a: F.when(a == "ADD_CART", "first").otherwise("second")),
    )
    registry.register_group_key("BY_SUBNET", lambda: F.regexp_replace("ip", r"\.\d+$", ""))


RULES = [
    {"ruleId": "hop", "ruleType": "DEVICE_HOPPING", "targetActionType": "LOGIN", "windowSizeMs": 10_000, "threshold": 3,
     "groupKeyType": "BY_SUBNET"},
    {"ruleId": "refund", "ruleType": "CART_THEN_REFUND", "targetActionType": "REFUND", "windowSizeMs": 10_000, "threshold": 2},
]


def events(spark):
    rows = [
        (0, "u1", "LOGIN", "10.0.0.1", 0, "a"), (1, "u2", "VIEW", "10.0.0.2", 2, "b"), (2, "u3", "LOGIN", "10.0.1.1", 3, "c"),
        (3, "u1", "VIEW", "10.0.0.3", 6, "a"), (4, "u4", "LOGIN", "10.0.0.4", 9, "c"), (5, "u5", "LOGIN", "10.0.0.5", 10, "d"),
        (6, "u1", "ADD_CART", "10.9.0.1", 11, None), (7, "u1", "REFUND", "10.8.0.1", 15, None), (8, "u1", "REFUND", "10.8.0.1", 16, None),
        (9, "u2", "VIEW", "10.0.0.2", 40, "b"),
    ]
    listed = [{"seq": s, "userId": u, "actionType": a, "ip": ip, "timestamp": T0 + t * 1000, "deviceId": d, "amount": None}
              for s, u, a, ip, t, d in rows]
    return event_frame(spark, listed)


EXPECTED = [("hop:10.0.0", "u1", [0, 1, 3, 4]), ("refund:u1", "u1", [6, 7])]


def found(rows):
    return sorted((r["groupKey"], r["userId"], list(r["eventSeqs"])) for r in rows.collect())


def test_batch_replay_and_lint(spark, own):
    rules = rules_frame(spark, RULES)
    assert found(detect(events(spark).orderBy(F.rand(3)), rules)) == EXPECTED
    assert found(replay_matches(match_rules(events(spark), rules))) == EXPECTED
    assert lint_rules(rules).count() == 0


def test_stream_and_live_rules(spark, own, tmp_path):
    rules = rules_frame(spark, RULES)
    cuts = [0, 4, 7, 100]
    stream = files(spark, events(spark), tmp_path / "e", cuts)
    run_to(detect_stream(stream, rules), "own_stream", tmp_path / "cp")
    assert found(spark.table("own_stream")) == EXPECTED
    log = rules.withColumn("seq", F.lit(-1).cast("long"))
    changes = files(spark, log, tmp_path / "r", [-5, 0]).withColumn("arrivedAt", F.col("seq"))
    run_to(detect_live(stream.withColumn("arrivedAt", F.col("seq")), changes, shards=2), "own_live", tmp_path / "cp2")
    assert found(spark.table("own_live")) == EXPECTED


def test_documents_of_registered_rules(spark, own):
    text = '{"ruleId":"h","ruleType":"DEVICE_HOPPING","targetActionType":"x","windowSizeMs":1,"threshold":1,"groupKeyType":"BY_SUBNET"}'
    row = decode_rules(spark.createDataFrame([(text,)], "value string")).first()
    assert (row["ruleType"], row["groupKeyType"]) == ("DEVICE_HOPPING", "BY_SUBNET")


def test_mistakes_are_refused(own):
    with pytest.raises(ValueError):
        registry.register_detector("count", device_counter())
    with pytest.raises(ValueError):
        registry.register_rule_type("X", registry.RuleType("no-such"))


def test_unregistered_types_stay_unknown(spark):
    text = '{"ruleId":"h","ruleType":"DEVICE_HOPPING","targetActionType":"x","windowSizeMs":1,"threshold":1,"groupKeyType":"BY_SUBNET"}'
    row = decode_rules(spark.createDataFrame([(text,)], "value string")).first()
    assert (row["ruleType"], row["groupKeyType"]) == (None, None)
