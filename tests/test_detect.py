"""Known sequences from event to alert."""

import pytest
from pyspark.sql import functions as F

from burstguard.operators.alerts import alert_documents, parse_alerts, stamp_alerts, with_trigger_events
from burstguard.operators.detect import detect
from burstguard.operators.patterns import rule_pattern, times_or_more
from burstguard.operators.rules import rules_frame

T0 = 1_700_000_000_000
STUFFING = {"ruleId": "cs", "ruleName": "stuffing", "ruleType": "CREDENTIAL_STUFFING", "targetActionType": "LOGIN_FAIL",
            "windowSizeMs": 60_000, "threshold": 3, "groupKeyType": "BY_IP"}
BRUSH = {"ruleId": "ob", "ruleType": "ORDER_BRUSH", "targetActionType": "order", "windowSizeMs": 60_000, "threshold": 5}
LOGIN = {"ruleId": "al", "ruleType": "ABNORMAL_LOGIN", "targetActionType": "LOGIN", "windowSizeMs": 8_000, "threshold": 2}
FRAUD = {"ruleId": "pf", "ruleType": "PAYMENT_FRAUD", "targetActionType": "PAYMENT_FRAUD", "windowSizeMs": 60_000,
         "threshold": 3, "severityWeight": 2.5, "scoreThreshold": 2.5}
SCHEMA = ("seq long, userId string, actionType string, ip string, timestamp long, sessionId string, deviceId string, "
          "productId string, amount double, extra string")


def events(spark, rows):
    """Rows of (seconds, action, user, ip, amount)."""
    full = [(i, u, a, ip, None if s is None else T0 + round(s * 1000), None, None, None, amount, None)
            for i, (s, a, u, ip, amount) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def alerts(spark, rows, *rules, **options):
    return detect(events(spark, rows), rules_frame(spark, list(rules)), **options)


def fails(*seconds, ip="9.9.9.9"):
    return [(s, "LOGIN_FAIL", f"user{i + 1}", ip, None) for i, s in enumerate(seconds)]


def test_stuffing(spark):
    found = alerts(spark, fails(0, 10, 20, 30), STUFFING).collect()
    assert len(found) == 1
    a = found[0]
    assert (a["matchCount"], a["userId"], a["level"], a["ip"]) == (3, "user1", "MEDIUM", "9.9.9.9")
    assert (a["firstEventTimestamp"], a["lastEventTimestamp"]) == (T0, T0 + 20_000)
    assert a["riskScore"] == pytest.approx(2.005)
    assert a["message"].startswith("[CREDENTIAL_STUFFING] 检测到异常行为：用户[user1] IP[9.9.9.9]")
    assert a["message"].endswith("内触发规则[stuffing]，匹配事件数：3，阈值：3")


def test_stuffing_outside_window_and_invalid_events(spark):
    assert alerts(spark, fails(0, 120, 240), STUFFING).count() == 0
    bad = [(0, "LOGIN_FAIL", None, "i", None), (1, None, "u", "i", None), (None, "LOGIN_FAIL", "u", "i", None)]
    assert alerts(spark, bad + fails(2, ip="i"), STUFFING).count() == 0


def test_order_brush(spark):
    rows = [(5 * i, "ORDER", "u", "i", None) for i in range(6)]
    a = alerts(spark, rows, BRUSH).collect()
    assert [(x["matchCount"], x["lastEventTimestamp"] - T0) for x in a] == [(5, 20_000)]
    assert a[0]["riskScore"] == pytest.approx(2.0083333)


@pytest.mark.parametrize(
    "gap, count", [(0, 1), (8, 1), (8.001, 0)]
)
def test_abnormal_login_window(spark, gap, count):
    rows = [(0, "LOGIN", "u", "i", None), (gap, "CHANGE_PASSWORD", "u", "i", None), (8.5, "WITHDRAW", "u", "i", None)]
    assert alerts(spark, rows[:2], LOGIN).count() == count


def test_abnormal_login_is_used_up(spark):
    rows = [(0, "LOGIN", "u", "i", None), (1, "CHANGE_PASSWORD", "u", "i", None), (2, "WITHDRAW", "u", "i", None)]
    found = alerts(spark, rows, LOGIN).collect()
    assert [(a["matchCount"], a["lastEventTimestamp"] - T0) for a in found] == [(2, 1000)]


PAYMENTS = [(0, "LOGIN_SUCCESS", "u", "10.0.0.1", None), (2, "PAYMENT", "u", "10.0.0.8", 12.0),
            (5, "PAYMENT", "u", "10.0.0.8", 25.0), (8, "PAYMENT", "u", "10.0.0.8", 36.0),
            (12, "PAYMENT_FRAUD", "u", "10.0.0.8", 1500.0)]


def test_payment_fraud(spark):
    a = alerts(spark, PAYMENTS, FRAUD).collect()
    assert [(x["matchCount"], x["level"], x["ip"]) for x in a] == [(5, "MEDIUM", "10.0.0.1")]
    assert a[0]["riskScore"] == pytest.approx(2.5 * (1 + 5 / 3 + 5 / 60 / 10))
    assert alerts(spark, PAYMENTS[1:], FRAUD).count() == 0
    assert alerts(spark, PAYMENTS, FRAUD, strict_routing=True).count() == 0


def test_gate_drops_the_alert_but_its_events_are_used_up(spark):
    gated = STUFFING | {"scoreThreshold": 99.0}
    assert alerts(spark, fails(0, 10, 20, 30), gated).count() == 0


def test_custom_rule_needs_a_pattern(spark):
    rule = {"ruleId": "x", "ruleType": "CUSTOM", "targetActionType": "VIEW", "windowSizeMs": 10_000, "threshold": 2}
    rows = [(i, "VIEW", "u", "i", None) for i in range(5)]
    assert alerts(spark, rows, rule).count() == 0
    assert rule_pattern(events(spark, rows), rule).count() == 2
    overlapping = times_or_more(events(spark, rows), F.lit(True), 2, 10_000, F.col("userId"), overlapping=True)
    assert overlapping.count() == 4
    with pytest.raises(ValueError):
        rule_pattern(events(spark, rows), rule | {"threshold": 0})


def test_payment_pattern(spark):
    rule = FRAUD | {"threshold": 1}
    large = PAYMENTS[:4] + [(12, "PAYMENT", "u", "10.0.0.8", 1500.0)]
    assert [r["matchCount"] for r in rule_pattern(events(spark, large), rule).collect()] == [5]
    assert rule_pattern(events(spark, PAYMENTS), rule).count() == 0


def test_alert_documents_and_back(spark):
    rows = fails(0, 10, 20)
    found = with_trigger_events(stamp_alerts(alerts(spark, rows, STUFFING), F.lit(T0 + 25_999)), events(spark, rows))
    docs = alert_documents(found)
    assert docs.first()["key"] == "user1"
    parsed = parse_alerts(docs).first()
    assert (parsed["matchCount"], parsed["alertTimestampMs"], parsed["deviceId"]) == (3, T0 + 25_999, "")
    assert parsed["alertTime"].second == (T0 // 1000 + 25) % 60
    events_in = [e["userId"] for e in found.first()["triggerEvents"]]
    assert events_in == ["user1", "user2", "user3"]
    bad = spark.createDataFrame([("no json",), ('{"matchCount":"x","riskScore":-1.5}',)], "value string")
    assert [(r["matchCount"], r["riskScore"]) for r in parse_alerts(bad).collect()] == [(0, 0.0), (0, -1.5)]
