"""Documents in, alerts out."""

import json

import pytest

from burstguard.plans.pipeline import alerts_from_documents

T0 = 1_700_000_000_000
RULES = [
    {"ruleId": "cs", "ruleType": "CREDENTIAL_STUFFING", "targetActionType": "LOGIN_FAIL", "windowSizeMs": 60000,
     "threshold": 3, "groupKeyType": "BY_IP", "version": 1},
    {"ruleId": "ob", "ruleType": "ORDER_BRUSH", "targetActionType": "ORDER", "windowSizeMs": 60000, "threshold": 5,
     "version": 1},
    {"ruleId": "off", "ruleType": "HIGH_FREQ_ACCESS", "targetActionType": "ORDER", "windowSizeMs": 60000,
     "threshold": 1, "version": 1, "status": "DISABLED"},
]


def documents(spark, docs, first):
    return spark.createDataFrame([(first + i, json.dumps(d)) for i, d in enumerate(docs)], "seq long, value string")


def events():
    fails = [{"userId": f"u{i}", "actionType": "login_fail", "ip": "1.1.1.1", "timestamp": T0 + 10_000 * i} for i in range(4)]
    orders = [{"userId": "u9", "actionType": "ORDER", "ip": "2.2.2.2", "timestamp": T0 + 5_000 * i} for i in range(6)]
    return fails + orders + [{"userId": "u9"}, {"actionType": "ORDER", "timestamp": 1}]


@pytest.mark.parametrize("mode", ["event_time", "arrival"])
def test_documents_to_alerts(spark, mode):
    alerts = alerts_from_documents(
        documents(spark, events(), 0), documents(spark, RULES, -10), mode=mode, evidence=mode == "event_time"
    ).collect()
    got = sorted((a["ruleId"], a["userId"], a["matchCount"], len(a["triggerEvents"])) for a in alerts)
    assert got == [("cs", "u0", 3, 3), ("ob", "u9", 5, 5)]


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        alerts_from_documents(documents(spark, events(), 0), documents(spark, RULES, -10), mode="other")
