"""The rule changelog against a plain fold, templates and lint."""

import random

import pytest
from pyspark.sql import functions as F

from burstguard.operators.rules import (
    active_rules,
    lint_rules,
    rule_history,
    rule_snapshot,
    rules_frame,
    scope_rules,
    template_rules,
)


def changelog(seed, n):
    rng = random.Random(seed)
    return [
        {
            "ruleId": rng.choice(["a", "b", "c", "", None]),
            "ruleType": rng.choice(["ORDER_BRUSH", "ORDER_BRUSH", None]),
            "status": rng.choice(["ENABLED", "ENABLED", "ENABLED", None, "DISABLED"]),
            "targetActionType": "ORDER",
            "windowSizeMs": rng.choice([0, 1000, 1000]),
            "threshold": rng.choice([1, 2, 3]),
            "version": rng.randint(0, 4),
            "updateTimestamp": seq,
        }
        for seq in range(n)
    ]


def fold(log):
    """State after each change: rule id -> change."""
    held, steps = {}, []
    for c in log:
        if c["ruleId"]:
            if c["status"] == "DISABLED":
                held.pop(c["ruleId"], None)
            elif c["ruleType"] and c["windowSizeMs"] > 0:
                old = held.get(c["ruleId"])
                if old is None or c["version"] > old["version"]:
                    held[c["ruleId"]] = c
        steps.append(dict(held))
    return steps


@pytest.mark.parametrize("seed", range(4))
def test_snapshot_and_history_equal_the_fold(spark, seed):
    log = changelog(seed, 60)
    df = rules_frame(spark, log).withColumn("seq", F.col("updateTimestamp"))
    steps = fold(log)
    got = {r["ruleId"]: r["updateTimestamp"] for r in rule_snapshot(df).collect()}
    assert got == {k: v["updateTimestamp"] for k, v in steps[-1].items()}
    history = rule_history(df).collect()
    for at, state in enumerate(steps):
        then = {
            r["ruleId"]: r["updateTimestamp"]
            for r in history
            if r["validFrom"] <= at and (r["validTo"] is None or at < r["validTo"])
        }
        assert then == {k: v["updateTimestamp"] for k, v in state.items()}, at
    live = {r["ruleId"] for r in active_rules(df).collect()}
    assert live == {k for k, v in steps[-1].items() if v["status"] == "ENABLED"}


def test_templates(spark):
    rules = {r["ruleId"]: r for r in template_rules(spark, "mkechinov", 3, 7).collect()}
    assert len(rules) == 3
    burst = rules["mc-login-fail-burst"]
    assert (burst["severityWeight"], burst["scoreThreshold"], burst["version"]) == (2.0, 2.5, 3)
    assert rules["mc-cart-bot-session"]["severityWeight"] == 2.0
    with pytest.raises(ValueError):
        template_rules(spark, "other")


def test_lint(spark):
    found = {(r["ruleId"], r["reason"][:8]) for r in lint_rules(template_rules(spark, "ieee")).collect()}
    assert found == {("ieee-card-probe", "counts f")}
    by_ip = rules_frame(spark, [{"ruleId": "p", "ruleType": "PAYMENT_FRAUD", "targetActionType": "PAYMENT",
                                 "windowSizeMs": 1, "threshold": 1, "groupKeyType": "BY_IP"}])
    assert "one ip" in lint_rules(by_ip).first()["reason"]


def test_scoped_rules(spark):
    row = scope_rules(template_rules(spark, "clickstream"), "run1", 1_700_000_012_345).first()
    assert row["ruleId"].endswith("-run1") and row["version"] == 1 + 12_345


def test_large_rule_tables_join_by_salt(spark, monkeypatch):
    """Beyond the broadcast limit the join is a salted shuffle; the pairs are the same."""
    from burstguard.operators import match

    rules = rules_frame(spark, [
        {"ruleId": f"r{i}", "ruleType": "HIGH_FREQ_ACCESS", "targetActionType": ["VIEW", "ORDER"][i % 2], "windowSizeMs": 1000,
         "threshold": 2} for i in range(9)
    ])
    events = spark.range(200).select(
        F.col("id").alias("seq"), F.lit("u").alias("userId"), F.when(F.col("id") % 7 == 0, "ORDER").otherwise("view").alias("actionType"),
        F.lit("i").alias("ip"), (F.col("id") + 1).alias("timestamp"), F.lit("s").alias("sessionId"), F.lit("d").alias("deviceId"),
    )
    pairs = lambda: sorted(map(tuple, match.match_rules(events, rules).select("seq", "ruleId").collect()))
    usual = pairs()
    monkeypatch.setattr(match, "BROADCAST_RULE_ROWS", 3)
    assert pairs() == usual and len(usual) == 29 * 4 + 171 * 5
