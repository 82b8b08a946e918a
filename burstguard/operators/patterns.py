"""Sequence patterns as user-level operators: conditions are plain boolean columns.

They match like the rule detectors: the first match counts, a span equal to the window is inside,
and a match consumes its events. ``overlapping=True`` gives every completing row instead.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burstguard.functions.actions import (
    ORDER_PLACED,
    is_large_payment,
    is_login_fail,
    is_login_success,
    is_sensitive_action,
    is_small_payment,
)
from burstguard.functions.keys import group_key
from burstguard.operators.candidates import count_candidates, pair_candidates
from burstguard.operators.sequence import select_matches

# Fixed value: small payments a payment pattern asks for, whatever the rule's threshold.
PAYMENT_PATTERN_SMALLS = 3


def _rows(events: DataFrame, key: Column, name: str, detector: str, role: Column, threshold: int, window_ms: int):
    """Events as detector rows; those without a key share one, as with rules."""
    return events.select(
        F.coalesce(key.cast("string"), F.lit("UNKNOWN")).alias("groupKey"),
        F.lit(name).alias("ruleId"),
        "timestamp",
        "seq",
        "userId",
        "ip",
        "deviceId",
        F.lit(detector).alias("detector"),
        role.alias("role"),
        F.lit(window_ms).cast("bigint").alias("windowSizeMs"),
        F.lit(threshold).alias("threshold"),
    ).where(F.col("role").isNotNull())


def times_or_more(
    events: DataFrame,
    condition: Column,
    times: int,
    window_ms: int,
    key: Column,
    name: str = "times_or_more",
    overlapping: bool = False,
) -> DataFrame:
    """``times`` events with ``condition`` within the window, per ``key``."""
    rows = _rows(events, key, name, "count", F.when(condition, "hit"), times, window_ms)
    if overlapping:
        return count_candidates(rows, "groupKey", times, window_ms)
    return select_matches(rows)


def followed_by(
    events: DataFrame,
    first: Column,
    second: Column,
    window_ms: int,
    key: Column,
    name: str = "followed_by",
    overlapping: bool = False,
) -> DataFrame:
    """An event with ``second`` after the latest one with ``first``, within the window."""
    role = F.when(first, "first").when(second, "second")
    rows = _rows(events, key, name, "pair", role, 2, window_ms)
    if overlapping:
        return pair_candidates(rows, "groupKey", window_ms)
    return select_matches(rows)


def login_smalls_large(
    events: DataFrame, smalls: int, window_ms: int, key: Column, name: str = "chain"
) -> DataFrame:
    """A login with an ip, then ``smalls`` small payments or more, then a large one."""
    action, amount = F.col("actionType"), F.col("amount")
    role = (
        F.when(is_login_success(action) & F.coalesce(F.col("ip") != "", F.lit(False)), "login")
        .when(is_small_payment(action, amount), "small")
        .when(is_large_payment(action, amount), "large")
    )
    return select_matches(_rows(events, key, name, "chain", role, smalls, window_ms))


def is_valid_rule_dict(rule: dict) -> bool:
    return bool(
        rule.get("ruleId")
        and rule.get("ruleType")
        and rule.get("targetActionType")
        and (rule.get("windowSizeMs") or 0) > 0
        and (rule.get("threshold") or 0) > 0
    )


def rule_pattern(events: DataFrame, rule: dict, key: Column | None = None) -> DataFrame:
    """Matches of the pattern of one rule; every rule type has one, CUSTOM included."""
    if not is_valid_rule_dict(rule):
        raise ValueError(f"invalid rule: {rule}")
    kind, name = rule["ruleType"], rule["ruleId"]
    window, times = rule["windowSizeMs"], rule["threshold"]
    if key is None:
        key = group_key(F.lit(name), F.lit(rule.get("groupKeyType") or "BY_USER_ID"))
    action = F.col("actionType")
    if kind == "ABNORMAL_LOGIN":
        return followed_by(events, is_login_success(action), is_sensitive_action(action), window, key, name)
    if kind == "PAYMENT_FRAUD":
        return login_smalls_large(events, PAYMENT_PATTERN_SMALLS, window, key, name)
    if kind == "CREDENTIAL_STUFFING":
        condition = is_login_fail(action)
    elif kind == "ORDER_BRUSH":
        condition = F.upper(action).isin(ORDER_PLACED)
    else:
        condition = F.upper(action) == rule["targetActionType"].upper()
    return times_or_more(events, condition, times, window, key, name)
