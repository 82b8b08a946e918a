"""Rule types, group keys and detectors, the built-in ones and those a user adds.

A rule type says which actions its rules watch, which detector works on them and which part each action plays in it. A
detector of a user's own is a function of one key's recent events; like the built-in ones it runs over batches in order
of time, over replays in order of arrival, and in streams. Registrations hold for the process that builds the plans; what
workers need of them travels with the plan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from burstguard.functions import keys
from burstguard.functions.actions import LOGIN_FAIL, LOGIN_SUCCESS, PAYMENT, PAYMENT_FRAUD, SENSITIVE

# Detectors with a plan of their own over time slots.
SLOT_DETECTORS = ("count", "pair", "pay")

#: ``find(events, window_ms, threshold)``: the events of the first match among those in the buffer, or None. Events are
#: dicts in order of time, equal times in order of arrival; a match must be returned in that order.
Find = Callable[[list[dict], int, int], "list[dict] | None"]


def _hit(action: Column) -> Column:
    return F.lit("hit")


@dataclass(frozen=True)
class RuleType:
    """``actions``: what its rules watch, None for the target action of the rule. ``part``: the part of a watched action
    (upper case) in the detector, null for one that it ignores; ``payment`` is told apart by amount into ``small``,
    ``large`` and ``other``. Without a detector its rules match events but raise no alerts."""

    detector: str | None
    actions: tuple[str, ...] | None = None
    part: Callable[[Column], Column] = _hit


def _stuffing_part(action: Column) -> Column:
    return F.when(action.isin(LOGIN_FAIL), "hit")


def _login_part(action: Column) -> Column:
    return F.when(action.isin(LOGIN_SUCCESS), "first").otherwise("second")


def _payment_part(action: Column) -> Column:
    return F.when(action.isin(LOGIN_SUCCESS), "login").when(action.isin(PAYMENT_FRAUD), "large").otherwise("payment")


RULE_TYPES: dict[str, RuleType] = {
    "CREDENTIAL_STUFFING": RuleType("count", (*LOGIN_FAIL, *LOGIN_SUCCESS), _stuffing_part),
    "ORDER_BRUSH": RuleType("count"),
    "HIGH_FREQ_ACCESS": RuleType("count"),
    "ABNORMAL_LOGIN": RuleType("pair", (*LOGIN_SUCCESS, *SENSITIVE), _login_part),
    "PAYMENT_FRAUD": RuleType("pay", (*PAYMENT, *PAYMENT_FRAUD, *LOGIN_SUCCESS), _payment_part),
    "CUSTOM": RuleType(None),
}
FINDERS: dict[str, Find] = {}


def register_detector(name: str, find: Find) -> None:
    """Adds a detector, or puts another in the place of one that was added."""
    if name in (*SLOT_DETECTORS, "chain"):
        raise ValueError(f"{name!r} is a built-in detector")
    FINDERS[name] = find


def register_rule_type(name: str, rule_type: RuleType) -> None:
    """Adds or replaces a rule type. Its detector is a built-in one or has been registered."""
    if rule_type.detector is not None and rule_type.detector not in (*SLOT_DETECTORS, *FINDERS):
        raise ValueError(f"unknown detector {rule_type.detector!r}")
    RULE_TYPES[name] = rule_type


def register_group_key(name: str, value: Callable[[], Column]) -> None:
    """Adds a kind of group key: a text expression over the columns of an event."""
    keys.OTHER_KEYS[name] = value


def key_types() -> list[str]:
    return ["BY_USER_ID", *keys.KEY_FIELDS, *keys.OTHER_KEYS]
