"""The whole job: event and rule documents in, alerts out, as a batch or as a stream."""

from pyspark.sql import DataFrame

from burstguard.operators.alerts import stamp_alerts, with_trigger_events
from burstguard.operators.detect import detect
from burstguard.operators.match import match_rules_asof
from burstguard.operators.rules import active_rules, rule_history
from burstguard.sources.decode import decode_events, decode_rules, good_events
from burstguard.streaming.arrival import detect_in_arrival_order
from burstguard.streaming.detection import detect_stream

MODES = ["event_time", "arrival"]


def alerts_from_documents(
    events: DataFrame,
    rules: DataFrame,
    mode: str = "event_time",
    strict_routing: bool = False,
    evidence: bool = False,
) -> DataFrame:
    """Alerts of event documents (``value``, ``seq``) under a changelog of rule documents.

    ``event_time``: the rules in force at the end, events in time order. ``arrival``: the rule
    version in force as each event arrived, ``seq`` counting both in one order.
    """
    decoded = good_events(decode_events(events))
    changelog = decode_rules(rules)
    if mode == "arrival":
        return detect_in_arrival_order(match_rules_asof(decoded, rule_history(changelog), strict_routing))
    if mode != "event_time":
        raise ValueError(f"unknown mode {mode!r}; known: {', '.join(MODES)}")
    alerts = detect(decoded, active_rules(changelog), strict_routing)
    return with_trigger_events(alerts, decoded) if evidence else alerts


def alert_stream_from_documents(
    events: DataFrame, rules: DataFrame, strict_routing: bool = False, ttl_ms: int | None = None
) -> DataFrame:
    """Alerts of a stream of event documents under fixed rule documents, stamped with the time."""
    decoded = good_events(decode_events(events))
    return stamp_alerts(detect_stream(decoded, active_rules(decode_rules(rules)), strict_routing, ttl_ms))
