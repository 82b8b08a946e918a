"""Rule detectors over matched events: dispatch by rule type, one shared sequence operator."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstguard.functions.actions import LARGE_FROM, SMALL_BELOW
from burstguard.operators import registry
from burstguard.operators.alerts import RULE_FACTS, score_matches
from burstguard.operators.match import match_rules
from burstguard.operators.roles import with_roles
from burstguard.operators.sequence import select_matches
from burstguard.streaming.arrival import replay_matches

def detect_matches(
    matched: DataFrame,
    rules: DataFrame,
    small_below: float = SMALL_BELOW,
    large_from: float = LARGE_FROM,
) -> DataFrame:
    """Matches of all rule types, with their rule's columns.

    All detectors share one pass over the events and one shuffle on ``groupKey``; the rule
    columns not needed for matching stay out of that shuffle and are joined to the few matches.
    """
    rows = with_roles(matched, small_below, large_from)
    matches = select_matches(rows.where(F.col("detector").isin(*registry.SLOT_DETECTORS)))
    if registry.FINDERS:
        # detectors of a user's own: the machine of arrival order, fed in order of time
        timed = rows.where(F.col("detector").isin(*registry.FINDERS)).withColumn("arrivedAt", F.col("timestamp"))
        matches = matches.unionByName(replay_matches(timed).select(*matches.columns))
    return matches.join(rules.select(*RULE_FACTS), "ruleId")


def detect(events: DataFrame, rules: DataFrame, strict_routing: bool = False) -> DataFrame:
    """Alerts of a set of events under fixed rules, in event-time order (ties by ``seq``)."""
    matched = match_rules(events, rules, strict_routing)
    return score_matches(detect_matches(matched, rules))
