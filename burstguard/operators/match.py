"""Events joined with the rules that watch their action."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstguard.functions.keys import group_key
from burstguard.operators.rules import is_enabled_rule, is_valid_rule, rule_actions
from burstguard.sources.decode import is_valid_event

# Above this many (rule, action) rows the table is joined by shuffle instead of broadcast.
BROADCAST_RULE_ROWS = 200_000
SALTS = 64

RULE_PARAMETERS = ["ruleId", "ruleName", "ruleType", "windowSizeMs", "threshold", "severityWeight",
                   "scoreThreshold", "version", "detector", "part"]


def _join_on_action(events: DataFrame, watched: DataFrame, extra=None, crowded=None) -> DataFrame:
    """Join on the action. A rule table of checked size is broadcast; a larger one is
    repeated per salt, because few distinct actions hold all the events. ``crowded`` says, for events and for rules, which
    of them stand where many events do; with it the others are not repeated."""
    of_events, of_rules = crowded or (F.lit(True), F.lit(True))
    action = F.upper("actionType")
    if watched.limit(BROADCAST_RULE_ROWS + 1).count() <= BROADCAST_RULE_ROWS:
        on = action == F.col("watchedAction")
        pairs = events.join(F.broadcast(watched), on if extra is None else on & extra)
    else:
        salts = F.when(of_rules, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
        salted = watched.withColumn("_salt", F.explode(salts))
        on = (action == F.col("watchedAction")) & (F.col("_eventSalt") == F.col("_salt"))
        salt = F.when(of_events, F.pmod(F.xxhash64("seq"), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
        pairs = events.withColumn("_eventSalt", salt).join(
            salted, on if extra is None else on & extra
        )
        pairs = pairs.drop("_eventSalt", "_salt")
    return pairs.drop("watchedAction")


def match_rules(events: DataFrame, rules: DataFrame, strict_routing: bool = False) -> DataFrame:
    """Every valid event with every active rule that watches its action, plus ``groupKey``.

    ``rules`` is a snapshot (one row per rule). Runs before any shuffle, so later
    stages only move rows some rule is interested in.
    """
    live = rules.where(is_enabled_rule() & is_valid_rule())
    watched = rule_actions(live, strict_routing).select(*RULE_PARAMETERS, "groupKeyType", "watchedAction")
    pairs = _join_on_action(events.where(is_valid_event()), watched)
    return pairs.withColumn("groupKey", group_key(F.col("ruleId"), F.col("groupKeyType"))).drop("groupKeyType")


# Buckets of the changelog: so many rows of their list, at most, for each version and its one bucket.
ROWS_PER_VERSION = 4


def asof_buckets(versions: int, rules: int) -> int:
    return max(1, ROWS_PER_VERSION * versions // max(1, rules))


def match_rules_asof(events: DataFrame, history: DataFrame, strict_routing: bool = False) -> DataFrame:
    """As ``match_rules`` with the rule version in force when the event arrived.

    ``seq`` of events and of the changelog must count in one common arrival order. The span of the
    changelog is cut into buckets and each version listed under those it was in force in, so an
    event meets the versions of its own bucket only. Versions of one rule never overlap, which
    bounds the list by versions + rules x buckets. Their number grows with that of versions a rule, so that an event
    meets hardly more versions than there are rules in force, however long the changelog.
    """
    live = history.where(is_enabled_rule() & is_valid_rule())
    low, high, versions, rules = history.agg(
        F.min("validFrom"), F.max(F.coalesce("validTo", "validFrom")), F.count("*"), F.count_distinct("ruleId")
    ).first()
    buckets = asof_buckets(versions, rules)
    low, width = (low or 0), max(1, ((high or 0) - (low or 0)) // buckets + 1)

    def bucket(seq):
        at = F.floor((seq - low) / width)
        return F.greatest(F.lit(0).cast("bigint"), F.least(F.lit(buckets - 1).cast("bigint"), at))

    last = F.coalesce(bucket(F.col("validTo") - 1), F.lit(buckets - 1).cast("bigint"))
    watched = (
        rule_actions(live, strict_routing)
        .where(F.col("validTo").isNull() | (F.col("validTo") > F.col("validFrom")))
        .withColumn("_bucket", F.explode(F.sequence(bucket(F.col("validFrom")), last)))
        .select(*RULE_PARAMETERS, "groupKeyType", "watchedAction", "validFrom", "validTo", "_bucket")
    )
    in_force = (
        (bucket(F.col("seq")) == F.col("_bucket"))
        & (F.col("seq") >= F.col("validFrom"))
        & (F.col("validTo").isNull() | (F.col("seq") < F.col("validTo")))
    )
    # what comes before and after the changelog is in its first and last bucket
    def edge(at):
        return F.lit(buckets < SALTS) | at.isin(0, buckets - 1)

    crowded = (edge(bucket(F.col("seq"))), edge(F.col("_bucket")))
    pairs = _join_on_action(events.where(is_valid_event()), watched, in_force, crowded)
    return pairs.withColumn("groupKey", group_key(F.col("ruleId"), F.col("groupKeyType"))).drop(
        "groupKeyType", "validFrom", "validTo", "_bucket"
    )


def matched_lines(matched: DataFrame) -> DataFrame:
    """One text line per matched pair, for a debugging sink."""
    return matched.select(
        F.format_string(
            "MATCHED ruleType=%s ruleId=%s action=%s userId=%s ts=%d",
            "ruleType", "ruleId", "actionType", "userId", "timestamp",
        ).alias("value")
    )
