"""Rules as data: changelog folding, templates, rewriting and lint."""

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from burstguard.functions.actions import LOGIN_FAIL, LOGIN_SUCCESS
from burstguard.operators import registry
from burstguard.schemas import RULE_COLUMNS

_ARROW_TYPES = {
    "ruleId": pa.string(),
    "ruleName": pa.string(),
    "ruleType": pa.string(),
    "status": pa.string(),
    "targetActionType": pa.string(),
    "windowSizeMs": pa.int64(),
    "threshold": pa.int32(),
    "groupKeyType": pa.string(),
    "priority": pa.int32(),
    "severityWeight": pa.float64(),
    "scoreThreshold": pa.float64(),
    "description": pa.string(),
    "version": pa.int64(),
    "updateTimestamp": pa.int64(),
}

# What a rule document means when a field is absent.
RULE_DEFAULTS = {
    "status": "ENABLED",
    "groupKeyType": "BY_USER_ID",
    "priority": 100,
    "severityWeight": 1.0,
    "scoreThreshold": 1.0,
    "windowSizeMs": 0,
    "threshold": 0,
    "version": 0,
    "updateTimestamp": 0,
}


def rules_frame(spark: SparkSession, rules: list[dict]) -> DataFrame:
    """Rule rows from Python dicts; absent fields take their defaults.

    Built from Arrow, so the optimizer knows the exact size of the table.
    """
    rows = [RULE_DEFAULTS | rule for rule in rules]
    schema = pa.schema([pa.field(n, _ARROW_TYPES[n]) for n in RULE_COLUMNS])
    return spark.createDataFrame(
        pa.Table.from_pylist([{n: r.get(n) for n in RULE_COLUMNS} for r in rows], schema=schema)
    )


def _filled(name: str) -> Column:
    return F.coalesce(F.col(name) != "", F.lit(False))


def is_valid_rule() -> Column:
    return (
        _filled("ruleId")
        & F.col("ruleType").isNotNull()
        & _filled("targetActionType")
        & F.coalesce(F.col("windowSizeMs") > 0, F.lit(False))
        & F.coalesce(F.col("threshold") > 0, F.lit(False))
    )


def is_enabled_rule() -> Column:
    return F.coalesce(F.col("status") == "ENABLED", F.lit(False))


def is_disabled_rule() -> Column:
    return F.coalesce(F.col("status") == "DISABLED", F.lit(False))


def rule_snapshot(changelog: DataFrame, seq: str = "seq") -> DataFrame:
    """Rules in force after the whole changelog, read in ``seq`` order.

    A DISABLED row removes its rule whatever its version or validity and leaves no
    trace; an invalid row is skipped; otherwise the highest version wins and among
    equal versions the first to arrive. Two map-side combined aggregations, so a rule
    id with very many changes costs no single task more than its share.
    """
    log = changelog.where(_filled("ruleId"))
    removed = log.where(is_disabled_rule()).groupBy("ruleId").agg(F.max(seq).alias("removedAt"))
    put = (
        log.where(~is_disabled_rule() & is_valid_rule())
        .join(removed, "ruleId", "left")
        .where(F.col("removedAt").isNull() | (F.col(seq) > F.col("removedAt")))
    )
    others = [c for c in changelog.columns if c != "ruleId"]
    best = F.max_by(F.struct(*others), F.struct(F.col("version"), -F.col(seq)))
    return put.groupBy("ruleId").agg(best.alias("r")).select("ruleId", "r.*")


def active_rules(changelog: DataFrame, seq: str = "seq") -> DataFrame:
    """Snapshot rows that can match: the checks come after the fold, so a stored row
    with a null status hides older versions and still matches nothing."""
    return rule_snapshot(changelog, seq).where(is_enabled_rule() & is_valid_rule()).drop(seq)


def rule_history(changelog: DataFrame, seq: str = "seq") -> DataFrame:
    """Every accepted change with the half-open interval ``[validFrom, validTo)`` it held."""
    by_rule = Window.partitionBy("ruleId").orderBy(seq)
    log = (
        changelog.where(_filled("ruleId") & (is_disabled_rule() | is_valid_rule()))
        .withColumn("_off", is_disabled_rule())
        .withColumn("_epoch", F.sum(F.col("_off").cast("int")).over(by_rule))
    )
    in_epoch = Window.partitionBy("ruleId", "_epoch").orderBy(seq)
    best_before = F.max(F.when(~F.col("_off"), F.col("version"))).over(
        in_epoch.rowsBetween(Window.unboundedPreceding, -1)
    )
    steps = log.withColumn("_best", best_before).where(
        F.col("_off") | F.col("_best").isNull() | (F.col("version") > F.col("_best"))
    )
    return (
        steps.withColumn("validFrom", F.col(seq))
        .withColumn("validTo", F.lead(seq).over(by_rule))
        .where(~F.col("_off"))
        .drop("_off", "_epoch", "_best", seq)
    )


def _choose(column: Column, values: dict, otherwise=None) -> Column:
    chosen = F.lit(otherwise).cast("string")
    for name, value in values.items():
        chosen = F.when(column == name, value).otherwise(chosen)
    return chosen


def watched_actions(strict_routing: bool = False) -> Column:
    """The actions a rule watches, upper case, each with the part it plays in the rule's detector: an array of
    ``watchedAction, part``. ``part`` is null for actions a rule watches but its detector ignores.

    Payment rules need logins to ever fire, so logins are routed to them too;
    ``strict_routing`` leaves them out and payment rules then stay silent.
    """
    target = F.array(F.upper("targetActionType"))

    def placed(actions: Column, part) -> Column:
        return F.transform(actions, lambda a: F.struct(a.alias("watchedAction"), part(a).cast("string").alias("part")))

    watched = placed(target, lambda a: F.lit(None))
    for name, kind in registry.RULE_TYPES.items():
        actions = kind.actions
        if name == "PAYMENT_FRAUD" and strict_routing:
            actions = tuple(a for a in actions if a not in LOGIN_SUCCESS)
        listed = target if actions is None else F.array(*[F.lit(a) for a in actions])
        mine = placed(listed, kind.part if kind.detector else lambda a: F.lit(None))
        watched = F.when(F.col("ruleType") == name, mine).otherwise(watched)
    return watched


def detector_of(rule_type: Column) -> Column:
    return _choose(rule_type, {name: kind.detector for name, kind in registry.RULE_TYPES.items() if kind.detector})


def rule_actions(rules: DataFrame, strict_routing: bool = False) -> DataFrame:
    """One row per rule and watched action, with the detector of the rule and the part the action plays in it: deciding
    that here, on the small table, keeps it out of the per-event work."""
    return (
        rules.withColumn("_watched", F.explode(watched_actions(strict_routing)))
        .withColumn("detector", detector_of(F.col("ruleType")))
        .select("*", "_watched.*")
        .drop("_watched")
    )


# Rule templates per data profile (id, name, type, action, window, threshold,
# key, priority, description) and the default weight and gate of each rule type.
TEMPLATES = {
    "multi_category": [
        ("mc-login-fail-burst", "Shop: burst of failed logins", "CREDENTIAL_STUFFING", "LOGIN_FAIL", 60000, 3, "BY_IP", 10,
         "three failed logins from one ip within a minute"),
        ("mc-order-brush-user", "Shop: orders in quick succession", "ORDER_BRUSH", "PURCHASE", 120000, 5, "BY_USER_ID", 20,
         "five purchases of one user within two minutes"),
        ("mc-cart-bot-session", "Shop: cart filled by a script", "HIGH_FREQ_ACCESS", "ADD_CART", 30000, 20, "BY_SESSION_ID", 30,
         "twenty cart additions in one session within half a minute"),
    ],
    "clickstream": [
        ("cs-page-view-burst", "Clicks: page views too fast to read", "HIGH_FREQ_ACCESS", "VIEW", 20000, 50, "BY_SESSION_ID", 10,
         "fifty views in one session within twenty seconds"),
        ("cs-order-brush", "Clicks: repeated orders", "ORDER_BRUSH", "ORDER", 180000, 6, "BY_USER_ID", 20,
         "six orders of one user within three minutes"),
        ("cs-cart-burst", "Clicks: repeated cart additions", "HIGH_FREQ_ACCESS", "ADD_CART", 60000, 15, "BY_USER_ID", 30,
         "fifteen cart additions of one user within a minute"),
    ],
    "ieee_cis": [
        ("ieee-payment-fraud", "Cards: several payments marked as fraud", "PAYMENT_FRAUD", "PAYMENT_FRAUD", 300000, 3, "BY_USER_ID", 5,
         "three suspicious payments of one account within five minutes"),
        ("ieee-payment-burst", "Cards: payments in quick succession", "HIGH_FREQ_ACCESS", "PAYMENT", 120000, 10, "BY_USER_ID", 15,
         "ten payments of one account within two minutes"),
        ("ieee-card-probe", "Cards: numbers tried out", "CREDENTIAL_STUFFING", "PAYMENT", 60000, 8, "BY_IP", 25,
         "eight payment attempts from one address within a minute"),
    ],
}
PROFILE_ALIASES = {
    "multi-category": "multi_category",
    "mkechinov": "multi_category",
    "tunguz": "clickstream",
    "ieee-cis": "ieee_cis",
    "ieee": "ieee_cis",
}
TYPE_WEIGHT = {"PAYMENT_FRAUD": 2.5, "CREDENTIAL_STUFFING": 2.0, "ORDER_BRUSH": 1.8, "ABNORMAL_LOGIN": 1.6}
TYPE_GATE = {"PAYMENT_FRAUD": 3.0, "CREDENTIAL_STUFFING": 2.5, "ORDER_BRUSH": 2.2, "ABNORMAL_LOGIN": 2.0}
OTHER_GATE = 1.8


def default_severity_weight(rule_type: Column, priority: Column) -> Column:
    """Weight of the type; other types get 150 / priority, kept within 1 and 2."""
    usual = F.when(priority > 0, priority.cast("double")).otherwise(100.0)
    weight = F.greatest(F.lit(1.0), F.least(F.lit(2.0), F.lit(150.0) / usual))
    for name, value in TYPE_WEIGHT.items():
        weight = F.when(rule_type == name, F.lit(value)).otherwise(weight)
    return weight


def default_score_threshold(rule_type: Column) -> Column:
    gate = F.lit(OTHER_GATE)
    for name, value in TYPE_GATE.items():
        gate = F.when(rule_type == name, F.lit(value)).otherwise(gate)
    return gate


def with_type_defaults(rules: DataFrame) -> DataFrame:
    return rules.withColumn(
        "severityWeight", default_severity_weight(F.col("ruleType"), F.col("priority"))
    ).withColumn("scoreThreshold", default_score_threshold(F.col("ruleType")))


def template_rules(spark: SparkSession, profile: str, version: int = 1, now_ms: int = 0) -> DataFrame:
    """The rule set of a data profile; an unknown profile is an error."""
    name = profile.strip().lower()
    templates = TEMPLATES.get(PROFILE_ALIASES.get(name, name))
    if templates is None:
        raise ValueError(f"unknown profile {profile!r}; known: {', '.join(TEMPLATES)}")
    fields = ["ruleId", "ruleName", "ruleType", "targetActionType", "windowSizeMs", "threshold",
              "groupKeyType", "priority", "description"]
    rows = [dict(zip(fields, t)) | {"version": version, "updateTimestamp": now_ms} for t in templates]
    return with_type_defaults(rules_frame(spark, rows))


def scope_rules(rules: DataFrame, tag: str, now_ms: int) -> DataFrame:
    """Rules renamed for one run, so its alerts can be told from those of other runs."""
    return rules.select(
        *[
            {
                "ruleId": F.concat("ruleId", F.lit(f"-{tag}")).alias("ruleId"),
                "ruleName": F.concat(F.coalesce("ruleName", "ruleId"), F.lit(f"-{tag}")).alias("ruleName"),
                "version": (F.col("version") + now_ms % 100000).alias("version"),
                "updateTimestamp": F.lit(now_ms).cast("bigint").alias("updateTimestamp"),
            }.get(c, F.col(c))
            for c in rules.columns
        ]
    )


def experiment_rules(spark: SparkSession, case: str, window_ms: int, version: int, now_ms: int) -> DataFrame:
    """The three rules of an evaluation case: login, order and view bursts of one window."""
    # Thresholds, priorities, weights and gates of the evaluation rules.
    rows = [
        ("abnormal-login", "sensitive action after login", "ABNORMAL_LOGIN", "LOGIN", 2, 100, 1.6, 1.5),
        ("order-brush", "frequent orders", "ORDER_BRUSH", "ORDER", 5, 90, 1.8, 1.8),
        ("high-freq-view", "frequent views", "HIGH_FREQ_ACCESS", "VIEW", 100, 80, 1.3, 1.5),
    ]
    return rules_frame(
        spark,
        [
            {
                "ruleId": f"{case}-{rid}",
                "ruleName": f"{case}-{name}",
                "ruleType": rule_type,
                "targetActionType": action,
                "windowSizeMs": window_ms,
                "threshold": threshold,
                "priority": priority,
                "severityWeight": weight,
                "scoreThreshold": gate,
                "version": version,
                "updateTimestamp": now_ms,
            }
            for rid, name, rule_type, action, threshold, priority, weight, gate in rows
        ],
    )


def lint_rules(rules: DataFrame, actions: DataFrame | None = None) -> DataFrame:
    """Rules that can never fire, with the reason. ``actions`` holds the observed ``actionType``."""
    target = F.upper("targetActionType")
    reasons = [
        F.when(~is_valid_rule(), F.lit("invalid")),
        F.when(~is_enabled_rule(), F.lit("not enabled")),
        F.when(~F.coalesce(F.col("ruleType").isin(list(registry.RULE_TYPES)), F.lit(False)), F.lit("unknown type")),
        F.when(F.col("ruleType") == "CUSTOM", F.lit("no detector for CUSTOM; use the pattern operators")),
        F.when(
            (F.col("ruleType") == "CREDENTIAL_STUFFING") & ~target.isin(LOGIN_FAIL + LOGIN_SUCCESS),
            F.lit("counts failed logins only, whatever its target"),
        ),
        F.when(
            (F.col("ruleType") == "PAYMENT_FRAUD") & (F.col("groupKeyType") == "BY_IP"),
            F.lit("a key of one ip never sees a login from another"),
        ),
        F.when(target.isin("ADD_TO_CART", "REMOVE_FROM_CART"), F.lit("events carry the short cart action")),
    ]
    if actions is not None:
        seen = actions.select(F.upper("actionType").alias("watchedAction")).distinct().withColumn("_seen", F.lit(1))
        watched = (
            rule_actions(rules.where(is_valid_rule()))
            .join(seen, "watchedAction", "left")
            .groupBy("ruleId")
            .agg(F.max("_seen").alias("_seen"))
        )
        rules = rules.join(watched, "ruleId", "left")
        reasons.append(F.when(is_valid_rule() & F.col("_seen").isNull(), F.lit("no event has a watched action")))
    found = F.filter(F.array(*reasons), lambda r: r.isNotNull())
    return (
        rules.withColumn("reason", F.explode(found)).select("ruleId", "ruleType", "reason")
    )
