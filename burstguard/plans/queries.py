"""The registered queries: every operator over whole tables."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burstguard.functions.actions import is_login_fail, is_login_success, is_sensitive_action
from burstguard.functions.keys import by_device_id, by_ip, by_user_id, group_key
from burstguard.functions.times import csv_time_ms, flex_time_ms, transaction_time_ms
from burstguard.operators import evaluate as ev
from burstguard.operators import features as ft
from burstguard.operators import patterns as pt
from burstguard.operators import rollups as ru
from burstguard.operators import sampling as sp
from burstguard.operators.alerts import (
    alert_documents,
    alert_evidence,
    alert_lines,
    alert_writes,
    parse_alerts,
    stamp_alerts,
    with_alert_time,
    with_trigger_events,
)
from burstguard.operators.candidates import count_candidates, pair_candidates, payment_candidates
from burstguard.operators.detect import detect
from burstguard.operators.match import match_rules, match_rules_asof, matched_lines
from burstguard.operators.rules import (
    TEMPLATES,
    experiment_rules,
    lint_rules,
    rule_history,
    rule_snapshot,
    scope_rules,
    template_rules,
    with_type_defaults,
)
from burstguard.operators.roles import with_roles
from burstguard.plans import fixtures as fx
from burstguard.plans.pipeline import alerts_from_documents
from burstguard.schemas import BEHAVIOR_COLUMNS, GROUP_KEY_TYPES
from burstguard.session import shared_dir
from burstguard.sources.csvfiles import import_counts, import_rows, map_csv, read_csv
from burstguard.sources.decode import decode_events, decode_rules, good_events, is_valid_event, rejects
from burstguard.sources.arrays import as_arrays
from burstguard.sources.inputs import (
    alert_topic,
    arrival_order,
    baseline_events,
    behavior_topic,
    captured_alerts,
    json_documents,
    rule_topic,
)
from burstguard.sources.outputs import (
    alert_table_rows,
    alert_topic_stream,
    event_documents,
    keyed_documents,
    rule_documents,
    write_csv,
    write_lines,
    write_rule_array,
    write_topic,
)
from burstguard.streaming.arrival import detect_in_arrival_order
from burstguard.streaming.detection import detect_stream
from burstguard.streaming.rulebook import detect_live
from burstguard.streaming.tables import (
    alert_table_stream,
    feature_state_stream,
    read_alert_table,
    read_feature_state,
    read_rollup_table,
    rollup_table_stream,
    run_now,
)

HOUR = fx.HOUR
ALERT_COLUMNS = ["groupKey", "ruleId", "ruleType", "level", "userId", "ip", "deviceId", "matchCount",
                 "riskScore", "firstEventTimestamp", "lastEventTimestamp"]
# Wall clock used where an operator would otherwise read it.
NOW_MS = 1_800_000_000_000
RULE_FIELDS = ["ruleId", "ruleType", "status", "targetActionType", "windowSizeMs", "threshold", "groupKeyType",
               "version"]


def _events(spark, sf):
    return fx.events_view(spark, sf)


def _alerts(spark, sf, only: str | None = None) -> DataFrame:
    rules = fx.fixture_rules(spark)
    if only:
        rules = rules.where(F.col("ruleId") == only)
    return detect(_events(spark, sf), rules)


def _alert_rows(alerts: DataFrame) -> DataFrame:
    return alerts.select(*[F.round(c, 6).alias(c) if c == "riskScore" else c for c in ALERT_COLUMNS])


def _stamped(spark, sf) -> DataFrame:
    """Alerts raised a while after their last event; ``seq`` orders them as they were raised."""
    lag = F.pmod(F.col("lastEventTimestamp"), F.lit(400_000))
    stamped = stamp_alerts(_alerts(spark, sf), F.col("lastEventTimestamp") + lag)
    return stamped.withColumn("seq", F.element_at("eventSeqs", -1))


def behavior_normalized(spark, sf):
    return good_events(decode_events(fx.event_documents_view(spark, sf))).select(
        "seq", "userId", "actionType", "ip", "timestamp", "sessionId", "amount"
    )


def behavior_rejects(spark, sf):
    return rejects(decode_events(fx.event_documents_view(spark, sf)))


def behavior_invalid_counts(spark, sf):
    decoded = decode_events(fx.event_documents_view(spark, sf))
    bad = F.col("rejected").isNotNull()
    return decoded.agg(
        F.count("*").alias("total"),
        F.count_if(bad).alias("rejected"),
        F.count_if(~bad & ~is_valid_event()).alias("invalid"),
        F.count_if(~bad & is_valid_event()).alias("converted"),
    )


def flex_event_time(spark, sf):
    return fx.time_texts_view(spark, sf).select(
        "o_orderkey",
        flex_time_ms(F.col("text")).alias("flex_ms"),
        csv_time_ms(F.col("text")).alias("csv_ms"),
        transaction_time_ms(F.col("o_custkey") - 5).alias("transaction_ms"),
    )


def rule_decoded(spark, sf):
    return decode_rules(fx.rule_documents_view(spark, sf)).select("seq", *RULE_FIELDS, "severityWeight", "priority")


def rule_snapshot_q(spark, sf):
    return rule_snapshot(fx.rule_changes(spark, sf)).select(*RULE_FIELDS, "seq")


def rule_history_q(spark, sf):
    return rule_history(fx.rule_changes(spark, sf)).select("ruleId", "version", "status", "validFrom", "validTo")


def rule_lint(spark, sf):
    snapshot = rule_snapshot(fx.rule_changes(spark, sf))
    return lint_rules(snapshot, _events(spark, sf))


def rule_defaults(spark, sf):
    kinds = F.when(F.col("priority") % 2 == 0, "PAYMENT_FRAUD").otherwise("CUSTOM")
    rules = rule_snapshot(fx.rule_changes(spark, sf)).withColumn("priority", F.col("seq") % 200).withColumn(
        "ruleType", kinds
    )
    return with_type_defaults(rules).select("ruleId", "ruleType", F.round("severityWeight", 6).alias("severityWeight"),
                                            "scoreThreshold")


def rule_match(spark, sf):
    return match_rules(_events(spark, sf), fx.fixture_rules(spark)).select("seq", "ruleId", "groupKey")


def rule_match_asof(spark, sf):
    history = rule_history(fx.rule_log_view(spark, sf))
    return match_rules_asof(_events(spark, sf), history).select("seq", "ruleId", "version", "threshold", "groupKey")


def group_keys(spark, sf):
    e = _events(spark, sf)
    kinds = F.explode(F.array(*[F.lit(k) for k in GROUP_KEY_TYPES]))
    return e.withColumn("keyType", kinds).select(
        "seq",
        "keyType",
        group_key(F.lit("r"), F.col("keyType")).alias("groupKey"),
        by_user_id(F.col("userId")).alias("byUser"),
        by_ip(F.col("ip")).alias("byIp"),
        by_device_id(F.col("deviceId")).alias("byDevice"),
    )


def order_brush_candidates(spark, sf):
    rows = _events(spark, sf).where("actionType = 'PAYMENT'")
    return count_candidates(rows, "userId", 3, 72 * HOUR).select("seq", "userId", "firstTimestamp", "timestamp")


def high_freq_candidates(spark, sf):
    rows = _events(spark, sf).where("actionType = 'VIEW'")
    return count_candidates(rows, "sessionId", 2, 24 * HOUR).select("seq", "sessionId", "firstTimestamp", "timestamp")


def stuffing_candidates(spark, sf):
    rows = _events(spark, sf).where("actionType = 'LOGIN_FAIL'")
    return count_candidates(rows, "ip", 3, 24 * HOUR).select("seq", "ip", "firstTimestamp", "timestamp")


def _fixture_roles(spark, sf, rule):
    rules = fx.fixture_rules(spark).where(F.col("ruleId") == rule)
    return with_roles(match_rules(_events(spark, sf), rules))


def login_candidates(spark, sf):
    return pair_candidates(_fixture_roles(spark, sf, "fx-login"), "groupKey", 24 * HOUR).select(
        "seq", "userId", "firstTimestamp", "timestamp"
    )


def payment_candidates_q(spark, sf):
    return payment_candidates(_fixture_roles(spark, sf, "fx-pay"), "groupKey", 2, 120 * HOUR).select(
        "seq", "userId", "smallPayments", "loginTimestamp", "timestamp"
    )


def alerts_of(rule):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return _alert_rows(_alerts(spark, sf, rule))

    return query


def all_alerts(spark, sf):
    return _alert_rows(_alerts(spark, sf))


def arrival_alerts(spark, sf):
    matched = match_rules(_events(spark, sf), fx.fixture_rules(spark))
    return _alert_rows(detect_in_arrival_order(matched))


def asof_alerts(spark, sf):
    history = rule_history(fx.rule_log_view(spark, sf))
    return _alert_rows(detect_in_arrival_order(match_rules_asof(_events(spark, sf), history)))


def arrival_disorder(spark, sf):
    """All detectors over events of which some arrive late, within their windows and long past them."""
    n = F.col("seq")
    late = n + F.when(n % 11 == 0, 900).when(n % 5 == 0, 20).otherwise(0)
    events = _events(spark, sf).withColumn("seq", late * 10_000_000 + n)
    return _alert_rows(detect_in_arrival_order(match_rules(events, fx.fixture_rules(spark))))


def tied_alerts(spark, sf):
    """All detectors over events whose times are rounded to twelve hours, so that many of a key are equal and matches
    that end at the time of the one before hold their key back."""
    half_day = 12 * fx.HOUR
    events = _events(spark, sf).withColumn("timestamp", F.floor(F.col("timestamp") / half_day) * half_day)
    return _alert_rows(detect(events, fx.fixture_rules(spark)))


def topic_alerts(spark, sf):
    """Events over two partitions of a topic with offsets far apart, detected in the order of their arrival."""
    n = F.col("seq")
    partition = (n % 3 == 0).cast("int")
    topic = _events(spark, sf).withColumns(
        {"partition": partition, "offset": n + partition * 1_000_000_000, "recordMs": F.col("timestamp") + n % 2}
    )
    return _alert_rows(detect_in_arrival_order(match_rules(arrival_order(topic.drop("seq")), fx.fixture_rules(spark))))


def alert_messages(spark, sf):
    return _alerts(spark, sf).select("groupKey", "lastEventTimestamp", "message")


def alert_levels(spark, sf):
    return _alerts(spark, sf).groupBy("ruleType", "level").agg(F.count("*").alias("cnt"))


def risk_scores(spark, sf):
    return _alerts(spark, sf).groupBy("ruleId", "matchCount").agg(
        F.count("*").alias("cnt"), F.round(F.max("riskScore"), 6).alias("riskScore")
    )


def alert_evidence_q(spark, sf):
    e = _events(spark, sf)
    rows = alert_evidence(_alerts(spark, sf), e)
    return rows.groupBy("ruleId", "actionType").agg(
        F.count("*").alias("cnt"), F.sum("seq").alias("seqSum"), F.sum("place").alias("places")
    )


def alert_trigger_events(spark, sf):
    alerts = with_trigger_events(_alerts(spark, sf), _events(spark, sf))
    return alerts.select(
        "ruleId", "userId", "matchCount", F.size("triggerEvents").alias("events"),
        F.element_at("triggerEvents", 1)["timestamp"].alias("firstTs"),
        F.element_at("triggerEvents", -1)["timestamp"].alias("lastTs"),
        F.round(F.aggregate("triggerEvents", F.lit(0.0), lambda s, x: s + x["amount"]), 4).alias("amount"),
    )


def alert_table(spark, sf):
    docs = alert_documents(_stamped(spark, sf))
    return alert_table_rows(docs).select(
        "ruleId", "ruleType", "level", "userId", "ip", "deviceId", "extra", "matchCount",
        F.round("riskScore", 6).alias("riskScore"), "alertTimestampMs", "lastEventTimestampMs",
        F.unix_seconds("alertTime").alias("alertSecond"), "month",
    )


def alert_keys(spark, sf):
    return alert_documents(_alerts(spark, sf)).groupBy("key").agg(F.count("*").alias("cnt"))


def alerts_per_minute(spark, sf):
    rolled = ru.rollup_alerts(with_alert_time(_alerts(spark, sf)))
    return ru.average_score(rolled).select(
        F.unix_seconds("bucket").alias("bucket"), "ruleType", "cnt", F.round("avgRiskScore", 6).alias("avgRiskScore")
    )


def alerts_per_hour(spark, sf):
    """Hourly buckets added up from the minute buckets."""
    minutes = ru.rollup_alerts(with_alert_time(_alerts(spark, sf)))
    hours = ru.merge_rollups(minutes.withColumn("bucket", F.date_trunc("hour", "bucket")))
    return ru.average_score(hours).select(
        F.unix_seconds("bucket").alias("bucket"), "ruleType", "cnt", F.round("avgRiskScore", 6).alias("avgRiskScore")
    )


def type_share(spark, sf):
    return ru.type_share(_alerts(spark, sf)).withColumn("share", F.round("share", 6))


def top_sources(spark, sf):
    return ru.top_sources(_alerts(spark, sf), 10)


def rule_totals(spark, sf):
    return ru.rule_totals(_alerts(spark, sf))


def _feature_rows(spark, sf):
    """Alerts as feature writes: raised at their last event's time, some without extra or ip."""
    alerts = _alerts(spark, sf)
    n = F.element_at("eventSeqs", -1)
    return alerts.select(
        n.alias("seq"),
        F.col("lastEventTimestamp").alias("writtenAt"),
        "userId",
        F.when(n % 5 != 0, F.col("ip")).alias("ip"),
        "ruleType",
        F.when(n % 3 == 0, F.concat(F.lit("x"), n)).alias("extra"),
    )


FEATURE_TTL = 6 * HOUR


def feature_by(scope):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return ft.feature_snapshot(ft.feature_updates(_feature_rows(spark, sf), scope), ttl_ms=FEATURE_TTL)

    return query


def _expected(spark, sf):
    """Users taken as truly abnormal: those with an odd id, per rule type of the evaluation."""
    users = _events(spark, sf).where(F.col("userId").cast("bigint") % 2 == 1).select(F.col("userId").alias("user"))
    types = F.explode(F.array(*[F.lit(t) for t in ev.RULE_LABELS]))
    return users.distinct().select(types.alias("rule_type"), "user")


def dedup_alerts(spark, sf):
    return ev.dedup_alerts(_stamped(spark, sf), 6 * HOUR).select(
        "ruleType", "userId", "lastEventTimestamp", "processingLagMs", "seq"
    )


def quality_by_rule(spark, sf):
    return ev.quality_by_rule(_alerts(spark, sf), _expected(spark, sf), "fixture")


def quality_summary(spark, sf):
    return ev.quality_summary(_alerts(spark, sf), _expected(spark, sf))


def latency_p99(spark, sf):
    rows = ev.latency_summary(_stamped(spark, sf), 60_000)
    return rows.select(F.round("avg_latency_ms", 3).alias("avg_latency_ms"), "p99_latency_ms")


def _own_rules(spark):
    return fx.fixture_rules(spark).where(F.col("ruleId") != "fx-view").select("ruleId")


def scope_split(spark, sf):
    flagged = ev.with_scope(_alerts(spark, sf), _own_rules(spark))
    scope = F.when(F.col("in_scope"), "in").otherwise("out").alias("scope")
    return flagged.groupBy(scope, "ruleId").agg(F.count("*").alias("cnt"))


def verification_summary(spark, sf):
    rows = ev.verification_summary(_alerts(spark, sf), _own_rules(spark))
    return rows.withColumn("recognized_types", F.array_join("recognized_types", ",")).withColumn(
        "unexpected_rule_ids", F.array_join("unexpected_rule_ids", ",")
    )


def alerts_by_type(spark, sf):
    return ev.alerts_by(_alerts(spark, sf), "ruleType")


def case_row(spark, sf):
    span = (F.max("timestamp") - F.min("timestamp")) / 1000
    load = _events(spark, sf).agg(F.count("*").alias("events"), span.alias("seconds"))
    return ev.case_summary(
        _stamped(spark, sf), _own_rules(spark), _expected(spark, sf), load, "w60000", 60_000, 4, "heap", 1.0, 2.0
    )


def abnormal_users(spark, sf):
    return ev.abnormal_users(_alerts(spark, sf)).groupBy("rule_type").agg(F.count_distinct("user").alias("users"))


def _cases(spark, sf):
    """Alerts per group of users as evaluation cases p, w, b and s: their counts, the events they hold, their longest span
    and how many rules they come from."""
    family = F.get(F.array(F.lit("p"), F.lit("w"), F.lit("b"), F.lit("s")), (F.col("user_n") % 4).cast("int"))
    users = _alerts(spark, sf).withColumn("user_n", F.col("userId").cast("bigint"))
    return users.groupBy(F.concat(family, (F.col("user_n") % 40).cast("string")).alias("case")).agg(
        F.count("*").alias("alerts"),
        F.sum("matchCount").alias("alerts_raw_total"),
        F.max(F.col("lastEventTimestamp") - F.col("firstEventTimestamp")).alias("window"),
        F.count_distinct("ruleId").alias("parallelism"),
        F.sum("matchCount").alias("events"),
        F.min("ruleType").alias("backend"),
        F.min("user_n").alias("seq"),
        (F.avg("matchCount") * 40_000).alias("avg_latency_ms"),
    )


def detection_rate(spark, sf):
    return ev.detection_rate(_cases(spark, sf)).select(
        "case", "alerts", F.round("detection_rate", 6).alias("detection_rate"),
        ev.latency_censored().alias("censored"),
    )


def case_family(spark, sf):
    return ev.case_family(_cases(spark, sf), "w").select("case", "window")


def reference_case(spark, sf):
    return ev.reference_case_rows(_cases(spark, sf)).select("case", "alerts")


def _pattern_rows(matches):
    return matches.select("groupKey", "matchCount", "firstEventTimestamp", "lastEventTimestamp")


def pattern_times_or_more(spark, sf):
    e = _events(spark, sf)
    return _pattern_rows(pt.times_or_more(e, is_login_fail(F.col("actionType")), 2, 96 * HOUR, F.col("userId")))


def pattern_times_overlapping(spark, sf):
    e = _events(spark, sf)
    rows = pt.times_or_more(
        e, is_login_fail(F.col("actionType")), 2, 96 * HOUR, F.col("userId"), overlapping=True
    )
    return rows.select("groupKey", "seq", "firstTimestamp", "timestamp")


def pattern_followed_by(spark, sf):
    e, a = _events(spark, sf), F.col("actionType")
    return _pattern_rows(pt.followed_by(e, is_login_success(a), is_sensitive_action(a), 48 * HOUR, by_device_id(F.col("deviceId"))))


def pattern_payment_chain(spark, sf):
    rule = {"ruleId": "chain", "ruleType": "PAYMENT_FRAUD", "targetActionType": "PAYMENT",
            "windowSizeMs": 240 * HOUR, "threshold": 1}
    return _pattern_rows(pt.rule_pattern(_events(spark, sf), rule))


def pattern_custom(spark, sf):
    rule = {"ruleId": "custom", "ruleType": "CUSTOM", "targetActionType": "add_cart", "windowSizeMs": 48 * HOUR,
            "threshold": 2}
    return _pattern_rows(pt.rule_pattern(_events(spark, sf), rule))


def csv_mapped(profile):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        rows = fx.csv_view(spark, sf, profile)
        mapped = map_csv(rows, "auto", NOW_MS, keep=["row"])
        return mapped.select("row", "userId", "actionType", "ip", "timestamp", "sessionId", "productId", "amount")

    return query


def csv_import_counts(spark, sf):
    return import_counts(map_csv(fx.csv_view(spark, sf, "multi_category"), "auto", NOW_MS))


def baseline_normalized(spark, sf):
    rows = baseline_events(fx.event_documents_view(spark, sf), NOW_MS)
    return rows.select("seq", "userId", "actionType", "ip", "timestamp", "sessionId", "amount")


def keyed_events(spark, sf):
    docs = event_documents(_events(spark, sf))
    return keyed_documents(docs, "sessionId").groupBy("key").agg(F.count("*").alias("cnt"))


def first_events(spark, sf):
    return sp.first_by_time(_events(spark, sf), 100).select("seq", "timestamp")


def merged_events(spark, sf):
    """Logins and payments of two sources as one stream of events by time."""
    e = _events(spark, sf)
    logins = e.where(F.col("actionType").startswith("LOGIN")).drop("amount")
    return sp.merge_by_time(logins, e.where("actionType = 'PAYMENT'")).select("seq", "actionType", "timestamp", "amount")


def templates_matched(spark, sf):
    """The rule set of every data profile against all events."""
    rules = None
    for profile in TEMPLATES:
        one = template_rules(spark, profile)
        rules = one if rules is None else rules.unionByName(one)
    return match_rules(_events(spark, sf), rules).select("seq", "ruleId", "groupKey", "threshold", "severityWeight")


def scoped_rule_match(spark, sf):
    rules = scope_rules(fx.fixture_rules(spark), "run7", NOW_MS)
    return match_rules(_events(spark, sf), rules).groupBy("ruleId", "version").agg(
        F.count("*").alias("cnt"), F.count_distinct("groupKey").alias("keys")
    )


def experiment_rule_match(spark, sf):
    rules = experiment_rules(spark, "t", 60_000, 1, NOW_MS)
    return match_rules(_events(spark, sf), rules).groupBy("ruleId", "windowSizeMs", "threshold").agg(
        F.count("*").alias("cnt"), F.count_distinct("groupKey").alias("keys")
    )


def pattern_order(spark, sf):
    """Purchases are orders placed: three by one user in three days."""
    placed = F.when(F.col("actionType") == "PAYMENT", "ORDER").otherwise(F.col("actionType"))
    rule = {"ruleId": "order", "ruleType": "ORDER_BRUSH", "targetActionType": "ORDER", "windowSizeMs": 72 * HOUR,
            "threshold": 3}
    return _pattern_rows(pt.rule_pattern(_events(spark, sf).withColumn("actionType", placed), rule))


def pattern_high_freq(spark, sf):
    rule = {"ruleId": "views", "ruleType": "HIGH_FREQ_ACCESS", "targetActionType": "view", "windowSizeMs": 24 * HOUR,
            "threshold": 2, "groupKeyType": "BY_SESSION_ID"}
    return _pattern_rows(pt.rule_pattern(_events(spark, sf), rule))


def gated_alerts(spark, sf):
    """Rules with a gate that only some of their matches reach; those below it give no alert but use up their events."""
    gate = F.when(F.col("ruleId") == "fx-pay", 8.0).when(F.col("ruleId") == "fx-login", 9.0).otherwise(F.col("scoreThreshold"))
    return _alert_rows(detect(_events(spark, sf), fx.fixture_rules(spark).withColumn("scoreThreshold", gate)))


def pipeline_alerts(spark, sf):
    """The whole job from JSON documents of events and rules."""
    rules = rule_documents(fx.fixture_rules(spark)).select(F.lit(0).cast("bigint").alias("seq"), "value")
    docs = event_documents(_events(spark, sf).withColumn("extra", F.col("seq").cast("string")))
    docs = docs.select(F.get_json_object("value", "$.extra").cast("bigint").alias("seq"), "value")
    return _alert_rows(alerts_from_documents(docs, rules))


def _folder(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def jsonl_roundtrip(spark, sf):
    """Events written as JSON lines, read and decoded again."""
    path = _folder(spark, "events-jsonl")
    write_lines(event_documents(_events(spark, sf)), path)
    return good_events(decode_events(json_documents(spark, path))).groupBy("actionType", "deviceId").agg(
        F.count("*").alias("cnt"), F.sum("timestamp").alias("times"), F.round(F.sum("amount"), 2).alias("amount")
    )


def csv_roundtrip(spark, sf):
    """A CSV export read again, its layout found from the header, and the rows that are usable events."""
    path = _folder(spark, "events-csv")
    rows = fx.csv_view(spark, sf, "multi_category")
    write_csv(rows, path, rows.columns)
    kept, _ = import_rows(map_csv(read_csv(spark, path), "auto", NOW_MS))
    return kept.groupBy("actionType", "productId").agg(F.count("*").alias("cnt"), F.sum("timestamp").alias("times"))


def features_from_documents(spark, sf):
    """The feature table from the alert texts that a topic would hold."""
    docs = alert_documents(_stamped(spark, sf)).select("value")
    return ft.feature_snapshot(ft.feature_updates(alert_writes(docs), "userId"), ttl_ms=FEATURE_TTL)


def rollup_from_documents(spark, sf):
    """Alert texts to table rows to minute buckets."""
    rolled = ru.rollup_alerts(alert_table_rows(alert_documents(_stamped(spark, sf)).select("value")))
    return ru.average_score(rolled).select(
        F.unix_seconds("bucket").alias("bucket"), "ruleType", "cnt", F.round("avgRiskScore", 6).alias("avgRiskScore")
    )


def array_roundtrip(spark, sf):
    """Events written as JSON arrays, read again by byte ranges and decoded."""
    path = _folder(spark, "events-arrays")
    as_arrays(event_documents(_events(spark, sf))).write.text(path)
    return good_events(decode_events(json_documents(spark, path))).groupBy("actionType", "deviceId").agg(
        F.count("*").alias("cnt"), F.sum("timestamp").alias("times"), F.round(F.sum("amount"), 2).alias("amount")
    )


def rule_array_roundtrip(spark, sf):
    """Rules written as JSON arrays side by side, read and decoded again."""
    path = _folder(spark, "rule-arrays")
    write_rule_array(fx.rule_changes(spark, sf), path, files=None)
    return decode_rules(json_documents(spark, path)).select(*RULE_FIELDS)


def rule_topic_snapshot(spark, sf):
    """Rule documents out of a topic, in order of arrival, folded to the rules in force."""
    place = f"segments:{_folder(spark, 'topics')}"
    # ranges of time are written side by side, since segments get their offsets in the order of the tasks
    ordered = fx.rule_changes(spark, sf).repartitionByRange("seq").sortWithinPartitions("seq")
    docs = rule_documents(ordered.withColumn("ruleName", F.col("seq").cast("string")))
    at = F.timestamp_millis(F.get_json_object("value", "$.ruleName").cast("long"))
    write_topic(docs.withColumn("timestamp", at), place, "rules", partitions=4)
    return rule_snapshot(decode_rules(rule_topic(spark, place, "rules").drop("key"))).select(*RULE_FIELDS)


def captured_alerts_q(spark, sf):
    """Alert documents among the other lines that a console has printed."""
    path = _folder(spark, "captured")
    alerts = _stamped(spark, sf)
    write_lines(alert_documents(alerts).select("value").unionByName(alert_lines(alerts)), path)
    return parse_alerts(captured_alerts(spark, path)).groupBy("ruleId", "level").agg(
        F.count("*").alias("cnt"), F.sum("matchCount").alias("matched")
    )


def matched_tap(spark, sf):
    """A line of text for each event and rule that match."""
    return matched_lines(match_rules(_events(spark, sf), fx.fixture_rules(spark)))


def alert_tap(spark, sf):
    """A line of text for each alert."""
    return alert_lines(_stamped(spark, sf))


def sampled_events(spark, sf):
    """A random sample of a hundred events: how many there are, and how many of them are different events."""
    events = _events(spark, sf)
    drawn = sp.sample_rows(events, 100, seed=7).select("seq")
    return drawn.join(events, "seq").agg(F.count("*").alias("cnt"), F.count_distinct("seq").alias("different"))


def _written_stream(spark, rows, name):
    """Rows as a stream of files; a session may read back only what it has written whole."""
    path = _folder(spark, name)
    rows.write.parquet(path)
    return spark.readStream.schema(rows.schema).parquet(path)


def _behavior_topic(spark, sf):
    """Events as records of a topic of exported segments: four partitions by user, in order of time."""
    order = ["partition", "timestamp", "seq"]
    dealt = _events(spark, sf).withColumn("partition", F.pmod(F.xxhash64("userId"), F.lit(4)).cast("int"))
    # a partition of the topic is written by several tasks, in ranges of its order
    ordered = dealt.repartitionByRange(*order).sortWithinPartitions(*order)
    timed = ordered.select(
        F.col("userId").alias("key"), F.to_json(F.struct(*BEHAVIOR_COLUMNS)).alias("value"),
        F.timestamp_millis("timestamp").alias("timestamp"), "partition",
    )
    place = f"segments:{_folder(spark, 'topics')}"
    write_topic(timed, place, "behavior")
    return place


def _parsed_topic(spark, place):
    return parse_alerts(alert_topic(spark, place, "alerts")).select(
        "ruleId", "ruleType", "level", "userId", "ip", "deviceId", "matchCount", F.round("riskScore", 6).alias("riskScore"),
        "firstEventTimestampMs", "lastEventTimestampMs",
    )


def topic_roundtrip(spark, sf):
    """Events out of a topic, detected in order of arrival, alerts into another topic and out of it again."""
    place = _behavior_topic(spark, sf)
    events = good_events(decode_events(behavior_topic(spark, place, "behavior", stream=False).drop("key")))
    alerts = detect_in_arrival_order(match_rules(events, fx.fixture_rules(spark)))
    write_topic(alert_documents(alerts), place, "alerts")
    return _parsed_topic(spark, place)


def topic_stream_alerts(spark, sf):
    """The same as a stream from topic to topic."""
    place = _behavior_topic(spark, sf)
    events = good_events(decode_events(behavior_topic(spark, place, "behavior", starting="earliest").drop("key")))
    alerts = detect_stream(events, fx.fixture_rules(spark))
    run_now(alert_topic_stream(alerts, place, "alerts", _folder(spark, "checkpoint")))
    return _parsed_topic(spark, place)


def live_rule_alerts(spark, sf):
    """Rules that change, are switched off and on again while the events stream, in one streaming query."""
    clock = F.col("seq").alias("arrivedAt")
    events = _written_stream(spark, _events(spark, sf).select("*", clock), "events")
    changes = _written_stream(spark, fx.rule_log_view(spark, sf).select("*", clock), "rules")
    place = f"segments:{_folder(spark, 'topics')}"
    run_now(alert_topic_stream(detect_live(events, changes), place, "alerts", _folder(spark, "checkpoint")))
    return _parsed_topic(spark, place)


def stream_rollup(spark, sf):
    """Alert texts through a watermarked stream into minute buckets."""
    texts = _written_stream(spark, alert_documents(_stamped(spark, sf)).select("value"), "alerts")
    table = _folder(spark, "rollups")
    run_now(rollup_table_stream(alert_table_rows(texts), table, _folder(spark, "checkpoint"), "1 hour"))
    return ru.average_score(read_rollup_table(spark, table)).select(
        F.unix_seconds("bucket").alias("bucket"), "ruleType", "cnt", F.round("avgRiskScore", 6).alias("avgRiskScore")
    )


def feature_state_by(scope):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        checkpoint = _folder(spark, "checkpoint")
        rows = _written_stream(spark, _feature_rows(spark, sf), "writes")
        updates = feature_state_stream(rows, scope, FEATURE_TTL, expiring=False)
        run_now(updates.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint))
        return read_feature_state(spark, checkpoint)

    return query


def stream_alert_table(spark, sf):
    """Alert texts, some delivered twice, as a stream into the alert table."""
    docs = alert_documents(_stamped(spark, sf)).select("value")
    # delivered again from the row at hand, so that the alerts are found once
    times = F.when(F.pmod(F.xxhash64("value"), F.lit(3)) == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    delivered = docs.select("value", F.explode(times)).select("value")
    table = _folder(spark, "alert-table")
    run_now(alert_table_stream(_written_stream(spark, delivered, "alerts"), table, _folder(spark, "checkpoint")))
    return read_alert_table(spark, table).select(
        "ruleId", "ruleType", "level", "userId", "ip", "deviceId", "extra", "matchCount",
        F.round("riskScore", 6).alias("riskScore"), "alertTimestampMs", "lastEventTimestampMs",
        F.unix_seconds("alertTime").alias("alertSecond"), "month",
    )


QUERIES = {
    "behavior_normalized": behavior_normalized,
    "behavior_rejects": behavior_rejects,
    "behavior_invalid_counts": behavior_invalid_counts,
    "flex_event_time": flex_event_time,
    "rule_decoded": rule_decoded,
    "rule_snapshot": rule_snapshot_q,
    "rule_history": rule_history_q,
    "rule_lint": rule_lint,
    "rule_defaults": rule_defaults,
    "rule_match": rule_match,
    "rule_match_asof": rule_match_asof,
    "group_keys": group_keys,
    "order_brush_candidates": order_brush_candidates,
    "high_freq_candidates": high_freq_candidates,
    "stuffing_candidates": stuffing_candidates,
    "login_candidates": login_candidates,
    "payment_candidates": payment_candidates_q,
    "order_brush_alerts": alerts_of("fx-order"),
    "high_freq_alerts": alerts_of("fx-view"),
    "stuffing_alerts": alerts_of("fx-stuffing"),
    "abnormal_login_alerts": alerts_of("fx-login"),
    "payment_fraud_alerts": alerts_of("fx-pay"),
    "all_alerts": all_alerts,
    "arrival_alerts": arrival_alerts,
    "asof_alerts": asof_alerts,
    "arrival_disorder": arrival_disorder,
    "tied_alerts": tied_alerts,
    "topic_alerts": topic_alerts,
    "array_roundtrip": array_roundtrip,
    "rule_array_roundtrip": rule_array_roundtrip,
    "rule_topic_snapshot": rule_topic_snapshot,
    "captured_alerts": captured_alerts_q,
    "matched_tap": matched_tap,
    "alert_tap": alert_tap,
    "sampled_events": sampled_events,
    "topic_roundtrip": topic_roundtrip,
    "topic_stream_alerts": topic_stream_alerts,
    "live_rule_alerts": live_rule_alerts,
    "stream_rollup": stream_rollup,
    "feature_state_by_user": feature_state_by("userId"),
    "feature_state_by_ip": feature_state_by("ip"),
    "stream_alert_table": stream_alert_table,
    "alert_messages": alert_messages,
    "alert_levels": alert_levels,
    "risk_scores": risk_scores,
    "alert_evidence": alert_evidence_q,
    "alert_trigger_events": alert_trigger_events,
    "alert_table": alert_table,
    "alert_keys": alert_keys,
    "alerts_per_minute": alerts_per_minute,
    "alerts_per_hour": alerts_per_hour,
    "type_share": type_share,
    "top_sources": top_sources,
    "rule_totals": rule_totals,
    "feature_by_user": feature_by("userId"),
    "feature_by_ip": feature_by("ip"),
    "dedup_alerts": dedup_alerts,
    "quality_by_rule": quality_by_rule,
    "quality_summary": quality_summary,
    "latency_p99": latency_p99,
    "scope_split": scope_split,
    "verification_summary": verification_summary,
    "alerts_by_type": alerts_by_type,
    "case_summary": case_row,
    "abnormal_users": abnormal_users,
    "detection_rate": detection_rate,
    "case_family": case_family,
    "reference_case": reference_case,
    "pattern_times_or_more": pattern_times_or_more,
    "pattern_times_overlapping": pattern_times_overlapping,
    "pattern_followed_by": pattern_followed_by,
    "pattern_payment_chain": pattern_payment_chain,
    "pattern_custom": pattern_custom,
    "csv_multi_category": csv_mapped("multi_category"),
    "csv_clickstream": csv_mapped("clickstream"),
    "csv_ieee": csv_mapped("ieee_cis"),
    "csv_generic": csv_mapped("generic"),
    "csv_import_counts": csv_import_counts,
    "baseline_normalized": baseline_normalized,
    "keyed_events": keyed_events,
    "first_events": first_events,
    "merged_events": merged_events,
    "templates_matched": templates_matched,
    "scoped_rule_match": scoped_rule_match,
    "experiment_rule_match": experiment_rule_match,
    "pattern_order": pattern_order,
    "pattern_high_freq": pattern_high_freq,
    "gated_alerts": gated_alerts,
    "pipeline_alerts": pipeline_alerts,
    "jsonl_roundtrip": jsonl_roundtrip,
    "csv_roundtrip": csv_roundtrip,
    "features_from_documents": features_from_documents,
    "rollup_from_documents": rollup_from_documents,
}
