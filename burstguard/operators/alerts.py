"""Matches to scored, levelled alerts, and alerts to and from their documents."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burstguard.schemas import ALERT, BEHAVIOR_COLUMNS

# Fixed value: the text of an alert.
MESSAGE = "[%s] 检测到异常行为：用户[%s] IP[%s] 在时间段[%s ~ %s]内触发规则[%s]，匹配事件数：%d，阈值：%d"

RULE_FACTS = ["ruleId", "ruleName", "ruleType", "windowSizeMs", "threshold", "severityWeight", "scoreThreshold"]


def risk_score(count: Column, threshold: Column, window_ms: Column, weight: Column) -> Column:
    per_second = count / F.greatest(F.lit(1.0), window_ms / 1000.0)
    return weight * (
        1.0 + count / F.greatest(F.lit(1), threshold) + F.least(F.lit(1.5), per_second / 10.0)
    )


def alert_level(count: Column, threshold: Column) -> Column:
    ratio = count / threshold
    return (
        F.when(ratio >= 3.0, "CRITICAL").when(ratio >= 2.0, "HIGH").when(ratio >= 1.0, "MEDIUM").otherwise("LOW")
    )


def alert_message() -> Column:
    def clock(name: str) -> Column:
        return F.date_format(F.timestamp_millis(F.col(name)), "yyyy-MM-dd HH:mm:ss")

    return F.format_string(
        MESSAGE, "ruleType", "userId", "ip", clock("firstEventTimestamp"), clock("lastEventTimestamp"),
        "ruleName", "matchCount", "threshold",
    )


def alert_id() -> Column:
    """Same match, same id: a sink that retries can overwrite instead of doubling."""
    return F.sha2(F.concat_ws("|", "groupKey", "firstEventTimestamp", "lastEventTimestamp"), 256)


def score_matches(matches: DataFrame) -> DataFrame:
    """Alert columns for matches that carry their rule's columns; matches below the gate fall out.

    The gate comes after the matching on purpose: a match below it has still consumed its events.
    """
    n, window = F.col("matchCount"), F.col("windowSizeMs")
    scored = matches.withColumn(
        "riskScore", risk_score(n, F.col("threshold"), window, F.col("severityWeight"))
    )
    passed = scored.where(
        (F.col("riskScore") >= F.col("scoreThreshold"))
        & (F.col("lastEventTimestamp") - F.col("firstEventTimestamp") <= window)
    )
    return passed.select(
        alert_id().alias("alertId"),
        "ruleId",
        "ruleType",
        alert_level(n, F.col("threshold")).alias("level"),
        "userId",
        "ip",
        "deviceId",
        "matchCount",
        "riskScore",
        "firstEventTimestamp",
        "lastEventTimestamp",
        alert_message().alias("message"),
        F.lit(None).cast("string").alias("extra"),
        "groupKey",
        "eventSeqs",
        *[c for c in ["triggerEvents"] if c in matches.columns],
    )


def stamp_alerts(alerts: DataFrame, now_ms: Column | None = None) -> DataFrame:
    """Adds when the alert was raised and how far that is behind its last event."""
    now = F.unix_millis(F.current_timestamp()) if now_ms is None else now_ms
    return alerts.withColumn("alertTimestamp", now.cast("bigint")).withColumn(
        "processingLagMs", F.greatest(F.lit(0).cast("bigint"), F.col("alertTimestamp") - F.col("lastEventTimestamp"))
    )


def alert_evidence(alerts: DataFrame, events: DataFrame) -> DataFrame:
    """One row per alert and matched event, in order of ``place``.

    The relational form of the evidence: it never builds a long list in one row, and the
    join lets the optimizer use whichever side turns out small.
    """
    wanted = alerts.select("alertId", "ruleId", F.posexplode("eventSeqs").alias("place", "seq"))
    return wanted.join(events.select("seq", *BEHAVIOR_COLUMNS), "seq")


def with_trigger_events(alerts: DataFrame, events: DataFrame) -> DataFrame:
    """Alerts with their matched events nested as ``triggerEvents``."""
    item = F.struct("place", F.struct(*BEHAVIOR_COLUMNS).alias("event"))
    nested = (
        alert_evidence(alerts, events)
        .groupBy("alertId")
        .agg(F.transform(F.sort_array(F.collect_list(item)), lambda x: x["event"]).alias("triggerEvents"))
    )
    return alerts.join(nested, "alertId", "left")


def alert_documents(alerts: DataFrame) -> DataFrame:
    """Key, JSON value and record time of each alert, as a topic takes them."""
    fields = [F.col(f) if f in alerts.columns else F.lit(None).cast(ALERT[f].dataType).alias(f)
              for f in ALERT.fieldNames()]
    columns = [
        F.coalesce("userId", "alertId").alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
    ]
    if "alertTimestamp" in alerts.columns:
        columns.append(F.timestamp_millis("alertTimestamp").alias("timestamp"))
    return alerts.select(*columns)


def alert_lines(alerts: DataFrame) -> DataFrame:
    """One text line per alert, for a debugging sink."""
    stamped = alerts if "alertTimestamp" in alerts.columns else stamp_alerts(alerts)
    return stamped.select(
        F.format_string(
            "ALERT ruleType=%s ruleId=%s userId=%s matchCount=%d ts=%d",
            "ruleType", "ruleId", "userId", "matchCount", "alertTimestamp",
        ).alias("value")
    )


def parse_alerts(raw: DataFrame, value: str = "value") -> DataFrame:
    """Alert JSON text to the columns of the alert table: absent text is '', unusable numbers 0."""
    texts = ["alertId", "ruleId", "ruleType", "level", "userId", "ip", "deviceId", "message", "extra"]
    numbers = {
        "matchCount": ("matchCount", "bigint"),
        "riskScore": ("riskScore", "double"),
        "alertTimestamp": ("alertTimestampMs", "bigint"),
        "firstEventTimestamp": ("firstEventTimestampMs", "bigint"),
        "lastEventTimestamp": ("lastEventTimestampMs", "bigint"),
    }
    schema = ", ".join(f"`{n}` STRING" for n in [*texts, *numbers])
    j = raw.select(F.explode(F.array(F.from_json(value, schema))).alias("j"))  # one parse, see ``decode.parse_once``
    parsed = j.select(
        *[F.coalesce(F.col("j")[n], F.lit("")).alias(n) for n in texts],
        *[
            F.coalesce(F.col("j")[n].try_cast(kind), F.lit(0).cast(kind)).alias(name)
            for n, (name, kind) in numbers.items()
        ],
    )
    # A count is never negative; a negative text is unusable like any other.
    return parsed.withColumn("matchCount", F.greatest("matchCount", F.lit(0))).withColumn(
        "alertTime", F.timestamp_seconds(F.floor(F.col("alertTimestampMs") / 1000))
    )


def alert_writes(raw: DataFrame, value: str = "value") -> DataFrame:
    """Alert JSON text as rows for ``features.feature_updates``: absent text stays null, so that it replaces nothing.

    ``writtenAt`` is when the alert was raised; those of one millisecond are ordered by their last events.
    """
    names = ["userId", "ip", "ruleType", "extra", "alertTimestamp", "lastEventTimestamp"]
    parsed = F.from_json(value, ", ".join(f"`{n}` STRING" for n in names))
    whole = {n: F.coalesce(F.col(f"j.{n}").try_cast("bigint"), F.lit(0).cast("bigint")) for n in names[-2:]}
    j = raw.select(F.explode(F.array(parsed)).alias("j"))
    return j.where(F.col("j").isNotNull()).select(
        whole["lastEventTimestamp"].alias("seq"),
        whole["alertTimestamp"].alias("writtenAt"),
        *[F.nullif(F.col(f"j.{n}"), F.lit("")).alias(n) for n in names[:-2]],
    )


def with_alert_time(alerts: DataFrame, ms: str = "lastEventTimestamp") -> DataFrame:
    """``alertTime`` in whole seconds from an epoch-ms column."""
    return alerts.withColumn("alertTime", F.timestamp_seconds(F.expr(f"{ms} div 1000")))
