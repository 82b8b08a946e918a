"""Detection quality against labelled users, latency, and case tables."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from burstguard.session import materialize

# The rule types of an evaluation and their labels; result columns of a case.
RULE_LABELS = {
    "ABNORMAL_LOGIN": "Abnormal Login",
    "ORDER_BRUSH": "Order Brush",
    "HIGH_FREQ_ACCESS": "High Frequency Access",
}
CASE_COLUMNS = [
    "case", "parallelism", "window", "backend", "events", "alerts", "alerts_raw_total",
    "unexpected_alerts", "scope_valid", "throughput", "avg_latency_ms", "p99_latency_ms", "cpu_pct",
    "mem_mb", "expected_positive_users", "detected_users", "tp_users", "fp_users", "fn_users",
    "precision", "recall", "f1", "macro_precision", "macro_recall", "macro_f1",
]
RULE_METRIC_COLUMNS = [
    "case", "rule_type", "rule_label", "expected_users", "detected_users", "tp_users", "fp_users",
    "fn_users", "precision", "recall", "f1",
]
CASE_FAMILIES = {"p": "parallelism", "w": "window", "b": "backend", "s": "events"}
REFERENCE_CASES = ["w60000", "p4"]


def lag_cap_ms(window_ms: int) -> int:
    return max(120_000, 5 * window_ms)


def alert_lag(window_ms: int) -> Column:
    """Processing lag, or alert time behind the last event, kept within 0 and the cap; null if unusable."""
    cap = F.lit(float(lag_cap_ms(window_ms)))
    stated = F.col("processingLagMs").try_cast("double")
    measured = F.col("alertTimestamp").try_cast("double") - F.col("lastEventTimestamp").try_cast("double")
    lag = F.coalesce(stated, measured)
    return F.when(lag.isNotNull(), F.greatest(F.lit(0.0), F.least(lag, cap)))


def with_scope(alerts: DataFrame, rule_ids: DataFrame) -> DataFrame:
    """Alerts with ``in_scope``: whether they come from one of the given rules."""
    ids = rule_ids.select("ruleId").distinct().withColumn("_own", F.lit(True))
    return alerts.join(ids, "ruleId", "left").withColumn("in_scope", F.coalesce("_own", F.lit(False))).drop("_own")


def split_scope(alerts: DataFrame, rule_ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Alerts of the given rules and the others. Where both are used, ``with_scope`` gives them in one pass."""
    flagged = with_scope(alerts, rule_ids)
    return flagged.where("in_scope").drop("in_scope"), flagged.where(~F.col("in_scope")).drop("in_scope")


def alerts_by(alerts: DataFrame, column: str) -> DataFrame:
    return alerts.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("unknown")).alias(column)).agg(
        F.count("*").alias("cnt")
    )


def verification_summary(alerts: DataFrame, rule_ids: DataFrame) -> DataFrame:
    """One row: totals in and out of scope, affected users, and which types and foreign rules were seen."""
    seen = with_scope(alerts, rule_ids)
    own = F.col("in_scope")
    return seen.agg(
        F.count("*").alias("alerts_raw_total"),
        F.count_if(own).alias("alerts_scoped_total"),
        F.count_if(~own).alias("unexpected_alerts"),
        (F.count_if(~own) == 0).alias("scope_valid"),
        F.count_distinct(F.when(own & (F.col("userId") != ""), F.col("userId"))).alias("affected_users"),
        F.sort_array(F.collect_set(F.when(own, F.coalesce("ruleType", F.lit("unknown"))))).alias("recognized_types"),
        F.sort_array(F.collect_set(F.when(~own & (F.col("ruleId") != ""), F.col("ruleId")))).alias(
            "unexpected_rule_ids"
        ),
    )


def dedup_alerts(alerts: DataFrame, window_ms: int, seq: str = "seq") -> DataFrame:
    """Per rule type and user the alert with the least lag, unknown lag last, then the first by ``seq``.

    An aggregation rather than a ranking window: only one alert per key and task is shuffled.
    """
    kind, user = F.trim("ruleType"), F.trim("userId")
    lag = alert_lag(window_ms)
    columns = alerts.columns
    best = F.min_by(F.struct(*columns), F.struct(lag.isNull(), lag, F.col(seq)))
    return (
        alerts.where(F.coalesce((kind != "") & (user != ""), F.lit(False)))
        .groupBy(kind.alias("_kind"), user.alias("_user"))
        .agg(best.alias("a"))
        .select("a.*")
    )


def abnormal_users(alerts: DataFrame) -> DataFrame:
    return (
        alerts.select(F.trim("ruleType").alias("rule_type"), F.trim("userId").alias("user"))
        .where(F.coalesce((F.col("rule_type") != "") & (F.col("user") != ""), F.lit(False)))
        .distinct()
    )


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _f1(p: Column, r: Column) -> Column:
    return F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))


def _with_scores(counts: DataFrame) -> DataFrame:
    tp, fp, fn = F.col("tp_users"), F.col("fp_users"), F.col("fn_users")
    return (
        counts.withColumn("precision", _ratio(tp, tp + fp))
        .withColumn("recall", _ratio(tp, tp + fn))
        .withColumn("f1", _f1(F.col("precision"), F.col("recall")))
    )


def _labels(spark: SparkSession, labels: dict[str, str]) -> DataFrame:
    pairs = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return spark.range(1).select(F.explode(pairs).alias("rule_type", "rule_label"))


def _raw_quality(alerts: DataFrame, expected: DataFrame, labels: dict[str, str]) -> DataFrame:
    """Counts and exact scores per rule type; types never seen count 0. One full outer join of the
    distinct (type, user) pairs of both sides gives hits, misses and false alarms at once."""
    detected = abnormal_users(alerts).withColumn("_detected", F.lit(True))
    wanted = expected.select("rule_type", "user").distinct().withColumn("_expected", F.lit(True))
    both = detected.join(wanted, ["rule_type", "user"], "full_outer")
    d, e = F.col("_detected").isNotNull(), F.col("_expected").isNotNull()
    counts = both.groupBy("rule_type").agg(
        F.count_if(e).alias("expected_users"),
        F.count_if(d).alias("detected_users"),
        F.count_if(d & e).alias("tp_users"),
        F.count_if(d & ~e).alias("fp_users"),
        F.count_if(~d & e).alias("fn_users"),
    )
    kept = _labels(alerts.sparkSession, labels).join(counts, "rule_type", "left").na.fill(0)
    return _with_scores(kept)


def quality_by_rule(
    alerts: DataFrame, expected: DataFrame, case: str, labels: dict[str, str] = RULE_LABELS
) -> DataFrame:
    """Users found, missed and wrongly accused per rule type, with precision, recall and F1."""
    rows = _raw_quality(alerts, expected, labels).withColumn("case", F.lit(case))
    for name in ["precision", "recall", "f1"]:
        rows = rows.withColumn(name, F.round(name, 6))
    return rows.select(*RULE_METRIC_COLUMNS)


def quality_summary(alerts: DataFrame, expected: DataFrame, labels: dict[str, str] = RULE_LABELS) -> DataFrame:
    """Micro scores over all users and macro scores as the mean over the rule types."""
    totals = _raw_quality(alerts, expected, labels).agg(
        *[
            F.sum(c).alias(a)
            for c, a in [
                ("expected_users", "expected_positive_users"),
                ("detected_users", "detected_users"),
                ("tp_users", "tp_users"),
                ("fp_users", "fp_users"),
                ("fn_users", "fn_users"),
            ]
        ],
        *[F.avg(c).alias(f"macro_{c}") for c in ["precision", "recall", "f1"]],
    )
    rows = _with_scores(totals)
    scores = ["precision", "recall", "f1", "macro_precision", "macro_recall", "macro_f1"]
    return rows.select(
        *[c for c in rows.columns if c not in scores], *[F.round(c, 6).alias(c) for c in scores]
    )


def latency_summary(alerts: DataFrame, window_ms: int) -> DataFrame:
    """Mean and nearest-rank 99th percentile of the lag; both 0 without usable alerts.

    Lags are counted per value and, about as many values at a time as there are ranges, per range. The rank is found
    among the ranges and then inside one, so neither ranking sees more rows than the root of the cap. Both read the
    exchange of the counted values.
    """
    width = int(lag_cap_ms(window_ms) ** 0.5) + 1
    lags = alerts.where(F.col("alertTimestamp").isNotNull()).select(alert_lag(window_ms).alias("lag"))
    values = lags.where(F.col("lag").isNotNull()).groupBy("lag").agg(F.count("*").alias("n"))
    counted = values.withColumn("range", F.floor(F.col("lag") / width))
    upto = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = counted.groupBy("range").agg(F.sum("n").alias("rows"), F.sum(F.col("lag") * F.col("n")).alias("sum"))
    # ceil(0.99 n) in whole numbers
    at = F.expr("(99 * _all + 99) div 100")
    ranked = (
        ranges.withColumn("_upto", F.sum("rows").over(upto))
        .withColumn("_all", F.sum("rows").over(Window.partitionBy()))
        .withColumn("_total", F.sum("sum").over(Window.partitionBy()))
    )
    hit = ranked.where((F.col("_upto") >= at) & (F.col("_upto") - F.col("rows") < at)).select(
        "range", (at - (F.col("_upto") - F.col("rows"))).alias("_left"), (F.col("_total") / F.col("_all")).alias("_mean")
    )
    inside = Window.partitionBy("range").orderBy("lag").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fine = counted.join(F.broadcast(hit), "range").withColumn("_upto", F.sum("n").over(inside))  # one row is broadcast
    return fine.agg(
        F.coalesce(F.max("_mean"), F.lit(0.0)).alias("avg_latency_ms"),
        F.coalesce(F.min(F.when(F.col("_upto") >= F.col("_left"), F.col("lag"))), F.lit(0.0)).alias("p99_latency_ms"),
    )


def case_summary(
    alerts: DataFrame,
    rule_ids: DataFrame,
    expected: DataFrame,
    load: DataFrame,
    case: str,
    window_ms: int,
    parallelism: int = 1,
    backend: str = "",
    cpu_pct: float | None = None,
    mem_mb: float | None = None,
) -> DataFrame:
    """The result row of one case. ``load`` is one row of ``events`` and ``seconds``, what was sent and how long it took.

    The alerts are evaluated once, as a written table; its aggregates of one row each are put side by side.
    """
    used = ["ruleId", "ruleType", "userId", "alertTimestamp", "processingLagMs", "lastEventTimestamp"]
    flagged = materialize(with_scope(alerts.select(*used), rule_ids))
    scoped = flagged.where("in_scope").drop("in_scope")
    own = F.col("in_scope")
    scope = flagged.agg(
        F.count_if(own).alias("alerts"),
        F.count("*").alias("alerts_raw_total"),
        F.count_if(~own).alias("unexpected_alerts"),
        (F.count_if(~own) == 0).alias("scope_valid"),
    )
    latency = latency_summary(scoped, window_ms).select(
        F.round("avg_latency_ms", 3).alias("avg_latency_ms"), F.round("p99_latency_ms", 3).alias("p99_latency_ms")
    )
    speed = load.select(
        F.col("events").cast("int").alias("events"),
        F.round(F.when(F.col("seconds") > 0, F.col("events") / F.col("seconds")).otherwise(0.0), 6).alias("throughput"),
    )
    parts = scope
    for part in [latency, quality_summary(scoped, expected), speed]:
        parts = parts.unionByName(part, allowMissingColumns=True)
    row = parts.agg(*[F.first(c, ignorenulls=True).alias(c) for c in parts.columns])
    return row.select(
        "*",
        F.lit(case).alias("case"),
        F.lit(parallelism).alias("parallelism"),
        F.lit(window_ms).alias("window"),
        F.lit(backend).alias("backend"),
        F.lit(cpu_pct).cast("double").alias("cpu_pct"),
        F.lit(mem_mb).cast("double").alias("mem_mb"),
    ).select(*CASE_COLUMNS)


def latency_censored(avg: Column | None = None, window: Column | None = None) -> Column:
    """Whether a mean lag is so near the cap that the cap decided it."""
    avg = F.col("avg_latency_ms") if avg is None else avg
    window = F.col("window") if window is None else window
    cap = F.greatest(F.lit(120_000), 5 * F.coalesce(window, F.lit(60_000)))
    return F.coalesce((avg > 0) & (avg >= cap * 0.98), F.lit(False))


def detection_rate(cases: DataFrame) -> DataFrame:
    """Alerts of each case relative to the case with the most; 0 when there are none at all."""
    count = F.greatest(
        F.coalesce(F.col("alerts").cast("double"), F.lit(0.0)),
        F.coalesce(F.col("alerts_raw_total").cast("double"), F.lit(0.0)),
    )
    counted = materialize(cases.withColumn("_count", count))
    most = counted.agg(F.max("_count").alias("_most"))  # one row
    rate = F.when(F.col("_most") > 0, F.col("_count") / F.col("_most")).otherwise(F.lit(0.0))
    return counted.crossJoin(F.broadcast(most)).withColumn("detection_rate", rate).drop("_count", "_most")


def case_family(cases: DataFrame, prefix: str) -> DataFrame:
    """The cases of one sweep, ordered by what it varies."""
    return cases.where(F.col("case").startswith(prefix)).orderBy(CASE_FAMILIES[prefix], "case")


def reference_case_rows(rule_rows: DataFrame, seq: str = "seq") -> DataFrame:
    """Rows of the case to show: a preferred one if present, else the first."""
    name = F.trim("case")
    rank = F.lit(len(REFERENCE_CASES))
    for i, preferred in reversed(list(enumerate(REFERENCE_CASES))):
        rank = F.when(name == preferred, i).otherwise(rank)
    chosen = (
        rule_rows.where(name != "").groupBy(name.alias("_case")).agg(F.min(F.struct(rank, F.col(seq))).alias("o"))
        .orderBy("o").limit(1)
    )
    return rule_rows.join(chosen, name == F.col("_case"), "left_semi")
