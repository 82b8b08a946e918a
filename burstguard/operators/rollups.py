"""Alert counts and shares. All are hash aggregations with map-side combining."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rollup_alerts(alerts: DataFrame, width: str = "1 minute", time: str = "alertTime") -> DataFrame:
    """Count and score total per time bucket and rule type.

    The total is stored, not the average, so partial results of one bucket can be added up;
    see ``average_score``. On a stream, put a watermark on ``time`` first.
    """
    return (
        alerts.groupBy(F.window(time, width).alias("w"), "ruleType")
        .agg(F.count("*").alias("cnt"), F.sum("riskScore").alias("scoreSum"))
        .select(F.col("w.start").alias("bucket"), "ruleType", "cnt", "scoreSum")
    )


def merge_rollups(rollups: DataFrame) -> DataFrame:
    """Partial buckets (several batches, several writers) added up."""
    return rollups.groupBy("bucket", "ruleType").agg(
        F.sum("cnt").alias("cnt"), F.sum("scoreSum").alias("scoreSum")
    )


def average_score(rollups: DataFrame) -> DataFrame:
    return rollups.withColumn("avgRiskScore", F.col("scoreSum") / F.col("cnt")).drop("scoreSum")


def type_share(alerts: DataFrame) -> DataFrame:
    """Alerts per rule type and their share of all; the window runs over the few grouped rows."""
    counts = alerts.groupBy("ruleType").agg(F.count("*").alias("cnt"))
    return counts.withColumn("share", F.col("cnt") / F.sum("cnt").over(Window.partitionBy()))


def top_sources(alerts: DataFrame, k: int = 10, source: str = "ip") -> DataFrame:
    """The ``k`` sources with the most alerts; equal counts by name."""
    return alerts.groupBy(source).agg(F.count("*").alias("cnt")).orderBy(F.desc("cnt"), source).limit(k)


def rule_totals(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("ruleId").agg(
        F.count("*").alias("alertCount"), F.sum("matchCount").alias("totalMatchCount")
    )
