"""Latest alert features per user and per ip, with a time to live.

The last write to a key decides how long it lives: a later field value replaces an earlier one, a
missing field keeps the earlier one, and after ``ttl`` without a write the key is gone and starts
afresh. Rows are first combined per (key, bucket of one ttl): inside a bucket no gap can be a ttl
long, so gaps only need looking for between buckets. However many alerts one ip has, its second
step sees one row per ttl of time.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TTL_MS = 1_800_000
FIELDS = ["ruleType", "ip", "extra"]


def feature_updates(alerts: DataFrame, scope: str, at: str = "writtenAt", seq: str = "seq") -> DataFrame:
    """Alert rows as writes to the table of ``scope`` (``userId`` or ``ip``); rows without that key fall out."""
    return alerts.where(F.coalesce(F.col(scope) != "", F.lit(False))).select(
        F.col(scope).alias("featureKey"), F.col(at).alias("writtenAt"), F.col(seq).alias("seq"), *FIELDS
    ).where(F.coalesce(*FIELDS).isNotNull())


def _last_fields(order) -> list:
    """Last non-null value of each field with its place in the order of writes."""
    return [
        F.max(F.when(F.col(f).isNotNull(), F.struct(*order, F.col(f).alias("v")))).alias(f) for f in FIELDS
    ]


def feature_snapshot(updates: DataFrame, now_ms: int | None = None, ttl_ms: int = TTL_MS) -> DataFrame:
    """One row per live key: its fields and the time of the last write.

    ``now_ms`` is when the table is read; keys whose last write is a ttl or more before it are gone.
    """
    order = [F.col("writtenAt").alias("at"), F.col("seq").alias("seq")]
    buckets = (
        updates.withColumn("_bucket", F.expr(f"writtenAt div {ttl_ms}"))
        .groupBy("featureKey", "_bucket")
        .agg(F.min("writtenAt").alias("_from"), F.max("writtenAt").alias("_to"), *_last_fields(order))
    )
    by_key = Window.partitionBy("featureKey").orderBy("_bucket")
    lived_on = F.coalesce(F.col("_from") - F.lag("_to").over(by_key) < ttl_ms, F.lit(False))
    life = F.sum((~F.col("_alive")).cast("int")).over(by_key)
    in_lives = buckets.withColumn("_alive", lived_on).withColumn("_life", life)
    latest = (
        in_lives.groupBy("featureKey", "_life")
        .agg(F.max("_to").alias("writtenAt"), *[F.max(f).alias(f) for f in FIELDS])
        .groupBy("featureKey")
        .agg(F.max_by(F.struct("writtenAt", *FIELDS), "_life").alias("s"))
        .select("featureKey", "s.writtenAt", *[F.col(f"s.{f}.v").alias(f) for f in FIELDS])
    )
    return latest if now_ms is None else latest.where(F.lit(now_ms) - F.col("writtenAt") < ttl_ms)


def merge_features(stored: DataFrame, updates: DataFrame, ttl_ms: int = TTL_MS) -> DataFrame:
    """The table after a further batch of writes, ``stored`` being an earlier snapshot.

    The snapshot's rows stand for one write each, before those of the batch.
    """
    before = stored.select(
        "featureKey", "writtenAt", F.lit(-1).cast("bigint").alias("seq"), *FIELDS
    )
    return feature_snapshot(before.unionByName(updates), ttl_ms=ttl_ms)
