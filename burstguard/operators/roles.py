"""The part an event plays in a rule's detector."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstguard.functions.actions import LARGE_FROM, SMALL_BELOW


def with_roles(matched: DataFrame, small_below: float = SMALL_BELOW, large_from: float = LARGE_FROM) -> DataFrame:
    """Pairs some detector works on, each with its ``role``: the part of its action, with payments
    told apart by amount (NaN counts as neither small nor large)."""
    amount = F.col("amount")
    by_amount = (
        F.when(F.isnan(amount), "other").when(amount < small_below, "small").when(amount >= large_from, "large")
        .otherwise("other")
    )
    return matched.where(F.col("part").isNotNull()).withColumn(
        "role", F.when(F.col("part") == "payment", by_amount).otherwise(F.col("part"))
    )
