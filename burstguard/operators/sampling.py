"""First, sampled and merged event rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_by_time(events: DataFrame, n: int) -> DataFrame:
    return events.orderBy("timestamp").limit(n)


def sample_rows(rows: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows at random, as a top-n over random numbers: each task keeps only its own best n."""
    return rows.withColumn("_r", F.rand(seed)).orderBy("_r").limit(n).drop("_r")


def merge_by_time(one: DataFrame, other: DataFrame) -> DataFrame:
    return one.unionByName(other, allowMissingColumns=True).orderBy("timestamp")
