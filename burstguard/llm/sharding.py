"""Sharding by proportional stratified interleaving.

Rows of a source are put in a seeded random order; row ``i`` of ``n`` gets the fractional rank ``(i - 1/2) / n``. All
sources sorted together by that rank are interleaved in proportion, so any contiguous piece has the mixture of the
whole, and cutting the order into equal pieces gives shards of the same mixture whose counts differ by one at most.

Ranks are found without a task that holds a whole source or the whole table: rows fall into ``BUCKETS`` ranges of
their random key (then of their fractional rank), small tables of bucket counts give each bucket's offset, and rows are
numbered inside buckets. Keys are hashes, so a bucket of even a source with a third of the rows is a small share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from burstguard.llm.common import written

BUCKETS = 4096
SEED = "interleave-1"


def random_key(seed: str, doc_id: Column, text: Column) -> Column:
    """60 random bits that follow from the seed and the row alone."""
    row = F.concat_ws("|", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(row), 1, 15), 16, 10).cast("long")


def interleave(docs: DataFrame, shards: int = 24, seed: str = SEED) -> DataFrame:
    """Return ``doc_id, size, text_crc32, source, position, shard, slot`` for every row of ``doc_id, text, source``.

    A null text is an empty one (size 8, CRC 0); a null source is a stratum of its own; a null doc_id stays null.
    Repeated rows are placed one by one; which of two equal rows comes first makes no difference. An empty table
    gives no rows. Other columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = written(
        docs.select(
            F.col("doc_id"),
            (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.col("source"),
            F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")).alias("stratum"),
            random_key(seed, F.col("doc_id"), F.col("text")).alias("key"),
        ).withColumn("bucket", F.shiftright("key", 48).cast("int"))
    )
    within = W.partitionBy("stratum").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    counts = (
        rows.groupBy("stratum", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "stratum",
            "bucket",
            F.coalesce(F.sum("n").over(within), F.lit(0)).alias("before"),
            F.sum("n").over(W.partitionBy("stratum")).alias("stratum_rows"),
        )
    )
    in_bucket = W.partitionBy("stratum", "bucket").orderBy("key", "doc_id", "text_crc32", "size")
    ranked = (
        rows.join(counts, ["stratum", "bucket"])
        .withColumn("rank", F.col("before") + F.row_number().over(in_bucket))
        .withColumn("fraction", (F.col("rank") - F.lit(0.5)) / F.col("stratum_rows"))
        .withColumn("cell", F.floor(F.col("fraction") * BUCKETS).cast("int"))
        .select("doc_id", "size", "text_crc32", "source", "stratum", "rank", "fraction", "cell")
    )
    ranked = written(ranked)
    # a row for each of at most BUCKETS cells: a window over all of them is bounded
    every = W.orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    cells = (
        ranked.groupBy("cell")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "cell",
            F.coalesce(F.sum("n").over(every), F.lit(0)).alias("before"),
            F.sum("n").over(W.partitionBy(F.lit(0))).alias("total"),
        )
    )
    in_cell = W.partitionBy("cell").orderBy("fraction", "stratum", "rank")
    placed = ranked.join(cells, "cell").withColumn("position", F.col("before") + F.row_number().over(in_cell) - 1)
    shard = F.expr(f"position * {shards} div total")
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        "source",
        "position",
        shard.cast("int").alias("shard"),
        # the first position of shard s is the least p with p * shards >= s * total
        F.expr(f"position - ((position * {shards} div total) * total + {shards - 1}) div {shards}").alias("slot"),
    )
