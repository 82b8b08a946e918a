"""Sinks: topics, files, consoles and tables, for batches and streams."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from burstguard.operators.alerts import alert_documents, parse_alerts
from burstguard.operators.features import TTL_MS, feature_snapshot, feature_updates, merge_features
from burstguard.operators.rules import is_enabled_rule, is_valid_rule
from burstguard.schemas import BEHAVIOR_COLUMNS, RULE_COLUMNS
from burstguard.sources.arrays import as_arrays
from burstguard.sources.inputs import topic_format


def event_documents(events: DataFrame) -> DataFrame:
    """Events as keyed JSON documents, absent fields written as null."""
    body = F.struct(*[c for c in BEHAVIOR_COLUMNS if c in events.columns])
    return events.select(F.col("userId").alias("key"), F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))


def rule_documents(rules: DataFrame) -> DataFrame:
    """Rules as keyed JSON documents with the two derived flags."""
    body = F.struct(
        *[c for c in RULE_COLUMNS if c in rules.columns],
        is_enabled_rule().alias("enabled"),
        is_valid_rule().alias("valid"),
    )
    return rules.select(F.col("ruleId").alias("key"), F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))


def document_key(field: str = "") -> Column:
    """A field of the document as its key; null without a field name or where it is absent."""
    return F.get_json_object("value", f"$.{field}") if field.strip() else F.lit(None).cast("string")


def keyed_documents(documents: DataFrame, field: str = "") -> DataFrame:
    return documents.select(document_key(field).alias("key"), "value")


def write_lines(documents: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One document per line, written in parallel."""
    documents.select("value").write.mode(mode).text(path)


def write_rule_array(rules: DataFrame, path: str, mode: str = "errorifexists", files: int | None = 1) -> None:
    """A rule set as JSON arrays, one in each of ``files``, written side by side in order of the rule ids. ``None``: as many
    files as the size of the rules asks for."""
    docs = rule_documents(rules).select("key", "value")
    ranges = ["key"] if files is None else [files, "key"]
    dealt = docs.coalesce(1) if files == 1 else docs.repartitionByRange(*ranges)
    as_arrays(dealt.sortWithinPartitions("key", "value")).write.mode(mode).text(path)


def write_topic(documents: DataFrame, servers: str, topic: str, partitions: int | None = None) -> None:
    """Documents (``key, value``, perhaps ``partition`` and ``timestamp``) to a topic; see ``inputs.topic_format``.
    ``partitions`` is their number where the topic is a folder of segments."""
    writer = topic_format(documents.sparkSession, documents.write, servers, topic).option("topic", topic)
    if partitions:
        writer = writer.option("partitions", partitions)
    writer.mode("append").save()


def alert_topic_stream(alerts: DataFrame, servers: str, topic: str, checkpoint: str):
    """Alerts to a topic, at least once; a repeated alert carries the same ``alertId``. In a folder of segments a batch
    that is run again is recognised by the checkpoint and written once."""
    documents = alert_documents(alerts)
    writer = topic_format(alerts.sparkSession, documents.writeStream, servers, topic)
    return writer.option("topic", topic).option("writer", checkpoint).option("checkpointLocation", checkpoint)


def alert_file_stream(alerts: DataFrame, path: str, checkpoint: str):
    """Alert documents as lines in files; each micro-batch is committed once."""
    return (
        alert_documents(alerts)
        .select("value")
        .writeStream.format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def console_stream(lines: DataFrame):
    return lines.writeStream.format("console").option("truncate", "false")


def alert_table_rows(raw: DataFrame) -> DataFrame:
    """Alert texts as rows of the alert table, with the month it is partitioned by."""
    return parse_alerts(raw).withColumn("month", F.date_format("alertTime", "yyyyMM"))


# Order of rows inside the files of the alert table.
ALERT_ORDER = ["month", "alertTime", "ruleType", "ruleId", "ip", "userId"]


def append_alert_table(raw: DataFrame, path: str) -> None:
    """Parsed alerts appended to the table: months are folders, and rows are ordered inside files. A stream goes to it
    through ``streaming.tables``."""
    alert_table_rows(raw).sortWithinPartitions(*ALERT_ORDER).write.mode("append").partitionBy("month").parquet(path)


def rollup_stream(rollups: DataFrame, path: str, checkpoint: str):
    """Closed buckets of a watermarked rollup, appended once each."""
    return (
        rollups.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a query keeps in its checkpoint. A reset checkpoint counts batches from 0 again, under another id, so
    folders named by both are never mistaken for those of the query before."""
    return spark.read.text(f"{checkpoint}/metadata").select(F.get_json_object("value", "$.id")).first()[0]


def append_feature_updates(updates: DataFrame, path: str, batch_id: int, stream: str = "main") -> None:
    """One batch of feature writes, in a folder of its own: cost follows the batch, not the table,
    and a repeated batch overwrites only itself."""
    updates.write.mode("overwrite").parquet(f"{path}/updates/stream={stream}/batch={batch_id}")


def _last_compaction(spark: SparkSession, path: str) -> int | None:
    if not _exists(spark, f"{path}/compacted"):
        return None
    return spark.read.parquet(f"{path}/compacted").agg(F.max("upto")).first()[0]


def read_feature_table(
    spark: SparkSession, path: str, now_ms: int | None = None, ttl_ms: int = TTL_MS
) -> DataFrame:
    """Live features: the last compacted table with the writes since then. ``ttl_ms`` is that of the writers."""
    updates = spark.read.parquet(f"{path}/updates")
    upto = _last_compaction(spark, path)
    if upto is None:
        return feature_snapshot(updates.drop("stream", "batch"), now_ms, ttl_ms)
    table = spark.read.parquet(f"{path}/compacted/upto={upto}")
    folded = spark.read.parquet(f"{path}/folded/upto={upto}")
    since = updates.join(folded, ["stream", "batch"], "left_anti").drop("stream", "batch")
    merged = merge_features(table, since, ttl_ms)
    return merged if now_ms is None else merged.where(F.lit(now_ms) - F.col("writtenAt") < ttl_ms)


def compact_feature_table(
    spark: SparkSession, path: str, now_ms: int | None = None, ttl_ms: int = TTL_MS
) -> None:
    """Folds all writes so far into a new table, so that reads stay cheap; run now and then. With ``now_ms`` keys that
    are dead by then are left out. The list of folded batches is written first; a table without its list is never read."""
    last = _last_compaction(spark, path)
    upto = 0 if last is None else last + 1
    updates = spark.read.parquet(f"{path}/updates")
    updates.select("stream", "batch").distinct().write.mode("overwrite").parquet(f"{path}/folded/upto={upto}")
    folded = spark.read.parquet(f"{path}/folded/upto={upto}")
    known = updates.join(folded, ["stream", "batch"], "left_semi")
    if last is None:
        table = feature_snapshot(known.drop("stream", "batch"), now_ms, ttl_ms)
    else:
        before = spark.read.parquet(f"{path}/folded/upto={last}")
        since = known.join(before, ["stream", "batch"], "left_anti").drop("stream", "batch")
        table = merge_features(spark.read.parquet(f"{path}/compacted/upto={last}"), since, ttl_ms)
        table = table if now_ms is None else table.where(F.lit(now_ms) - F.col("writtenAt") < ttl_ms)
    table.write.mode("overwrite").parquet(f"{path}/compacted/upto={upto}")


def feature_table_stream(alerts: DataFrame, scope: str, path: str, checkpoint: str):
    """Alert rows (with ``writtenAt`` and ``seq``, see ``alerts.alert_writes``) into the feature table of ``scope``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        stream = stream_id(batch.sparkSession, checkpoint)
        append_feature_updates(feature_updates(batch, scope), path, batch_id, stream)

    return alerts.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def write_csv(rows: DataFrame, path: str, columns: list[str], mode: str = "errorifexists") -> None:
    """Fixed columns with a header."""
    rows.select(*columns).write.mode(mode).csv(path, header=True)
