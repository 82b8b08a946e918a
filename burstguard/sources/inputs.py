"""Topics and files as DataFrames with a ``value`` text column."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from burstguard.functions.text import integer_or_null
from burstguard.schemas import BEHAVIOR_COLUMNS
from burstguard.sources.arrays import array_elements
from burstguard.sources.decode import parse_once
from burstguard.sources.segments import TopicSegments

DISCOVERY_MS = 30_000


#: Servers of this form name a folder of exported topic segments instead of a broker.
SEGMENTS = "segments:"


def topic_format(spark: SparkSession, side, servers: str, topic: str):
    """A reader or writer of a topic: on a broker, or in the folder after ``segments:``."""
    if servers.startswith(SEGMENTS):
        spark.dataSource.register(TopicSegments)
        return side.format(TopicSegments.name()).option("path", servers.removeprefix(SEGMENTS)).option("topic", topic)
    return side.format("kafka").option("kafka.bootstrap.servers", servers)


def _topic(spark: SparkSession, stream: bool, servers: str, topic: str, starting: str, group: str | None) -> DataFrame:
    reader = topic_format(spark, spark.readStream if stream else spark.read, servers, topic)
    reader = reader.option("subscribe", topic).option("startingOffsets", starting)
    reader = reader.option("kafka.metadata.max.age.ms", str(DISCOVERY_MS))
    if group:
        reader = reader.option("groupIdPrefix", group)
    rows = reader.load()
    return rows.select(
        F.col("key").cast("string"), F.col("value").cast("string"), "partition", "offset",
        F.unix_millis("timestamp").alias("recordMs"),
    )


ORDER_BITS = 22
RULES_FIRST, EVENTS_AFTER = 0, 1 << 20
# Offsets of a range whose largest time is taken first.
RANGE_OFFSETS = 65_536


def _clock(rows: DataFrame) -> DataFrame:
    """Adds ``_clock``: the largest record time of a partition up to each offset. Ranges of offsets give their largest
    time first; a window then only sees one range, another only one row per range."""
    span = F.lit(RANGE_OFFSETS)
    ranged = rows.withColumn("_range", F.call_function("div", F.col("offset"), span))
    before = Window.partitionBy("partition").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    tops = (
        ranged.groupBy("partition", "_range").agg(F.max("recordMs").alias("_top"))
        .withColumn("_reached", F.max("_top").over(before)).drop("_top")
    )
    inside = Window.partitionBy("partition", "_range").orderBy("offset").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return ranged.join(tops, ["partition", "_range"]).withColumn(
        "_clock", F.greatest("_reached", F.max("recordMs").over(inside))
    ).drop("_range", "_reached")


def arrival_order(rows: DataFrame, lane: int = EVENTS_AFTER) -> DataFrame:
    """Replaces ``recordMs, partition, offset`` by ``seq``: one order of arrival over all partitions and topics.

    Records are ordered by their time, then partition and offset; within a partition the order of offsets holds, also
    where a producer's clock ran back, since a record counts as no earlier than those before it. All topics share the
    clock; in one millisecond records of lane ``RULES_FIRST`` come before those of ``EVENTS_AFTER``. A million records
    fit in a lane and millisecond.
    """
    same = Window.partitionBy("_clock").orderBy("partition", "offset")
    seq = F.shiftleft("_clock", ORDER_BITS) + lane + F.row_number().over(same) - 1
    return _clock(rows).withColumn("seq", seq).drop("_clock", "recordMs", "partition", "offset")


# Bits of the offset in a record's number; the partition stands above them.
OFFSET_BITS = 43


def stream_order(rows: DataFrame) -> DataFrame:
    """The order of arrival for a stream, where no record sees another: ``arrivedAt``, the record time, and ``seq``, a
    number of its own for every record of a topic (up to a million partitions of 8 * 10^12 records). Compared together
    they order by time, partition and offset; right where the broker stamps records, so that times rise with offsets."""
    number = F.shiftleft(F.col("partition").cast("bigint"), OFFSET_BITS).bitwiseOR(F.col("offset"))
    return rows.withColumns({"arrivedAt": F.col("recordMs"), "seq": number}).drop("recordMs", "partition", "offset")


def behavior_topic(
    spark: SparkSession, servers: str, topic: str, group: str | None = None, stream: bool = True, starting: str = "latest"
) -> DataFrame:
    """Events as they come, from the latest offset on, or as a batch all that are there.

    ``servers`` are those of a broker (needs Spark's connector on the class path) or ``segments:`` and a folder.
    """
    if not stream:
        return arrival_order(_topic(spark, False, servers, topic, "earliest", group))
    return stream_order(_topic(spark, True, servers, topic, starting, group))


def rule_topic(spark: SparkSession, servers: str, topic: str, group: str | None = None, stream: bool = False):
    """Rule documents from the earliest offset on."""
    rows = _topic(spark, stream, servers, topic, "earliest", f"{group}-rules" if group else None)
    return stream_order(rows) if stream else arrival_order(rows, RULES_FIRST)


def alert_topic(spark: SparkSession, servers: str, topic: str, group: str | None = None, stream: bool = False) -> DataFrame:
    """Alert texts as the alert table takes them: ``key, value`` and the record time."""
    return _topic(spark, stream, servers, topic, "earliest", group).select("key", "value", "recordMs")


def text_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """JSON lines dropped into a folder, as a stream of ``value``."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path)


def json_documents(spark: SparkSession, path: str) -> DataFrame:
    """Files of JSON lines, or each of one JSON array, one ``value`` per document, blank lines skipped.

    Every file is judged by itself: by the first character of its first line that is not blank. Both kinds are split
    across tasks, however the lines of an array fall; see ``arrays``.
    """
    file = F.col("_metadata.file_path").alias("_file")
    text = spark.read.text(path).select(
        file, F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_n"),
        F.trim(F.col("value"), F.lit(" \t\r\ufeff")).alias("value"),
    ).where(F.col("value") != "")
    arrays = (
        text.groupBy("_file").agg(F.min(F.struct("_block", "_n", F.substring("value", 1, 1).alias("c"))).alias("f"))
        .where(F.col("f.c") == "[").select("_file")
    )
    # one row per file
    lines = text.join(F.broadcast(arrays), "_file", "left_anti").select("value")
    return lines.unionByName(array_elements(spark, path, arrays))


def baseline_events(documents: DataFrame, now_ms: int | None = None) -> DataFrame:
    """Loose event documents to events: many names per field, a default for each, bad ones dropped."""
    names = ["userId", "user_id", "uid", "actionType", "action_type", "event_type", "timestamp", "ip",
             "ip_address", "sessionId", "session_id", "user_session", "productId", "product_id", "amount"]
    parsed = documents.where(F.json_object_keys("value").isNotNull()).select(
        *[c for c in documents.columns if c != "value"], parse_once("value", names).alias("j")
    ).where(F.col("j._corrupt").isNull())
    now = F.unix_millis(F.current_timestamp()) if now_ms is None else F.lit(now_ms)

    def pick(*fields: str) -> Column:
        return F.coalesce(*[F.nullif(F.col("j")[f], F.lit("")) for f in fields])

    user = F.coalesce(pick("userId", "user_id", "uid"), F.lit("unknown-user"))
    columns = {
        "userId": user,
        "actionType": F.upper(F.coalesce(pick("actionType", "action_type", "event_type"), F.lit("VIEW"))),
        "ip": F.coalesce(pick("ip", "ip_address"), F.lit("unknown-ip")),
        "timestamp": F.coalesce(integer_or_null(F.col("j.timestamp")),
                                F.col("j.timestamp").try_cast("double").try_cast("bigint"), now.cast("bigint")),
        "sessionId": F.coalesce(pick("sessionId", "session_id", "user_session"), F.concat(F.lit("s-"), user)),
        "productId": pick("productId", "product_id"),
        "amount": F.col("j.amount").try_cast("double"),
    }
    kept = [c for c in documents.columns if c != "value"]
    return parsed.select(*kept, *[columns[n].alias(n) if n in columns else F.lit(None).cast("string").alias(n)
                                  for n in BEHAVIOR_COLUMNS])


def captured_alerts(spark: SparkSession, path: str) -> DataFrame:
    """Alert documents from captured console output: the lines that are JSON objects."""
    lines = spark.read.text(path).select(F.trim("value").alias("value"))
    return lines.where(F.col("value").startswith("{") & F.json_object_keys("value").isNotNull())
