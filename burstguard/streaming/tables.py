"""Tables that streams keep: minute rollups of alerts, the latest features of a key, and the alert table.

A micro-batch that is run again, because the run stopped between its write and its commit, writes the same rows to the
same place: rollups and alerts go to folders of their query and batch, features live in the query's state.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener

from burstguard.operators.features import FIELDS, TTL_MS, feature_updates
from burstguard.operators.rollups import merge_rollups, rollup_alerts
from burstguard.session import ROCKSDB
from burstguard.sources.outputs import ALERT_ORDER, alert_table_rows, stream_id

ROLLUP_DDL = "bucket timestamp, ruleType string, cnt long, scoreSum double, stream string, batch long"


class LateRows(StreamingQueryListener):
    """Counts, per query id, the rows that came after their window was closed. ``spark.streams.addListener`` it."""

    def __init__(self):
        self.counts: Counter[str] = Counter()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        late = sum(o.numRowsDroppedByWatermark for o in event.progress.stateOperators)
        self.counts[str(event.progress.id)] += late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def rollup_table_stream(rows: DataFrame, path: str, checkpoint: str, delay: str = "1 minute", time: str = "alertTime"):
    """Rollups of a stream of alert rows, kept open for ``delay`` behind the newest alert.

    Every batch writes the buckets it has changed, whole, into a folder of its own; ``read_rollup_table`` takes the last
    state of each. Rows later than ``delay`` behind do not count any more; ``LateRows`` tells how many.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        stream = stream_id(batch.sparkSession, checkpoint)
        batch.write.mode("overwrite").parquet(f"{path}/stream={stream}/batch={batch_id}")

    rolled = rollup_alerts(rows.withWatermark(time, delay), time=time)
    return rolled.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)


def read_rollup_table(spark: SparkSession, path: str) -> DataFrame:
    """The rollups so far: the last state of each bucket of a stream, several streams added up."""
    states = spark.read.schema(ROLLUP_DDL).parquet(path)
    last = states.groupBy("stream", "bucket", "ruleType").agg(
        F.max_by(F.struct("cnt", "scoreSum"), "batch").alias("s")
    )
    return merge_rollups(last.select("bucket", "ruleType", "s.*"))


_PLACED = [f"{f}{part}" for f in FIELDS for part in ("", "At", "Seq")]
FEATURE_STATE = "bornAt long, writtenAt long, " + ", ".join(f"{f} string, {f}At long, {f}Seq long" for f in FIELDS)
FEATURE_DDL = "featureKey string, writtenAt long, " + ", ".join(f"{f} string" for f in FIELDS)


_FEATURE = Row("featureKey", "writtenAt", *FIELDS)


def _keep_latest(fields: dict[str, tuple], given: Iterable[tuple[str, tuple]]) -> None:
    for f, place in given:
        fields[f] = max(fields.get(f, place), place)


class FeatureProcessor(StatefulProcessor):
    """Per key: its fields, each with its place in the order of writes, and when its life began and was last written.

    A write that comes a time to live or more after the last one begins a new life; one that is as much older than the
    life it meets belongs to an earlier one and is left out. If ``expiring``, the state also goes by the clock. Rows of a key
    are taken one by one and not kept, so that neither many keys nor many rows of one make frames.
    """

    def __init__(self, ttl_ms: int, expiring: bool):
        self.ttl_ms, self.expiring = ttl_ms, expiring

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.feature = handle.getValueState("feature", FEATURE_STATE, self.ttl_ms if self.expiring else None)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        born = written = None
        fields: dict[str, tuple] = {}
        held = self.feature.get()
        if held is not None:
            born, written, *rest = held[: 2 + 3 * len(FIELDS)]
            triples = zip(FIELDS, rest[::3], rest[1::3], rest[2::3])
            fields = {f: (at, seq, value) for f, value, at, seq in triples if value is not None}
        # a span of one time to live holds no gap in which a life could end, so a row for each will do
        spans: dict[int, list] = {}
        for row in rows:
            at, seq = row.writtenAt, row.seq
            if born is not None and at + self.ttl_ms <= born:
                continue
            span = spans.get(at // self.ttl_ms)
            if span is None:
                span = spans[at // self.ttl_ms] = [at, at, {}]
            span[0], span[1] = min(span[0], at), max(span[1], at)
            _keep_latest(span[2], ((f, (at, seq, row[f])) for f in FIELDS if row[f] is not None))
        for _, (first, last, latest) in sorted(spans.items()):
            if written is None or first - written >= self.ttl_ms:
                born, written, fields = first, first, {}
            born, written = min(born, first), max(written, last)
            _keep_latest(fields, latest.items())
        if written is None:
            return
        flat = [x for f in FIELDS for at, seq, value in [fields.get(f, (None, None, None))] for x in (value, at, seq)]
        self.feature.update((born, written, *flat))
        yield _FEATURE(key[0], written, *flat[::3])

    def close(self) -> None:
        pass


def feature_state_stream(alerts: DataFrame, scope: str, ttl_ms: int = TTL_MS, expiring: bool = True) -> DataFrame:
    """Features of ``scope`` after each batch, for the keys it has written, from a stream of alert rows (``writtenAt``,
    ``seq``, see ``alerts.alert_writes``). What is live at any time is in the query's state: ``read_feature_state``.

    A state that goes by the clock suits a query that stays up; it keeps a query going that is to end with its data, so
    that an ``availableNow`` run needs ``expiring=False`` and leaves dead keys to the reader."""
    alerts.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return feature_updates(alerts, scope).groupBy("featureKey").transformWithState(
        statefulProcessor=FeatureProcessor(ttl_ms, expiring), outputStructType=FEATURE_DDL, outputMode="Update",
        timeMode="ProcessingTime" if expiring else "None",
    )


def read_feature_state(spark: SparkSession, checkpoint: str, now_ms: int | None = None, ttl_ms: int = TTL_MS) -> DataFrame:
    """Live features out of the state of the query at ``checkpoint``; with ``now_ms`` without those written a time to live
    before it."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "feature").load()
    value = F.col("value.value") if "value" in state.schema["value"].dataType.fieldNames() else F.col("value")
    rows = state.select(F.col("key.featureKey").alias("featureKey"), value.alias("v")).select(
        "featureKey", "v.writtenAt", *[f"v.{f}" for f in FIELDS]
    )
    return rows if now_ms is None else rows.where(F.lit(now_ms) - F.col("writtenAt") < ttl_ms)


def alert_table_stream(raw: DataFrame, path: str, checkpoint: str, horizon: str = "1 day"):
    """A stream of alert texts into the alert table, every alert once.

    An alert that is delivered again within ``horizon`` of its first delivery is known by its ``alertId``; texts without
    one are known as a whole. Each batch overwrites only what it has written itself, by month and batch.
    """
    rows = alert_table_rows(raw)
    whole = F.sha2(F.to_json(F.struct(*rows.columns)), 256)
    known = F.when(F.col("alertId") != "", F.col("alertId")).otherwise(whole)
    # the time of delivery is never late, so that old alerts are kept
    timed = rows.withColumns({"_known": known, "_delivered": F.current_timestamp()}).withWatermark("_delivered", horizon)
    once = timed.dropDuplicatesWithinWatermark(["_known"]).drop("_known", "_delivered")

    def write(batch: DataFrame, batch_id: int) -> None:
        name = f"{stream_id(batch.sparkSession, checkpoint)}-{batch_id}"
        (
            batch.withColumn("batch", F.lit(name)).sortWithinPartitions(*ALERT_ORDER).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("month", "batch").parquet(path)
        )

    return once.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def read_alert_table(spark: SparkSession, path: str) -> DataFrame:
    """The alert table; a condition on ``month`` leaves the folders of other months unread."""
    return spark.read.option("mergeSchema", "false").parquet(path).drop("batch").withColumn("month", F.col("month").cast("string"))


def run_now(writer):
    """Runs a stream over all that is there, and gives the query; its failure is raised."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query
