"""Structured Streaming detection with keyed state."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from burstguard.operators import registry
from burstguard.operators.alerts import score_matches
from burstguard.operators.match import match_rules
from burstguard.operators.rules import active_rules
from burstguard.schemas import LATENESS_MS
from burstguard.session import ROCKSDB
from burstguard.sources.outputs import _exists, stream_id
from burstguard.streaming.arrival import (
    ARRIVAL_COLUMNS,
    ARRIVAL_MATCH_SCHEMA,
    ARRIVAL_ORDER,
    EVENT_FIELDS,
    arrival_rows,
    arrivals,
    match_frame,
    own_detectors,
    take_in,
)
from burstguard.streaming.timeline import KeyBuffer

EVENT_STATE = (
    "seq long, role string, userId string, actionType string, ip string, timestamp long, sessionId string, "
    "deviceId string, productId string, amount double, extra string"
)
_EVENTS = f"array<struct<no:long,{EVENT_STATE.replace(' ', ':').replace(',:', ',')}>>"
MARKS_STATE = (
    "newest long, emitted long, arrived long, cleanTime long, cleanNo long, floor long, stored long, "
    f"detector string, windowSizeMs long, threshold int, firstChunk long, chunks long, few {_EVENTS}"
)
_TIME, _ROLE, _IP = (EVENT_FIELDS.index(f) for f in ("timestamp", "role", "ip"))
# Groups of keys that share one call of the processor.
SHARDS = 1024
# Up to so many live events stand beside a key's marks; more are kept in chunks.
FEW_EVENTS, CHUNK_EVENTS = 64, 4096
# Matches handed on, and rows taken up, at once.
OUT_ROWS, ROWS_AT_ONCE = 5_000, 20_000


class SequenceProcessor(StatefulProcessor):
    """Per shard of keys: for each key the live events and where the search for matches stands.

    A micro-batch may touch very many keys with few events each, so keys share the call, not one frame a key, and a key
    costs one read and one write of its state. Rows come in several pieces in no set order, so those of a micro-batch are
    gathered and put in order of key and arrival first. Few live events are kept with the marks. More stand in numbered
    chunks: new events are a new chunk, and chunks are only written anew after a match, when the rule's window has changed,
    or when more than half of the events is out of date. An optional time to live lets idle keys go; it must exceed window +
    lateness.
    """

    def __init__(self, ttl_ms: int | None = None, own: dict | None = None):
        self.ttl_ms, self.own = ttl_ms, own

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.marks = handle.getMapState("marks", "groupKey string", MARKS_STATE, self.ttl_ms)
        self.events = handle.getMapState("events", "groupKey string, chunk long", f"events {_EVENTS}", self.ttl_ms)

    def _loaded(self, key: str) -> tuple[KeyBuffer, tuple[int, int, int]]:
        buffer, held = KeyBuffer(self.own), (0, 0, 0)
        marks = self.marks.getValue((key,)) if self.known else None
        if marks is not None:
            (buffer.newest, buffer.emitted, buffer.arrived, time, no, buffer.floor, *rest) = marks
            stored, *shape, first, chunks, few = rest
            buffer.clean, buffer.shape, held = (time, no), (shape[0], int(shape[1]), int(shape[2])), (stored, first, chunks)
            kept = [tuple(row) for row in few or ()]
            for chunk in range(first, first + chunks):
                kept += [tuple(row) for row in self.events.getValue((key, chunk))[0]]
            live = sorted((row[1 + _TIME], row[0], row[1:]) for row in kept if row[1 + _TIME] >= buffer.floor)
            for time, no, event in live:
                buffer.restore((time, no), event, event[_ROLE], event[_IP].lower() if event[_IP] else None)
        return buffer, held

    def _save(self, key: str, buffer: KeyBuffer, held: tuple[int, int, int], arrived: int, shape: tuple | None) -> None:
        """Writes back a key that had ``arrived`` events and the rule ``shape`` before this micro-batch."""
        stored, first, chunks = held
        few, live = [], [(no, *event) for (_, no), (event, _, _) in buffer.events.items()]
        new = [row for row in live if row[0] >= arrived]
        outdated = buffer.emptied or buffer.shape != shape or stored + len(new) > 2 * len(live) + 64
        if outdated or not chunks:
            for chunk in range(first, first + chunks):
                self.events.removeKey((key, chunk))
            first, chunks, stored, new = first + chunks, 0, len(live), live
            if len(live) <= FEW_EVENTS:
                few, new = live, []
        else:
            stored += len(new)
        for begin in range(0, len(new), CHUNK_EVENTS):
            self.events.updateValue((key, first + chunks), (new[begin : begin + CHUNK_EVENTS],))
            chunks += 1
        place = (buffer.newest, buffer.emitted, buffer.arrived, *buffer.clean, buffer.floor, stored, *buffer.shape)
        self.marks.updateValue((key,), (*place, first, chunks, few))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        arrived = pd.concat(list(rows), ignore_index=True).sort_values(["groupKey", *ARRIVAL_ORDER], kind="stable")
        self.known = self.marks.exists()
        current, buffer, before, out = None, None, (), []
        # pieces bound what stands as single values at a time
        for begin in range(0, len(arrived), ROWS_AT_ONCE):
            for group_key, event, rule in arrivals(arrived.iloc[begin : begin + ROWS_AT_ONCE]):
                if group_key != current:
                    if buffer is not None:
                        self._save(current, buffer, *before)
                    current, (buffer, held) = group_key, self._loaded(group_key)
                    before = (held, buffer.arrived, buffer.shape)
                found = take_in(buffer, group_key, event, rule)
                if found:
                    out.append(found)
            if len(out) >= OUT_ROWS:
                yield match_frame(out)
                out = []
        if buffer is not None:
            self._save(current, buffer, *before)
        yield match_frame(out)

    def close(self) -> None:
        pass


def stream_matches(rows: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """Matches of a stream of ``arrival_rows``. No watermark here on purpose: it would drop late
    rows the buffer still has use for."""
    spark = rows.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    shard = F.pmod(F.xxhash64("groupKey"), F.lit(SHARDS)).cast("int")
    return rows.where(F.col("groupKey").isNotNull()).withColumn("shard", shard).groupBy("shard").transformWithStateInPandas(
        statefulProcessor=SequenceProcessor(ttl_ms, own_detectors(dict(registry.FINDERS))),
        outputStructType=ARRIVAL_MATCH_SCHEMA,
        outputMode="Append",
        timeMode="ProcessingTime" if ttl_ms else "None",
    )


def detect_stream(
    events: DataFrame, rules: DataFrame, strict_routing: bool = False, ttl_ms: int | None = None
) -> DataFrame:
    """Alerts of an event stream under fixed rules, with their events as ``triggerEvents``."""
    matches = stream_matches(arrival_rows(match_rules(events, rules, strict_routing)), ttl_ms)
    return score_matches(matches)


def event_watermark(events: DataFrame, delay_ms: int = LATENESS_MS) -> DataFrame:
    """Adds ``eventTime`` with a watermark, for rollups; an unusable time counts as now."""
    now = F.current_timestamp()
    at = F.when(F.col("timestamp") > 0, F.timestamp_millis("timestamp")).otherwise(now)
    return events.withColumn("eventTime", at).withWatermark("eventTime", f"{delay_ms} milliseconds")


def alert_watermark(alerts: DataFrame, time: Column, delay: str = "1 minute") -> DataFrame:
    return alerts.withColumn("alertTime", time).withWatermark("alertTime", delay)


def match_with_reload(
    events: DataFrame, read_changelog, staging: str, checkpoint: str, strict_routing: bool = False
):
    """First of the two queries for rules that change while the stream runs.

    Every micro-batch reads the rule changelog anew (``read_changelog(spark)``), folds it and writes
    the events it matches to ``staging``, one folder per query and batch. A batch that was already written
    stays as it is, so that a restart neither loses nor doubles rows. Start ``staged_rows`` on the
    same folder for the second query.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = f"{staging}/stream={stream_id(spark, checkpoint)}/batch={batch_id}"
        if _exists(spark, f"{folder}/_SUCCESS"):
            return
        rules = active_rules(read_changelog(spark))
        arrival_rows(match_rules(batch, rules, strict_routing)).write.mode("overwrite").parquet(folder)

    return events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


STAGED_SCHEMA = (
    "arrivedAt long, groupKey string, " + EVENT_STATE + ", ruleId string, ruleName string, ruleType string, windowSizeMs long, "
    "threshold int, severityWeight double, scoreThreshold double, detector string"
)


def staged_rows(spark: SparkSession, staging: str) -> DataFrame:
    """The staged matches as a stream, for ``stream_matches``."""
    return spark.readStream.schema(STAGED_SCHEMA).parquet(f"{staging}/stream=*/batch=*").select("arrivedAt", *ARRIVAL_COLUMNS)
