"""Topics as folders of segments: offsets, order of arrival, streams from and to them."""

import json

import pytest
from pyspark.sql import functions as F

from burstguard.operators.rules import rules_frame
from burstguard.sources import inputs
from burstguard.sources.decode import decode_events, good_events
from burstguard.sources.outputs import alert_topic_stream, write_topic
from burstguard.sources.segments import Topic
from burstguard.streaming.detection import detect_stream
from test_streaming import RULES, event_frame, expected_alerts, make_events

T0 = 1_700_000_000_000




def test_records_keep_partition_offset_and_time(spark, tmp_path):
    place = f"segments:{tmp_path}"
    rows = [(f"k{i % 5}" if i % 7 else None, f"v{i}", i * 1000) for i in range(200)]
    df = spark.createDataFrame(rows, "key string, value string, ms long").repartition(3)
    for _ in range(2):
        write_topic(df.withColumn("timestamp", F.timestamp_millis("ms")).drop("ms"), place, "t", partitions=4)
    read = inputs._topic(spark, False, place, "t", "earliest", None).collect()
    assert sorted((r["key"], r["value"], r["recordMs"]) for r in read if r["key"]) == sorted(r for r in rows * 2 if r[0])
    places = sorted((r["partition"], r["offset"]) for r in read)
    ends = Topic({"path": str(tmp_path), "topic": "t"}).ends()
    assert places == sorted((int(p), o) for p, n in ends.items() for o in range(n)) and len(ends) == 4
    # one key lies in one partition
    assert all(len({r["partition"] for r in read if r["key"] == f"k{i}"}) == 1 for i in range(5))


def test_a_write_that_is_not_committed_is_not_there(spark, tmp_path):
    place = f"segments:{tmp_path}"
    df = spark.createDataFrame([("k", "v")], "key string, value string")
    write_topic(df, place, "t")
    broken = df.union(df.select("key", F.raise_error(F.lit("stopped")).cast("string"))).coalesce(1)
    with pytest.raises(Exception, match="stopped"):
        write_topic(broken, place, "t")
    topic = Topic({"path": str(tmp_path), "topic": "t"})
    assert sum(topic.ends().values()) == 1 and inputs._topic(spark, False, place, "t", "earliest", None).count() == 1


def test_a_batch_of_a_writer_is_committed_once(tmp_path):
    topic = Topic({"path": str(tmp_path), "topic": "t"})
    for batch in (0, 0, 1, 1):
        topic.commit([(0, f"file-{batch}", 5)], "writer", batch)
    topic.commit([(0, "other", 5)])
    assert [s["base"] for s in topic.segments()] == [0, 5, 10]


def test_pieces_of_long_segments(spark, tmp_path):
    place = f"segments:{tmp_path}"
    df = spark.range(1000).coalesce(1).select(F.lit("k").alias("key"), F.col("id").cast("string").alias("value"))
    write_topic(df, place, "t", partitions=1)
    topic = Topic({"path": str(tmp_path), "topic": "t"})
    pieces = topic.pieces({"0": 130}, {"0": 990}, 100)
    assert len(pieces) == 9
    values = [int(v) for p in pieces for b in topic.read(p) for v in b["value"].to_pylist()]
    assert values == list(range(130, 990))


def test_empty_topic(spark, tmp_path):
    assert inputs._topic(spark, False, f"segments:{tmp_path}", "none", "earliest", None).count() == 0


def run_now(query):
    started = query.trigger(availableNow=True).start()
    started.awaitTermination(300)
    assert started.exception() is None


def send(spark, place, events, topic="behavior"):
    """Events to partitions by user, one a millisecond in the order of the list."""
    rows = event_frame(spark, events)
    timed = rows.select(
        F.col("userId").alias("key"), F.to_json(F.struct("userId", "actionType", "ip", "timestamp", "deviceId", "amount")).alias("value"),
        F.timestamp_millis(F.col("seq") + T0).alias("timestamp"), F.pmod(F.xxhash64("userId"), F.lit(3)).cast("int").alias("partition"), "seq",
    )
    write_topic(timed.repartition(3, "partition").sortWithinPartitions("seq").drop("seq"), place, topic)


def alerts_of(rows):
    return sorted((r["groupKey"], r["userId"], r["matchCount"], r["firstEventTimestamp"]) for r in rows)


def test_stream_from_topic_to_topic_in_several_batches(spark, tmp_path):
    """Events late by up to half a minute, in order of arrival: two rounds of writing and running, alerts to a topic."""
    place = f"segments:{tmp_path}"
    events = make_events(12, 300)
    checkpoint = str(tmp_path / "checkpoint")
    for part in (events[:140], events[140:]):
        send(spark, place, part)
        stream = inputs.behavior_topic(spark, place, "behavior", starting="earliest")
        alerts = detect_stream(good_events(decode_events(stream.drop("key"))), rules_frame(spark, RULES))
        run_now(alert_topic_stream(alerts, place, "alerts", checkpoint))
    texts = inputs.alert_topic(spark, place, "alerts").collect()
    found = sorted((json.loads(t["value"])["ruleId"], t["key"], json.loads(t["value"])["matchCount"]) for t in texts)
    assert found == sorted((k.split(":")[0], u, n) for k, u, n, _, _ in expected_alerts(events))
    # nothing new: nothing is written again
    run_now(alert_topic_stream(alerts, place, "alerts", checkpoint))
    assert inputs.alert_topic(spark, place, "alerts").count() == len(texts)


def test_latest_offsets_leave_out_what_was_there(spark, tmp_path):
    place = f"segments:{tmp_path}"
    df = spark.createDataFrame([("k", "old")], "key string, value string")
    write_topic(df, place, "t", partitions=1)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        stream = inputs.behavior_topic(spark, place, "t").select("value")
        run_now(stream.writeStream.format("text").option("path", out).option("checkpointLocation", checkpoint))

    run()
    write_topic(df.withColumn("value", F.lit("new")), place, "t", partitions=1)
    run()
    assert [r["value"] for r in spark.read.text(out).collect()] == ["new"]


def test_stream_order_is_unique_for_a_thousand_partitions(spark):
    """Records of one millisecond in a thousand partitions, offsets across multiples of 65,536."""
    rows = spark.range(1000 * 40).select(
        (F.col("id") % 1000).cast("int").alias("partition"), (F.lit(65_520) + F.col("id") / 1000).cast("long").alias("offset"),
        F.lit(T0).alias("recordMs"), F.lit("v").alias("value"),
    )
    ordered = inputs.stream_order(rows)
    assert ordered.select("seq").distinct().count() == 40_000
    inside = inputs.stream_order(rows.withColumn("o", F.col("offset")).where("partition = 999")).orderBy("arrivedAt", "seq")
    offsets = [r["o"] for r in inside.collect()]
    assert offsets == sorted(offsets)


def test_batch_order_is_unique_and_keeps_the_offsets_of_a_partition(spark):
    """Clocks that run back, ranges of offsets far apart, a thousand partitions."""
    rows = spark.range(30_000).select(
        (F.col("id") % 1000).cast("int").alias("partition"), (F.floor(F.col("id") / 1000) * 40_000).alias("offset"),
        (F.lit(T0) + F.pmod(F.xxhash64("id"), F.lit(50))).alias("recordMs"),
    )
    tagged = rows.withColumn("value", F.concat_ws(":", "partition", "offset"))
    found = inputs.arrival_order(tagged).collect()
    assert len({r["seq"] for r in found}) == 30_000
    by_partition = {}
    for r in sorted(found, key=lambda r: r["seq"]):
        p, o = map(int, r["value"].split(":"))
        by_partition.setdefault(p, []).append(o)
    assert all(offsets == sorted(offsets) and len(offsets) == 30 for offsets in by_partition.values())


def test_clock_is_the_running_maximum_of_a_partition(spark):
    data = [(p, o * 30_000, T0 + t) for p in range(3) for o, t in enumerate([5, 9, 1, 3, 20, 2, 2, 30, 4])]
    df = spark.createDataFrame(data, "partition int, offset long, recordMs long")
    got = {(r["partition"], r["offset"]): r["_clock"] - T0 for r in inputs._clock(df).collect()}
    assert [got[1, o * 30_000] for o in range(9)] == [5, 9, 9, 9, 20, 20, 20, 30, 30]
