"""Streams into tables: rollups, features, alerts; runs that stop between write and commit."""

import json
import os
import time

from pyspark.sql import functions as F

from burstguard.operators.alerts import alert_writes
from burstguard.operators.features import feature_snapshot, feature_updates
from burstguard.operators.rollups import rollup_alerts
from burstguard.sources.inputs import text_stream
from burstguard.sources.outputs import alert_table_rows
from burstguard.streaming.tables import (
    LateRows,
    alert_table_stream,
    feature_state_stream,
    read_alert_table,
    read_feature_state,
    read_rollup_table,
    rollup_table_stream,
    run_now,
)

T0 = 1_700_000_000_000
DAY = 86_400_000


def texts(folder, name, docs):
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_text("\n".join(json.dumps(d) for d in docs) + "\n")
    os.utime(path, (T0 / 1000 + len(os.listdir(folder)),) * 2)


def alert(i, at, kind="ORDER_BRUSH", user="u", ip="1.1.1.1", **more):
    return {"alertId": f"a{i}", "ruleId": "r", "ruleType": kind, "userId": user, "ip": ip, "riskScore": 1.5 + i % 3,
            "matchCount": 3, "alertTimestamp": at, "lastEventTimestamp": at} | more


def forget_commit(checkpoint, batch):
    """As if the run had stopped after the batch's write and before its commit."""
    os.rename(checkpoint / "commits" / str(batch), checkpoint / f"lost-{batch}")
    crc = checkpoint / "commits" / f".{batch}.crc"
    if crc.exists():
        os.rename(crc, checkpoint / f"lost-{batch}.crc")


def test_rollups_of_a_stream_equal_the_batch(spark, tmp_path):
    for n in range(3):
        texts(tmp_path / "in", f"{n}.json", [alert(i, T0 + n * 30_000 + i * 7_000, ["A", "B"][i % 2]) for i in range(20)])
    raw = text_stream(spark, str(tmp_path / "in"), files_per_batch=1)
    table, checkpoint = str(tmp_path / "table"), tmp_path / "cp"

    def run():
        run_now(rollup_table_stream(alert_table_rows(raw), table, str(checkpoint), "10 minutes"))
        return sorted(tuple(r) for r in read_rollup_table(spark, table).collect())

    batch = rollup_alerts(alert_table_rows(spark.read.text(str(tmp_path / "in"))))
    expected = sorted(tuple(r) for r in batch.collect())
    assert len(expected) > 6 and run() == expected
    last = max(int(f) for f in os.listdir(checkpoint / "commits") if f.isdigit())
    forget_commit(checkpoint, last)
    assert run() == expected


def test_late_rows_are_counted(spark, tmp_path):
    texts(tmp_path / "in", "0.json", [alert(i, T0 + i * 60_000) for i in range(10)])
    texts(tmp_path / "in", "1.json", [alert(20, T0 + 9 * 60_000)])
    texts(tmp_path / "in", "2.json", [alert(21, T0), alert(22, T0 + 9 * 60_000)])
    listener = LateRows()
    spark.streams.addListener(listener)
    try:
        raw = text_stream(spark, str(tmp_path / "in"), files_per_batch=1)
        query = run_now(rollup_table_stream(alert_table_rows(raw), str(tmp_path / "t"), str(tmp_path / "cp"), "2 minutes"))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    finally:
        spark.streams.removeListener(listener)
    assert listener.counts[str(query.id)] == 1
    assert read_rollup_table(spark, str(tmp_path / "t")).agg(F.sum("cnt")).first()[0] == 12


def test_features_in_state_equal_the_snapshot(spark, tmp_path):
    ttl = 10_000
    docs = [alert(i, T0 + [0, 1, 4, 15, 16, 40][i % 6] * 1000 + i // 6 * 3000, ["A", "B", None][i % 3], f"u{i % 2}",
                  ["1.1.1.1", "", None][i % 3], extra=[None, "x", "y"][i % 3]) for i in range(24)]
    docs.sort(key=lambda d: d["alertTimestamp"])
    texts(tmp_path / "in", "0.json", docs[:9])
    texts(tmp_path / "in", "1.json", docs[9:])
    raw = text_stream(spark, str(tmp_path / "in"), files_per_batch=1)
    for scope in ("userId", "ip"):
        checkpoint = str(tmp_path / f"cp-{scope}")
        updates = feature_state_stream(alert_writes(raw), scope, ttl, expiring=False)
        run_now(updates.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint))
        writes = feature_updates(alert_writes(spark.read.text(str(tmp_path / "in"))), scope)
        expected = sorted(map(tuple, feature_snapshot(writes, ttl_ms=ttl).collect()), key=str)
        got = sorted(map(tuple, read_feature_state(spark, checkpoint).collect()), key=str)
        assert got == expected and len(got) > 0
        assert read_feature_state(spark, checkpoint, T0 + 10 * DAY, ttl).count() == 0


def test_state_of_a_query_that_stays_up_expires(spark, tmp_path):
    texts(tmp_path / "in", "0.json", [alert(1, T0)])
    checkpoint = str(tmp_path / "cp")
    updates = feature_state_stream(alert_writes(text_stream(spark, str(tmp_path / "in"))), "userId", 3_600_000)
    writer = updates.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
    query = writer.trigger(processingTime="1 second").start()
    deadline = time.time() + 60
    while time.time() < deadline and not any(p["numInputRows"] for p in query.recentProgress):
        time.sleep(0.5)
    query.stop()
    assert [r["featureKey"] for r in read_feature_state(spark, checkpoint).collect()] == ["u"]
    raw = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "feature").load()
    until = raw.select("value.ttlExpirationMs").first()[0]
    assert 0 < until - time.time() * 1000 <= 3_600_000


def test_alert_table_holds_every_alert_once(spark, tmp_path):
    """Alerts delivered twice in one batch, in two batches, in a batch that is run again; texts without an id."""
    months = [T0, T0 + 40 * DAY]
    texts(tmp_path / "in", "0.json", [alert(i, months[i % 2]) for i in (1, 2, 3, 1)] + [{"ruleId": "x"}, {"ruleId": "x"}, {"ruleId": "y"}])
    texts(tmp_path / "in", "1.json", [alert(i, months[i % 2]) for i in (2, 3, 4, 5)])
    raw = text_stream(spark, str(tmp_path / "in"), files_per_batch=1)
    table, checkpoint = str(tmp_path / "table"), tmp_path / "cp"

    def run():
        run_now(alert_table_stream(raw, table, str(checkpoint)))
        rows = read_alert_table(spark, table).collect()
        assert sorted(r["alertId"] or r["ruleId"] for r in rows) == ["a1", "a2", "a3", "a4", "a5", "x", "y"]

    run()
    forget_commit(checkpoint, 1)
    run()
    texts(tmp_path / "in", "2.json", [alert(5, months[1]), alert(1, months[1])])
    run()
    one = read_alert_table(spark, table).where("month = '202312'")
    assert one.count() == 3
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "month" in plan.split("PartitionFilters")[1][:80]
