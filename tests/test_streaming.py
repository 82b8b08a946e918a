"""Detection in arrival order: batch replay and stream against the plain machine."""

import json
import os
import random

from plain_machine import run
from pyspark.sql import functions as F

from burstguard.operators.alerts import alert_writes
from burstguard.operators.match import match_rules, match_rules_asof
from burstguard.operators.rules import rule_history, rules_frame
from burstguard.sources.decode import decode_events, good_events
from burstguard.sources.inputs import text_stream
from burstguard.sources.outputs import compact_feature_table, feature_table_stream, read_feature_table
from burstguard.streaming.arrival import detect_in_arrival_order, replay_matches
from burstguard.streaming.detection import detect_stream, match_with_reload, staged_rows, stream_matches

T0 = 1_700_000_000_000
RULES = [
    {"ruleId": "c", "ruleType": "CREDENTIAL_STUFFING", "targetActionType": "LOGIN_FAIL", "windowSizeMs": 20000,
     "threshold": 3, "groupKeyType": "BY_IP"},
    {"ruleId": "l", "ruleType": "ABNORMAL_LOGIN", "targetActionType": "LOGIN", "windowSizeMs": 8000, "threshold": 2},
    {"ruleId": "p", "ruleType": "PAYMENT_FRAUD", "targetActionType": "PAYMENT", "windowSizeMs": 30000, "threshold": 2},
]
ROUTES = {
    "c": ("count", ["LOGIN_FAIL"]),
    "l": ("pair", ["LOGIN", "CHANGE_PASSWORD"]),
    "p": ("pay", ["LOGIN", "PAYMENT", "PAYMENT_FRAUD"]),
}


def make_events(seed, n):
    rng = random.Random(seed)
    t, out = T0, []
    for seq in range(n):
        t += rng.choice([0, 50, 200, 700, 2500])
        out.append(
            {
                "seq": seq,
                "userId": f"u{rng.randint(0, 2)}",
                "actionType": rng.choice(["LOGIN_FAIL", "LOGIN", "CHANGE_PASSWORD", "PAYMENT", "PAYMENT", "PAYMENT_FRAUD"]),
                "ip": rng.choice(["1.1.1.1", "2.2.2.2", "a", "A"]),
                "timestamp": t - rng.choice([0, 0, 0, 4000, 30000]),
                "deviceId": rng.choice([None, "d"]),
                "amount": rng.choice([5.0, 50.0, 500.0, 1500.0]),
            }
        )
    return out


def expected_alerts(events):
    out = []
    for rule in RULES:
        detector, actions = ROUTES[rule["ruleId"]]
        by = "ip" if rule.get("groupKeyType") == "BY_IP" else "userId"
        keys = {}
        for e in events:
            if e["actionType"] in actions:
                keys.setdefault(e[by], []).append(e)
        for key, rows in keys.items():
            for m in run(rows, detector, rule["windowSizeMs"], rule["threshold"]):
                out.append((f"{rule['ruleId']}:{key}", m[0]["userId"], len(m), m[0]["timestamp"],
                            tuple(e["seq"] for e in m)))
    return sorted(out)


def got(df):
    rows = df.select("groupKey", "userId", "matchCount", "firstEventTimestamp", "eventSeqs").collect()
    return sorted((*r[:-1], tuple(r[-1])) for r in rows)


EVENT_SCHEMA = ("seq long, userId string, actionType string, ip string, timestamp long, deviceId string, "
                "amount double")


def event_frame(spark, events):
    df = spark.createDataFrame([tuple(e.values()) for e in events], EVENT_SCHEMA)
    for name in ["sessionId", "productId", "extra"]:
        df = df.withColumn(name, F.lit(None).cast("string"))
    return df


def test_replay_equals_machine(spark):
    events = make_events(3, 600)
    matched = match_rules(event_frame(spark, events).orderBy(F.rand(5)), rules_frame(spark, RULES))
    expected = expected_alerts(events)
    assert len(expected) > 40
    assert got(replay_matches(matched)) == expected
    first = detect_in_arrival_order(matched).where("ruleType = 'PAYMENT_FRAUD'").first()
    assert len(first["triggerEvents"]) == first["matchCount"]


def write_event_files(folder, events, per_file):
    folder.mkdir()
    for i in range(0, len(events), per_file):
        lines = [json.dumps(e) for e in events[i : i + per_file]]
        path = folder / f"{i:06d}.json"
        path.write_text("\n".join(lines))
        # The file source takes files in order of their times.
        os.utime(path, (T0 / 1000 + i, T0 / 1000 + i))


def read_stream(spark, folder):
    raw = text_stream(spark, str(folder), files_per_batch=1)
    raw = raw.withColumn("seq", F.get_json_object("value", "$.seq").cast("bigint"))
    return good_events(decode_events(raw))


def run_to_table(df, name, checkpoint):
    q = df.writeStream.format("memory").queryName(name).option("checkpointLocation", str(checkpoint)).trigger(
        availableNow=True
    ).start()
    q.awaitTermination(300)
    assert q.exception() is None


def test_stream_equals_machine(spark, tmp_path):
    events = make_events(4, 240)
    write_event_files(tmp_path / "in", events, 80)
    alerts = detect_stream(read_stream(spark, tmp_path / "in"), rules_frame(spark, RULES))
    run_to_table(alerts, "stream_alerts", tmp_path / "cp")
    assert got(spark.table("stream_alerts")) == expected_alerts(events)


def test_rules_reload_between_batches(spark, tmp_path):
    """A lower threshold that comes with the second file takes effect on the buffer already there."""
    rule = {"ruleId": "r", "ruleType": "HIGH_FREQ_ACCESS", "targetActionType": "VIEW", "windowSizeMs": 60000}
    versions = rules_frame(spark, [rule | {"threshold": 10, "version": 1}, rule | {"threshold": 5, "version": 2}])
    views = [{"seq": i, "userId": "u", "actionType": "VIEW", "ip": "x", "timestamp": T0 + i * 5000} for i in range(6)]
    write_event_files(tmp_path / "in", views, 3)
    reads = []

    def changelog(session):
        reads.append(1)
        return versions.where(F.col("version") <= len(reads)).withColumn("seq", F.col("version"))

    staging = str(tmp_path / "staging")
    q = match_with_reload(read_stream(spark, tmp_path / "in"), changelog, staging, str(tmp_path / "cp1")).trigger(
        availableNow=True
    ).start()
    q.awaitTermination(300)
    assert len(reads) == 2
    run_to_table(stream_matches(staged_rows(spark, staging)), "reloaded", tmp_path / "cp2")
    rows = spark.table("reloaded").collect()
    assert [(r["matchCount"], r["threshold"], r["eventSeqs"]) for r in rows] == [(5, 5, [0, 1, 2, 3, 4])]


def test_asof_replay_uses_the_version_in_force(spark):
    rule = {"ruleId": "r", "ruleType": "HIGH_FREQ_ACCESS", "targetActionType": "VIEW", "windowSizeMs": 60000}
    log = rules_frame(spark, [rule | {"threshold": 10, "version": 1}, rule | {"threshold": 5, "version": 2}])
    log = log.withColumn("seq", F.when(F.col("version") == 1, -1).otherwise(5).cast("bigint"))
    views = [{"seq": i, "userId": "u", "actionType": "VIEW", "ip": "x", "timestamp": T0 + i * 5000,
              "deviceId": None, "amount": None} for i in range(6)]
    matched = match_rules_asof(event_frame(spark, views), rule_history(log))
    assert matched.groupBy("version").count().orderBy("version").collect() == [(1, 5), (2, 1)]
    # The sixth view is the first to be read with the lower threshold: the first five then match.
    assert [r["eventSeqs"] for r in replay_matches(matched).collect()] == [[0, 1, 2, 3, 4]]


def test_quiet_stream(spark, tmp_path):
    write_event_files(tmp_path / "in", make_events(9, 3), 3)
    alerts = detect_stream(read_stream(spark, tmp_path / "in"), rules_frame(spark, RULES))
    run_to_table(alerts, "quiet", tmp_path / "cp")
    assert spark.table("quiet").count() == 0


def test_reset_checkpoints_lose_no_features(spark, tmp_path):
    """Alert texts into the feature table by two queries that both count their batches from 0."""
    table = str(tmp_path / "features")
    for n, user in enumerate(["u", "v"]):
        folder = tmp_path / f"in{n}"
        folder.mkdir()
        doc = {"userId": user, "ip": "", "ruleType": "ORDER_BRUSH", "extra": None, "alertTimestamp": 5 + n}
        (folder / "a.json").write_text(json.dumps(doc) + "\n")
        writes = alert_writes(text_stream(spark, str(folder)))
        query = feature_table_stream(writes, "userId", table, str(tmp_path / f"cp{n}")).trigger(availableNow=True)
        query.start().awaitTermination(300)
        if n == 0:
            compact_feature_table(spark, table)
    rows = {r["featureKey"]: (r["ruleType"], r["ip"], r["writtenAt"]) for r in read_feature_table(spark, table).collect()}
    assert rows == {"u": ("ORDER_BRUSH", None, 5), "v": ("ORDER_BRUSH", None, 6)}
    compact_feature_table(spark, table, now_ms=5 + 1_800_000)
    assert [r["featureKey"] for r in read_feature_table(spark, table).collect()] == ["v"]


def test_reset_checkpoints_stage_their_batches_again(spark, tmp_path):
    rule = {"ruleId": "r", "ruleType": "HIGH_FREQ_ACCESS", "targetActionType": "VIEW", "windowSizeMs": 60000, "threshold": 2}
    log = rules_frame(spark, [rule | {"version": 1}]).withColumn("seq", F.lit(0).cast("bigint"))
    staging = str(tmp_path / "staging")
    for n in range(2):
        views = [{"seq": 2 * n + i, "userId": "u", "actionType": "VIEW", "ip": "x", "timestamp": T0 + (2 * n + i) * 5000} for i in range(2)]
        write_event_files(tmp_path / f"in{n}", views, 2)
        q = match_with_reload(read_stream(spark, tmp_path / f"in{n}"), lambda s: log, staging, str(tmp_path / f"cp{n}"))
        q.trigger(availableNow=True).start().awaitTermination(300)
    assert spark.read.parquet(f"{staging}/stream=*/batch=*").count() == 4
