"""Events and rule changes in one streaming query against the as-of replay of a batch."""

import random

from pyspark.sql import functions as F

from burstguard.operators.match import match_rules_asof
from burstguard.operators.rules import rule_history, rules_frame
from burstguard.schemas import RULE
from burstguard.streaming.arrival import replay_matches
from burstguard.streaming.rulebook import detect_live, live_matches
from test_streaming import event_frame, got, make_events

RULE_DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RULE.fields) + ", seq long"


def change_log(spark, seed, n, span):
    """Changes of a few rules: versions up and down, off and on, other actions, types, thresholds, unusable ones."""
    rng = random.Random(seed)
    kinds = [("HIGH_FREQ_ACCESS", ["LOGIN_FAIL", "PAYMENT"]), ("ABNORMAL_LOGIN", ["LOGIN"]), ("PAYMENT_FRAUD", ["PAYMENT"]),
             ("CUSTOM", ["LOGIN"])]
    rows = []
    for _ in range(n):
        kind, actions = rng.choice(kinds)
        rows.append(
            {"ruleId": rng.choice(["a", "b", "c", "d", ""]), "ruleType": kind, "targetActionType": rng.choice(actions * 4 + [""]),
             "windowSizeMs": rng.choice([0, 8000, 20000, 30000, 60000, 60000]), "threshold": rng.choice([1, 1, 2]), "version": rng.randint(1, 4),
             "status": rng.choice(["ENABLED"] * 5 + ["DISABLED", "DISABLED", None]),
             "groupKeyType": rng.choice(["BY_USER_ID", "BY_IP"])}
        )
    log = rules_frame(spark, rows).coalesce(1).withColumn("n", F.monotonically_increasing_id())
    return log.withColumn("seq", F.floor(F.col("n") * span / n).cast("long") * 10 - 5).drop("n")


def files(spark, df, folder, cuts):
    """Rows in files by ``seq``, taken one file a micro-batch in that order."""
    import os

    folder.mkdir()
    for i, (low, high) in enumerate(zip(cuts, cuts[1:])):
        path = folder / f"{i:03d}.json"
        rows = df.where((F.col("seq") >= low) & (F.col("seq") < high)).orderBy("seq").toJSON().collect()
        path.write_text("\n".join(rows))
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).json(str(folder))


def run_to(df, name, checkpoint):
    query = df.writeStream.format("memory").queryName(name).option("checkpointLocation", str(checkpoint)).trigger(availableNow=True)
    started = query.start()
    started.awaitTermination(300)
    assert started.exception() is None


def test_changes_in_mid_stream_equal_the_replay(spark, tmp_path):
    """Versions, switching off and on, other actions and keys, over several micro-batches of events and changes."""
    events = event_frame(spark, make_events(31, 300)).withColumn("seq", F.col("seq") * 10)
    log = change_log(spark, 6, 40, 300).cache()
    cuts = [-100, 700, 701, 1500, 2400, 9999]
    stream = files(spark, events, tmp_path / "events", cuts).withColumn("arrivedAt", F.col("seq"))
    changes = files(spark, log, tmp_path / "rules", cuts).withColumn("arrivedAt", F.col("seq"))
    run_to(detect_live(stream, changes, shards=3), "live_rules", tmp_path / "cp")
    matched = match_rules_asof(events, rule_history(log))
    expected = got(replay_matches(matched))
    assert len(expected) > 10 and got(spark.table("live_rules")) == expected


def test_a_rule_switched_off_lets_no_later_event_match(spark, tmp_path):
    rule = {"ruleId": "r", "ruleType": "HIGH_FREQ_ACCESS", "targetActionType": "VIEW", "windowSizeMs": 60000, "threshold": 1}
    log = rules_frame(spark, [rule | {"version": 1}, rule | {"status": "DISABLED"}, rule | {"version": 1}])
    log = log.coalesce(1).withColumn("seq", (F.monotonically_increasing_id() + 1) * 10)
    views = [{"seq": s, "userId": "u", "actionType": "VIEW", "ip": "x", "timestamp": 1_700_000_000_000 + s, "deviceId": None,
              "amount": None} for s in (5, 10, 15, 20, 25, 30, 35)]
    events = event_frame(spark, views)
    for cuts in ([0, 100], [0, 12, 21, 28, 100]):
        name = f"off{len(cuts)}"
        stream = files(spark, events, tmp_path / f"e{name}", cuts).withColumn("arrivedAt", F.col("seq"))
        changes = files(spark, log, tmp_path / f"r{name}", cuts).withColumn("arrivedAt", F.col("seq"))
        run_to(live_matches(stream, changes, shards=2).select("seq", "version", "groupKey"), name, tmp_path / f"cp{name}")
        rows = sorted(tuple(r) for r in spark.table(name).collect())
        # on from 10, off at 20, on again with the old version at 30
        assert rows == [(s, 1, "r:u") for s in (10, 15, 30, 35)]


def test_a_rule_that_may_not_match_hides_older_versions(spark, tmp_path):
    rule = {"ruleId": "r", "ruleType": "HIGH_FREQ_ACCESS", "targetActionType": "VIEW", "windowSizeMs": 60000, "threshold": 1}
    log = rules_frame(spark, [rule | {"version": 2, "status": None}, rule | {"version": 1}]).coalesce(1)
    log = log.withColumn("seq", F.monotonically_increasing_id())
    views = [{"seq": 9, "userId": "u", "actionType": "VIEW", "ip": "x", "timestamp": 1_700_000_000_000, "deviceId": None, "amount": None}]
    stream = files(spark, event_frame(spark, views), tmp_path / "e", [0, 100]).withColumn("arrivedAt", F.col("seq"))
    changes = files(spark, log, tmp_path / "r", [0, 100]).withColumn("arrivedAt", F.col("seq"))
    run_to(live_matches(stream, changes, shards=1), "hidden", tmp_path / "cp")
    assert spark.table("hidden").count() == 0
