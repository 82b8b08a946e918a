import json

from burstguard.operators.alerts import alert_writes, parse_alerts
from burstguard.operators.features import feature_snapshot
from burstguard.operators.rules import rules_frame, template_rules
from burstguard.sources.csvfiles import detect_profile, import_rows, map_csv, read_csv
from burstguard.sources.decode import decode_events, decode_rules, good_events, rejects
from burstguard.sources.inputs import RULES_FIRST, arrival_order, baseline_events, captured_alerts, json_documents
from burstguard.sources.outputs import (
    append_alert_table,
    append_feature_updates,
    compact_feature_table,
    keyed_documents,
    read_feature_table,
    write_csv,
    write_rule_array,
)


def docs(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "seq long, value string")


def test_event_documents(spark):
    df = decode_events(
        docs(
            spark,
            '{"userId":"u","actionType":"view","timestamp":5000,"extra":"{\\"a\\":1}","more":1}',
            '{"user_id":10001,"event_type":"add_to_cart","event_time":"2019-10-01 00:00:01","product_id":7}',
            '{"user_id":1,"event_type":"x","TransactionDT":1000}',
            '{"userId":"u","actionType":"view","timestamp":"soon"}',
            '{"userId":"u","actionType":"view","timestamp":1,"amount":"much"}',
            "not json",
            "",
            None,
            '[{"userId":"u"}]',
            '{"userId":"","actionType":"view","timestamp":5}',
        )
    )
    good = {r["seq"]: r for r in good_events(df).collect()}
    assert sorted(good) == [0, 1, 2]
    assert good[0]["extra"] == '{"a":1}'
    assert (good[1]["userId"], good[1]["actionType"], good[1]["timestamp"]) == ("10001", "ADD_CART", 1569888001000)
    assert (good[1]["productId"], good[2]["timestamp"]) == ("7", 1512087400000)
    assert sorted(r["seq"] for r in rejects(df).collect()) == [3, 4, 5, 6, 7, 8]


def test_rule_documents(spark):
    head = '{"ruleId":"r","ruleType":"ORDER_BRUSH","targetActionType":"ORDER","windowSizeMs":1000,"threshold":2'
    df = decode_rules(docs(spark, head + "}", head + ',"status":null,"priority":null}', head + ',"status":"ODD"}',
                           '{"ruleId":"x","ruleType":"ODD"}', "bad", head + ',"version":"v"}'))
    rows = {r["seq"]: r for r in df.collect()}
    assert sorted(rows) == [0, 1, 2, 3]
    assert (rows[0]["status"], rows[0]["priority"], rows[0]["severityWeight"]) == ("ENABLED", 100, 1.0)
    assert (rows[1]["status"], rows[1]["priority"], rows[2]["status"]) == (None, 0, None)
    assert (rows[3]["ruleType"], rows[3]["windowSizeMs"]) == (None, 0)


def test_json_array_and_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('\n [ {"a": 1},\n {"a": 2, "b": [1]} ]')
    (tmp_path / "l.json").write_text('{"a": 1}\n\n {"b": 3} \n')
    got = json_documents(spark, str(tmp_path / "a.json")).collect()
    assert [json.loads(r["value"]) for r in got] == [{"a": 1}, {"a": 2, "b": [1]}]
    lines = json_documents(spark, str(tmp_path / "l.json"))
    assert [r["value"] for r in lines.collect()] == ['{"a": 1}', '{"b": 3}']
    assert [r["key"] for r in keyed_documents(lines, "a").collect()] == ["1", None]
    assert [r["key"] for r in keyed_documents(lines).collect()] == [None, None]


def test_csv_import(spark, tmp_path):
    (tmp_path / "m.csv").write_text(
        "event_time,event_type,product_id,price,user_id,user_session\n"
        "2019-10-01 00:00:00 UTC, view ,1,9.5,7,s1\n"
        "never,cart,1,x,8,s2\n"
        "2019-10-01 00:00:02 UTC,remove_from_cart,1,,,s3\n"
    )
    rows = read_csv(spark, str(tmp_path / "m.csv"))
    assert detect_profile(rows.columns) == "multi_category"
    kept, counters = import_rows(map_csv(rows))
    got = [(r["userId"], r["actionType"], r["ip"], r["timestamp"], r["amount"]) for r in kept.collect()]
    assert got == [("7", "VIEW", "unknown-ip", 1569888000000, 9.5), ("s3", "REMOVE_CART", "unknown-ip", 1569888002000, None)]
    assert counters.get == {"total": 3, "converted": 2, "invalid": 1}


def test_profiles():
    assert detect_profile(["transactionid", "event_time"]) == "ieee_cis"
    assert detect_profile(["Session ID"]) == "clickstream"
    assert detect_profile(["uid"]) == "generic"


def test_baseline(spark):
    df = baseline_events(docs(spark, '{"uid":5,"timestamp":"x"}', "bad", '{"user_id":"a","actionType":"click","timestamp":9}'), 77)
    got = [(r["userId"], r["actionType"], r["timestamp"], r["sessionId"]) for r in df.orderBy("seq").collect()]
    assert got == [("5", "VIEW", 77, "s-5"), ("a", "CLICK", 9, "s-a")]


def test_captured_alerts(spark, tmp_path):
    (tmp_path / "out.txt").write_text('Processed\n{"ruleId":"a"}\n{broken\n  {"ruleId":"b"}\n')
    assert captured_alerts(spark, str(tmp_path / "out.txt")).count() == 2


def test_rule_file_and_csv(spark, tmp_path):
    write_rule_array(template_rules(spark, "clickstream"), str(tmp_path / "rules"))
    back = decode_rules(json_documents(spark, str(tmp_path / "rules")))
    assert back.count() == 3 and back.where("status = 'ENABLED'").count() == 3
    write_csv(rules_frame(spark, []), str(tmp_path / "csv"), ["ruleId", "version"])


def test_alert_table(spark, tmp_path):
    raw = docs(spark, '{"alertId":"a","alertTimestamp":1569888001000,"riskScore":2.5}', '{"alertId":"b","alertTimestamp":1572566400000}')
    append_alert_table(raw, str(tmp_path / "t"))
    append_alert_table(raw, str(tmp_path / "t"))
    months = spark.read.parquet(str(tmp_path / "t")).groupBy("month").count().collect()
    assert {str(r["month"]): r["count"] for r in months} == {"201910": 2, "201911": 2}


UPDATES = "featureKey string, writtenAt long, seq long, ruleType string, ip string, extra string"


def test_features_expire_and_merge(spark, tmp_path):
    ttl = 1_800_000
    first = [("u", 0, 0, "A", "1", "x"), ("u", ttl - 1, 1, "B", None, None), ("v", 0, 2, "A", "1", "x"), ("v", ttl, 3, "C", None, None)]
    later = [("u", 2 * ttl - 2, 4, None, "9", None), ("w", 5, 5, "A", None, None)]
    both = spark.createDataFrame(first + later, UPDATES)
    want = {"u": ("B", "9", "x"), "v": ("C", None, None), "w": ("A", None, None)}

    def table(df):
        return {r["featureKey"]: (r["ruleType"], r["ip"], r["extra"]) for r in df.collect()}

    assert table(feature_snapshot(both)) == want
    assert set(table(feature_snapshot(both, now_ms=3 * ttl - 3))) == {"u"}
    assert table(feature_snapshot(both, now_ms=3 * ttl - 2)) == {}
    path = str(tmp_path / "f")
    append_feature_updates(spark.createDataFrame(first, UPDATES), path, 0)
    compact_feature_table(spark, path)
    for _ in range(2):
        append_feature_updates(spark.createDataFrame(later, UPDATES), path, 1)
    assert table(read_feature_table(spark, path)) == want
    compact_feature_table(spark, path)
    assert table(read_feature_table(spark, path)) == want


def test_documents_are_parsed_once(spark):
    rows = docs(spark, '{"userId":"u","actionType":"view","timestamp":1}')
    frames = [
        good_events(decode_events(rows)),
        decode_rules(rows),
        baseline_events(rows, 77),
        parse_alerts(rows),
        alert_writes(rows),
    ]
    for frame in frames:
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1, plan


def test_rejects_keep_their_whole_text(spark):
    long = '{"userId":"u","amount":"much","extra":"' + "x" * 1000 + '"}'
    assert [r["rejected"] for r in rejects(decode_events(docs(spark, long))).collect()] == [long]


def test_every_json_file_is_judged_by_itself(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1},{"a": 2}]')
    (tmp_path / "b.json").write_text('\n{"a": 3}\n{"a": 4}\n')
    (tmp_path / "c.json").write_text("\n")
    got = [json.loads(r["value"])["a"] for r in json_documents(spark, str(tmp_path)).collect()]
    assert sorted(got) == [1, 2, 3, 4]
    empty = tmp_path / "none"
    empty.mkdir()
    (empty / "x.json").write_text("")
    assert json_documents(spark, str(empty)).count() == 0


def test_order_of_arrival_over_partitions(spark):
    """Offsets of partitions are unrelated: records are ordered by time, and by offset inside a partition."""
    rows = [("a", 0, 500, 10), ("b", 1, 3, 20), ("c", 0, 501, 30), ("d", 1, 4, 15), ("e", 0, 502, 20)]
    frame = spark.createDataFrame(rows, "value string, partition int, offset long, recordMs long")
    got = [r["value"] for r in arrival_order(frame).orderBy("seq").collect()]
    assert got == ["a", "b", "d", "c", "e"]
    rules = spark.createDataFrame([("r", 0, 0, 20)], "value string, partition int, offset long, recordMs long")
    both = arrival_order(frame).unionByName(arrival_order(rules, RULES_FIRST)).orderBy("seq").collect()
    assert [r["value"] for r in both] == ["a", "r", "b", "d", "c", "e"]
