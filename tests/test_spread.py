"""Topics and arrays are written and read by as many tasks as their size asks for."""

import json
import re

import pytest

from burstguard.operators.rules import rules_frame
from burstguard.plans import queries as q
from burstguard.sources import inputs
from burstguard.sources.arrays import array_elements
from burstguard.sources.outputs import write_rule_array
from burstguard.sources.segments import Topic

TINY = "/root/testdata/sf0.001"


@pytest.fixture
def eight_tasks(spark):
    """Shuffles of eight partitions that are not merged, as larger data would have."""
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_a_topic_is_written_by_ranges_of_its_order(spark, eight_tasks):
    place = q._behavior_topic(spark, TINY).removeprefix(inputs.SEGMENTS)
    segments = Topic({"path": place, "topic": "behavior"}).segments()
    partitions = {s["partition"] for s in segments}
    assert len(partitions) == 4 and len(segments) > 4
    rows = inputs._topic(spark, False, inputs.SEGMENTS + place, "behavior", "earliest", None).collect()
    for p in partitions:
        mine = sorted((r["offset"], r["recordMs"]) for r in rows if r["partition"] == p)
        assert [o for o, _ in mine] == list(range(len(mine)))
        assert [t for _, t in mine] == sorted(t for _, t in mine)
    assert len(rows) == spark.read.parquet(f"{TINY}/events.parquet").count()


def test_rule_changes_keep_their_order_over_many_writers(spark, eight_tasks, monkeypatch):
    places = []
    folder = q._folder
    monkeypatch.setattr(q, "_folder", lambda spark, name: places.append(folder(spark, name)) or places[-1])
    rows = q.rule_topic_snapshot(spark, TINY).count()
    segments = Topic({"path": places[0], "topic": "rules"}).segments()
    assert rows > 0 and len(segments) == 8 * 4
    kept = inputs._topic(spark, False, inputs.SEGMENTS + places[0], "rules", "earliest", None).collect()
    for p in range(4):
        times = [r["recordMs"] for r in sorted((r for r in kept if r["partition"] == p), key=lambda r: r["offset"])]
        assert times and times == sorted(times)


def test_rule_arrays_in_as_many_files_as_there_are_ranges(spark, tmp_path, eight_tasks):
    rules = rules_frame(spark, [{"ruleId": f"r{i:03d}", "ruleType": "ORDER_BRUSH", "targetActionType": "a", "windowSizeMs": 5,
                                 "threshold": 1, "version": i} for i in range(100)]).repartition(8)
    write_rule_array(rules, str(tmp_path / "r"), files=None)
    parts = sorted(p for p in (tmp_path / "r").iterdir() if p.name.startswith("part") and p.stat().st_size > 5)
    assert len(parts) > 4
    assert [r["ruleId"] for p in parts for r in json.loads(p.read_text())] == [f"r{i:03d}" for i in range(100)]


def test_the_text_of_arrays_is_not_moved(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"a": i} for i in range(10)]))
    files = spark.read.text(str(tmp_path)).selectExpr("_metadata.file_path as _file").distinct()
    elements = array_elements(spark, str(tmp_path), files)
    plan = elements._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange hashpartitioning\(_file#\d+, _block", plan)
    assert elements.count() == 10
