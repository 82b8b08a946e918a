"""JSON arrays cut at every byte range, against the parser of one whole text."""

import json
import random

import pytest

from burstguard.operators.rules import rules_frame
from burstguard.sources.decode import decode_rules
from burstguard.sources.inputs import json_documents
from burstguard.sources.outputs import write_rule_array

TEXTS = ["", "plain", "a } b { c", "],[", 'quo"te', "back\\slash\\", "\\\"}", "ünïcode 漢", "tab\tline\nend", "}" * 9]


def made(rng, depth=0):
    kind = rng.randrange(5 if depth < 3 else 3)
    if kind == 0:
        return rng.choice(TEXTS)
    if kind in (1, 2):
        return rng.choice([0, -1.5, 10**12, True, None])
    if kind == 3:
        return [made(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {f"k{i}{rng.choice(TEXTS)}": made(rng, depth + 1) for i in range(rng.randrange(4))}


@pytest.fixture
def small_ranges(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")

    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield use
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.set("spark.sql.files.openCostInBytes", cost)


@pytest.mark.parametrize("size", [7, 61, 1000])
def test_arrays_of_any_shape(spark, tmp_path, small_ranges, size):
    rng = random.Random(size)
    expected = []
    for i, indent in enumerate([None, 1, None, 2, None]):
        rows = [{"id": f"{i}-{j}", "x": made(rng)} for j in range(rng.choice([1, 12, 25]))]
        (tmp_path / f"{i}.json").write_text("﻿ \n" * (i % 2) + json.dumps(rows, indent=indent, ensure_ascii=i % 2 == 0))
        expected += rows
    (tmp_path / "empty.json").write_text(" [ ]\n")
    (tmp_path / "lines.json").write_text('{"id": "l"}\n\n{"id": "m"}\n')
    small_ranges(size)
    got = [json.loads(r["value"]) for r in json_documents(spark, str(tmp_path)).collect()]
    assert sorted(map(json.dumps, got)) == sorted(map(json.dumps, expected + [{"id": "l"}, {"id": "m"}]))


def test_one_large_array_is_read_by_several_tasks(spark, tmp_path, small_ranges):
    rows = [{"userId": f"u{i}", "note": "[{}" * (i % 3)} for i in range(4000)]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    small_ranges(20_000)
    docs = json_documents(spark, str(tmp_path))
    assert {json.loads(r["value"])["userId"] for r in docs.collect()} == {r["userId"] for r in rows}
    assert docs.count() == 4000 and spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 5


def test_rules_written_side_by_side_and_read_again(spark, tmp_path):
    rules = rules_frame(spark, [{"ruleId": f"r{i:03d}", "ruleType": "ORDER_BRUSH", "targetActionType": "a}b", "windowSizeMs": 5,
                                 "threshold": 1, "version": i} for i in range(50)])
    for files in (1, 4):
        path = tmp_path / f"rules{files}"
        write_rule_array(rules, str(path), files=files)
        parts = sorted(p for p in path.iterdir() if p.name.startswith("part") and p.stat().st_size)
        listed = [rule["ruleId"] for p in parts for rule in json.loads(p.read_text())]
        assert listed == [f"r{i:03d}" for i in range(50)] and len(parts) == files
        assert decode_rules(json_documents(spark, str(path))).count() == 50
    write_rule_array(rules.limit(0), str(tmp_path / "none"))
    assert json_documents(spark, str(tmp_path / "none")).count() == 0
