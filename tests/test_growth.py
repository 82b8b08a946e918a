"""Work that must not grow faster than its input."""

import random
import tracemalloc

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from burstguard.operators import match
from burstguard.operators.match import match_rules_asof
from burstguard.operators.rules import rule_history
from burstguard.plans import queries as q
from burstguard.streaming.tables import FeatureProcessor
from test_rulebook import change_log
from test_streaming import event_frame, make_events

TINY = "/root/testdata/sf0.001"


def test_an_event_meets_few_versions_however_long_the_changelog():
    for versions in (1_000, 60_000, 360_000):
        buckets = match.asof_buckets(versions, 25)
        # versions that begin in a bucket, beside the 25 in force
        assert versions / buckets < 25
        assert versions + 25 * buckets <= 5 * versions
    assert match.asof_buckets(0, 0) == 1 and match.asof_buckets(3, 3) == 4


@pytest.mark.parametrize("salts", [2, 64])
def test_as_of_matches_by_shuffle_equal_those_by_broadcast(spark, monkeypatch, salts):
    """Also before the first and after the last change, where all events share a bucket."""
    events = event_frame(spark, make_events(5, 200)).withColumn("seq", F.col("seq") * 10)
    history = rule_history(change_log(spark, 4, 60, 120))

    def rows():
        return sorted(tuple(r) for r in match_rules_asof(events, history).select("seq", "ruleId", "version", "part").collect())

    expected = rows()
    monkeypatch.setattr(match, "BROADCAST_RULE_ROWS", 0)
    monkeypatch.setattr(match, "SALTS", salts)
    assert rows() == expected and len(expected) > 100 and max(expected)[0] > 1200


class Value:
    held = None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value


def features(rows, held=None, ttl=1000):
    processor = FeatureProcessor(ttl, False)
    processor.feature = Value()
    processor.feature.held = held
    return [tuple(r) for r in processor.handleInputRows(("k",), iter(rows), None)], processor.feature.held


def write(at, seq, kind=None, ip=None):
    return Row(featureKey="k", writtenAt=at, seq=seq, ruleType=kind, ip=ip, extra=None)


def test_rows_of_a_key_are_not_kept():
    tracemalloc.start()
    out, _ = features((write(5_000 + i % 900, i, f"t{i}", "x" * 2_000 + str(i)) for i in range(50_000)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    last = max((i % 900, i) for i in range(50_000))[1]
    assert out == [("k", 5_899, f"t{last}", "x" * 2_000 + str(last), None)] and peak < 2_000_000


def test_any_order_and_cut_of_rows_gives_the_same_lives():
    rng = random.Random(8)
    for _ in range(200):
        rows = [write(rng.choice([0, 300, 999, 1000, 1500, 2600, 4000, 4999]) + rng.randint(0, 3), i, rng.choice([None, "a", "b"]),
                      rng.choice([None, "x", "y"])) for i in range(8)]
        in_order = sorted(rows, key=lambda r: (r.writtenAt, r.seq))
        held = None
        for row in in_order:
            one, held = features([row], held)
        rng.shuffle(rows)
        assert features(rows) == (one, held)


def test_alerts_that_are_delivered_again_are_found_once(spark, monkeypatch):
    plans = []
    written = q._written_stream

    def noted(spark, rows, name):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return written(spark, rows, name)

    monkeypatch.setattr(q, "_written_stream", noted)
    q.stream_alert_table(spark, TINY)
    once = q._stamped(spark, TINY)._jdf.queryExecution().optimizedPlan().toString()
    assert plans[0].count("Relation [") == once.count("Relation [") > 0
