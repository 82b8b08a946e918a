"""What the stream's processors ask of their state: once per key and micro-batch, once per altered rule."""

import numpy as np
import pandas as pd

from burstguard.schemas import BEHAVIOR_COLUMNS
from burstguard.streaming.arrival import ARRIVAL_COLUMNS, take_in
from burstguard.streaming.detection import FEW_EVENTS, SequenceProcessor
from burstguard.streaming.rulebook import _CHANGE_COLUMNS, _FACTS, RuleBook
from burstguard.streaming.timeline import KeyBuffer

RULE = ("r", "r", "HIGH_FREQ_ACCESS", 60_000, 200, 1.0, 1.0, "count")


class Map:
    def __init__(self):
        self.held, self.reads, self.writes = {}, 0, 0

    def exists(self):
        return bool(self.held)

    def iterator(self):
        return iter(self.held.items())

    def getValue(self, key):
        self.reads += 1
        return self.held.get(key)

    def updateValue(self, key, value):
        self.writes += 1
        self.held[key] = value

    def removeKey(self, key):
        self.writes += 1
        del self.held[key]


class Handle:
    def __init__(self):
        self.maps = {}

    def getMapState(self, name, *_):
        return self.maps.setdefault(name, Map())


def arrived(key, seq, time):
    event = (seq, "hit", "u", "VIEW", "1.1.1.1", time, None, None, None, None, None)
    return (0, key, *event, *RULE)


def frame(rows):
    return pd.DataFrame(rows, columns=["arrivedAt", *ARRIVAL_COLUMNS])


def test_a_key_costs_one_read_and_one_write_a_micro_batch():
    handle = Handle()
    keys = [f"k{i}" for i in range(500)]
    for batch in range(3):
        processor = SequenceProcessor()
        processor.init(handle)
        for m in handle.maps.values():
            m.reads = m.writes = 0
        rows = [arrived(k, 2 * batch + i, 1000 * batch + i) for k in keys for i in range(2)]
        assert all(f.empty for f in processor.handleInputRows((0,), iter([frame(rows[::2]), frame(rows[1::2])]), None))
        assert handle.maps["marks"].writes == 500 and handle.maps["marks"].reads == (500 if batch else 0)
        assert handle.maps["events"].writes == 0


def test_many_live_events_in_chunks_equal_one_buffer():
    handle, buffer, rng = Handle(), KeyBuffer(), np.random.default_rng(3)
    found, expected, seq = [], [], 0
    for size in (5, FEW_EVENTS, 90, 1, 150, 7, 300):
        rows = []
        for _ in range(size):
            rows += [arrived("k", seq, 1000 + seq * 200 - int(rng.integers(0, 900)))]
            seq += 1
        processor = SequenceProcessor()
        processor.init(handle)
        out = list(processor.handleInputRows((0,), iter([frame(rows)]), None))
        found += [list(s) for f in out for s in f.get("eventSeqs", [])]
        for row in rows:
            match = take_in(buffer, row[1], row[2 : 2 + 2 + len(BEHAVIOR_COLUMNS)], RULE)
            expected += [match["eventSeqs"]] if match else []
        assert len(handle.maps["events"].held) <= 8
    assert found == expected and len(found) > 1


def test_a_rule_is_written_once_a_micro_batch_however_often_it_changes():
    handle, processor = Handle(), RuleBook()
    processor.init(handle)
    facts = dict.fromkeys(_FACTS, "x") | {"windowSizeMs": 10.0, "threshold": 1.0, "severityWeight": 1.0, "scoreThreshold": 1.0}
    rows = []
    for n in range(400):
        rows.append({"arrivedAt": 2 * n, "lane": 0, "seq": n, "ruleId": "r", "off": False, "live": n % 2 == 0, "actions": ["VIEW"],
                     "parts": ["count"]} | facts | {"version": float(n)})
        rows.append({"arrivedAt": 2 * n + 1, "lane": 1, "seq": n, "watchedAction": "VIEW", "timestamp": 5.0})
    both = pd.DataFrame(rows, columns=["arrivedAt", "lane", "seq", *BEHAVIOR_COLUMNS, "watchedAction", *_CHANGE_COLUMNS])
    out = pd.concat(list(processor.handleInputRows((0,), iter([both]), None)))
    assert handle.maps["rules"].writes == 1
    assert [(s, v) for s, v in zip(out["seq"], out["version"])] == [(n, n) for n in range(0, 400, 2)]
