"""Rules that change while the stream runs, held in the state of one streaming query.

Events and rule changes are united on one clock: time of arrival, a change before an event of the same time, then the
number of the record. Events are dealt to shards, and every change goes to all of them, so that each shard keeps the
whole rule book as state, the way every worker of a stream would. A shard follows the changes in that order and notes
which range of its events each version of a rule was in force for; an event meets the rules in whose ranges it stands.
What matches goes on, in the same query, to the detectors' state.

Cost: a change is looked at once per shard, a version finds its events by binary search, and a micro-batch reads each
shard's book once and writes the rules it has altered once; rule sets are small beside the events of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from burstguard.functions.keys import group_key
from burstguard.operators.alerts import score_matches
from burstguard.operators.rules import detector_of, is_disabled_rule, is_enabled_rule, is_valid_rule, watched_actions
from burstguard.schemas import BEHAVIOR_COLUMNS
from burstguard.session import ROCKSDB
from burstguard.sources.decode import is_valid_event
from burstguard.streaming.arrival import arrival_rows
from burstguard.streaming.detection import stream_matches

SHARDS = 64
CHANGE_LANE, EVENT_LANE = 0, 1

_EVENT_DDL = (
    "userId string, actionType string, ip string, timestamp long, sessionId string, deviceId string, "
    "productId string, amount double, extra string"
)
_FACTS_DDL = (
    "ruleName string, ruleType string, windowSizeMs long, threshold int, severityWeight double, scoreThreshold double, "
    "version long, detector string, groupKeyType string"
)
_FACTS = [f.split(" ")[0] for f in _FACTS_DDL.split(", ")]
_BOOK_DDL = f"live boolean, {_FACTS_DDL}, actions array<string>, parts array<string>"
MATCHED_DDL = f"arrivedAt long, seq long, {_EVENT_DDL}, ruleId string, {_FACTS_DDL}, part string"
_MATCHED = ["arrivedAt", "seq", *BEHAVIOR_COLUMNS, "ruleId", *_FACTS, "part"]
_EVENT_COLUMNS = ["arrivedAt", "seq", *BEHAVIOR_COLUMNS, "watchedAction"]
_CHANGE_COLUMNS = ["ruleId", "off", "live", *_FACTS, "actions", "parts"]
# Pairs of an event and a rule handed on at once.
PAIRS_AT_ONCE = 20_000


def united(events: DataFrame, changes: DataFrame, strict_routing: bool = False, shards: int = SHARDS) -> DataFrame:
    """Events and rule changes as rows of one table, each with its ``shard`` and ``lane``. Both carry ``arrivedAt`` and
    ``seq``."""
    as_event = events.where(is_valid_event()).select(
        F.pmod(F.xxhash64("seq"), F.lit(shards)).cast("int").alias("shard"),
        "arrivedAt", F.lit(EVENT_LANE).alias("lane"), "seq", *BEHAVIOR_COLUMNS,
        F.upper("actionType").alias("watchedAction"),
    )
    watched = watched_actions(strict_routing)
    known = changes.where(F.coalesce(F.col("ruleId") != "", F.lit(False)) & (is_disabled_rule() | is_valid_rule()))
    as_change = known.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        "arrivedAt", F.lit(CHANGE_LANE).alias("lane"), "seq",
        "ruleId", is_disabled_rule().alias("off"), is_enabled_rule().alias("live"), "ruleName", "ruleType",
        "windowSizeMs", "threshold", "severityWeight", "scoreThreshold", "version",
        detector_of(F.col("ruleType")).alias("detector"), "groupKeyType",
        watched["watchedAction"].alias("actions"), watched["part"].alias("parts"),
    )
    return as_event.unionByName(as_change, allowMissingColumns=True)


class RuleBook(StatefulProcessor):
    """Per shard: the rules in force, by id, with the version that is in the book whether it may match or not."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rules = handle.getMapState("rules", "ruleId string", _BOOK_DDL)

    def _loaded(self) -> dict[str, tuple]:
        return {key[0]: tuple(value) for key, value in self.rules.iterator()} if self.rules.exists() else {}

    def _changed(self, book: dict[str, tuple], row) -> bool:
        """Applies one change: off removes a rule whatever its version, else only a higher version goes in."""
        if row.off:
            return book.pop(row.ruleId, None) is not None
        held = book.get(row.ruleId)
        if held is not None and held[1 + _FACTS.index("version")] >= row.version:
            return False
        facts = [None if value is None or value != value else value for value in (getattr(row, f) for f in _FACTS)]
        for whole in ("windowSizeMs", "threshold", "version"):
            facts[_FACTS.index(whole)] = int(facts[_FACTS.index(whole)])
        book[row.ruleId] = (bool(row.live), *facts, list(row.actions), list(row.parts))
        return True

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        arrived = pd.concat(list(rows), ignore_index=True).sort_values(["arrivedAt", "lane", "seq"], kind="stable", ignore_index=True)
        is_change = arrived["lane"].to_numpy() == CHANGE_LANE
        # where a change stands among the events
        places = np.cumsum(~is_change)[is_change]
        events = arrived.loc[~is_change, _EVENT_COLUMNS].reset_index(drop=True)
        changes = arrived.loc[is_change, _CHANGE_COLUMNS]
        del arrived
        yield from _met(events, self._spans(changes, places, len(events)))

    def _spans(self, changes: pd.DataFrame, places: np.ndarray, end: int) -> pd.DataFrame:
        """The rules that may match, a row for each action they watch, with the range of events that meet them."""
        book = self._loaded()
        since, spans, altered = dict.fromkeys(book, 0), [], set()

        def closed(rule_id: str, entry: tuple, to: int) -> None:
            live, *facts, actions, parts = entry
            if live and since[rule_id] < to:
                spans.extend((since[rule_id], to, rule_id, *facts, a, p) for a, p in zip(actions, parts))

        for place, row in zip(places.tolist(), changes.itertuples(index=False)):
            before = book.get(row.ruleId)
            if self._changed(book, row):
                altered.add(row.ruleId)
                if before is not None:
                    closed(row.ruleId, before, place)
                since[row.ruleId] = place
        for rule_id, entry in book.items():
            closed(rule_id, entry, end)
        for rule_id in altered:
            if rule_id in book:
                self.rules.updateValue((rule_id,), book[rule_id])
            else:
                self.rules.removeKey((rule_id,))
        return pd.DataFrame(spans, columns=["from", "to", "ruleId", *_FACTS, "watchedAction", "part"])

    def close(self) -> None:
        pass


def _met(events: pd.DataFrame, spans: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Events with the rules in whose range and of whose action they are."""
    by_action = events.groupby("watchedAction", sort=False).indices
    for action, mine in spans.groupby("watchedAction", sort=False):
        at = np.sort(by_action.get(action, np.empty(0, np.int64)))
        low, high = np.searchsorted(at, mine["from"].to_numpy()), np.searchsorted(at, mine["to"].to_numpy())
        ends = np.cumsum(high - low)
        total = int(ends[-1]) if len(ends) else 0
        for begin in range(0, total, PAIRS_AT_ONCE):
            pairs = np.arange(begin, min(begin + PAIRS_AT_ONCE, total))
            span = np.searchsorted(ends, pairs, side="right")
            event = at[high[span] - (ends[span] - pairs)]
            left = events.iloc[event].drop(columns="watchedAction").reset_index(drop=True)
            right = mine.iloc[span].drop(columns=["from", "to", "watchedAction"]).reset_index(drop=True)
            yield pd.concat([left, right], axis=1)[_MATCHED]


def live_matches(
    events: DataFrame, changes: DataFrame, strict_routing: bool = False, shards: int = SHARDS
) -> DataFrame:
    """Every event of a stream with the rules in force when it arrived, plus ``groupKey``: see ``match.match_rules``."""
    spark = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    matched = united(events, changes, strict_routing, shards).groupBy("shard").transformWithStateInPandas(
        statefulProcessor=RuleBook(), outputStructType=MATCHED_DDL, outputMode="Append", timeMode="None"
    )
    return matched.withColumn("groupKey", group_key(F.col("ruleId"), F.col("groupKeyType"))).drop("groupKeyType")


def detect_live(
    events: DataFrame, changes: DataFrame, strict_routing: bool = False, ttl_ms: int | None = None, shards: int = SHARDS
) -> DataFrame:
    """Alerts of a stream of events under a stream of rule changes, one query with one checkpoint."""
    rows = arrival_rows(live_matches(events, changes, strict_routing, shards))
    return score_matches(stream_matches(rows, ttl_ms))
