"""Detection in order of arrival, one key at a time: what a stream does, and a batch replay of it.

The order in which events arrive decides what matches, so this is sequential within a key. Keys are
spread over the cluster; a key's memory is its live buffer (one window plus the lateness), never
its history, and an arrival costs what it displaces (see ``timeline``).
"""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstguard.operators.alerts import score_matches
from burstguard.operators import registry
from burstguard.operators.roles import with_roles
from burstguard.schemas import BEHAVIOR_COLUMNS
from burstguard.streaming.timeline import KeyBuffer

EVENT_FIELDS = ["seq", "role", *BEHAVIOR_COLUMNS]
RULE_FIELDS = ["ruleId", "ruleName", "ruleType", "windowSizeMs", "threshold", "severityWeight", "scoreThreshold",
               "detector"]
ARRIVAL_COLUMNS = ["groupKey", *EVENT_FIELDS, *RULE_FIELDS]
# What rows are ordered by: the time of arrival, where a stream has one, then the number of the record.
ARRIVAL_ORDER = ["arrivedAt", "seq"]

_TIME, _ROLE, _IP = (EVENT_FIELDS.index(f) for f in ("timestamp", "role", "ip"))
_DETECTOR, _WINDOW, _THRESHOLD = (RULE_FIELDS.index(f) for f in ("detector", "windowSizeMs", "threshold"))
_EVENT_DDL = (
    "userId string, actionType string, ip string, timestamp long, sessionId string, deviceId string, "
    "productId string, amount double, extra string"
)
ARRIVAL_MATCH_SCHEMA = (
    "groupKey string, ruleId string, ruleName string, ruleType string, windowSizeMs long, threshold int, "
    "severityWeight double, scoreThreshold double, userId string, ip string, deviceId string, matchCount int, "
    "firstEventTimestamp long, lastEventTimestamp long, eventSeqs array<long>, "
    f"triggerEvents array<struct<{_EVENT_DDL}>>"
)


def plain_values(column: pd.Series) -> list:
    """Values of a column, None for missing ones."""
    values = column.tolist()
    if column.dtype.kind in "iub":
        return values
    missing = column.isna().to_numpy()
    return [None if m else v for m, v in zip(missing, values)] if missing.any() else values


def arrivals(pdf: pd.DataFrame) -> Iterator[tuple[str, tuple, tuple]]:
    """(key, event, rule) of the rows of a frame, fields in the order of the lists above, None for missing values."""
    width = 1 + len(EVENT_FIELDS)
    columns = [plain_values(pdf[c]) for c in ARRIVAL_COLUMNS]
    for row in zip(*columns):
        yield row[0], row[1:width], row[width:]


def own_detectors(finders: dict[str, registry.Find]) -> dict:
    """Detectors of a user's own as the buffer calls them: on events as dicts."""

    def adapted(find: registry.Find):
        def on_tuples(events: list[tuple], window: int, threshold: int) -> list[tuple] | None:
            rows = [dict(zip(EVENT_FIELDS, e)) for e in events]
            places = {id(r): i for i, r in enumerate(rows)}
            found = find(rows, window, threshold)
            return [events[places[id(r)]] for r in found] if found else None

        return on_tuples

    return {name: adapted(find) for name, find in finders.items()}


def take_in(buffer: KeyBuffer, key: str, event: tuple, rule: tuple) -> dict | None:
    """The match that an event completes, as an output row."""
    found = buffer.arrive(
        event[_TIME], event[_ROLE], event[_IP], event, rule[_DETECTOR], rule[_WINDOW], rule[_THRESHOLD]
    )
    if found is None:
        return None
    facts = dict(zip(RULE_FIELDS, rule))
    rows = [dict(zip(EVENT_FIELDS, e)) for e in found]
    first = rows[0]
    return {f: facts[f] for f in RULE_FIELDS if f != "detector"} | {
        "groupKey": key,
        "userId": first["userId"],
        "ip": first["ip"],
        "deviceId": first["deviceId"],
        "matchCount": len(rows),
        "firstEventTimestamp": first["timestamp"],
        "lastEventTimestamp": rows[-1]["timestamp"],
        "eventSeqs": [r["seq"] for r in rows],
        "triggerEvents": [{c: r[c] for c in BEHAVIOR_COLUMNS} for r in rows],
    }


def match_frame(records: list[dict]) -> pd.DataFrame:
    columns = [part.split(" ")[0] for part in ARRIVAL_MATCH_SCHEMA.split(", triggerEvents")[0].split(", ")]
    return pd.DataFrame(records, columns=[*columns, "triggerEvents"])


def arrival_rows(matched: DataFrame) -> DataFrame:
    """Matched pairs reduced to what detection in arrival order needs."""
    if "arrivedAt" not in matched.columns:
        matched = matched.withColumn("arrivedAt", F.lit(0).cast("bigint"))
    if "role" not in matched.columns:
        matched = with_roles(matched)
    return matched.select("arrivedAt", *ARRIVAL_COLUMNS)


def replay_matches(matched: DataFrame) -> DataFrame:
    """Matches of a batch of matched pairs in order of arrival, the rule columns taken per event.

    One shuffle on the key and a sort; the rows are then streamed, carrying the current key's
    buffer from one Arrow batch to the next.
    """
    own = own_detectors(dict(registry.FINDERS))

    def replay(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, buffer = None, KeyBuffer(own)
        for pdf in batches:
            out = []
            for key, event, rule in arrivals(pdf):
                if key != current:
                    current, buffer = key, KeyBuffer(own)
                found = take_in(buffer, key, event, rule)
                if found:
                    out.append(found)
            yield match_frame(out)

    ordered = arrival_rows(matched).repartition("groupKey").sortWithinPartitions("groupKey", *ARRIVAL_ORDER)
    return ordered.mapInPandas(replay, ARRIVAL_MATCH_SCHEMA)


def detect_in_arrival_order(matched: DataFrame) -> DataFrame:
    """Alerts of matched pairs (see ``match_rules_asof`` for changing rules) in order of ``seq``."""
    return score_matches(replay_matches(matched))


def evidence_of(matches: DataFrame) -> DataFrame:
    return matches.select("groupKey", "lastEventTimestamp", F.explode("triggerEvents").alias("e")).select(
        "groupKey", "lastEventTimestamp", "e.*"
    )
