"""Non-overlapping sequence matches per key, in event-time order.

Input rows carry ``groupKey, timestamp, seq, userId, ip, deviceId``, the rule columns
``ruleId``, ``windowSizeMs`` and ``threshold``, a ``detector`` and the ``role`` the row plays in it:

=========  ==================================================================  ====================
detector   a match                                                             roles
=========  ==================================================================  ====================
count      ``threshold`` rows within the window                                hit
pair       a second row with the latest first row within the window before it  first, second
pay        a large payment, ``threshold`` small ones and a login from another  login, small, large
           ip, all within the window before it
chain      a login, then ``threshold`` small payments, then a large one        login, small, large
=========  ==================================================================  ====================

Matches are taken by earliest end and consume everything up to the row whose arrival completed them. A match must end
strictly later than the one before it; one that does not holds back all others until its rows are ``LATENESS_MS`` past
the window.

All keys go one way. Their rows are cut into time slots a few windows long, each also seeing the rows one reach (window +
lateness) before it, which is as far as a match or a held key looks back. So

1. each slot works out, by itself, which state it ends in for each state it may start in (see ``slots``);
2. these small maps are composed: first over blocks of slots, giving one map a block, then over the blocks of a key, then
   inside each block again, now from its true start;
3. each slot takes its matches from its true start.

The rows are shuffled once, by key and slot; steps 1 and 3 read the same exchange. The unit of work is one key's rows in a
slot, and no group grows with a key's history: a slot lasts 40 seconds at least, so a block spans two days and a year of
one key is 200 blocks.
"""

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from burstguard.operators import slots
from burstguard.schemas import LATENESS_MS

SEQUENCE_COLUMNS = ["groupKey", "ruleId", "timestamp", "seq", "userId", "ip", "deviceId", "detector", "role",
                    "windowSizeMs", "threshold"]

# Slots whose maps are composed in one group.
BLOCK_SLOTS = 4096

MATCHES = (
    "groupKey string, ruleId string, userId string, ip string, deviceId string, matchCount int, "
    "firstEventTimestamp long, lastEventTimestamp long, eventSeqs array<long>"
)
MAPS = f"groupKey string, slot long, {slots.MAP_FIELDS}"
STATES = "groupKey string, slot long, held long, stateT long, stateQ long"


def in_time_slots(rows: DataFrame, slot_reaches: int = slots.SLOT_REACHES) -> DataFrame:
    """Each row in its slot and, within a reach of the border, in the next one too, where it is not ``core``.

    For ``count`` only the first ``2 * threshold + 2`` rows of a key and millisecond are kept: a match ends with one of
    the first ``threshold``, another ``threshold`` make one that holds the key back, and two more arrivals may pass
    while a held key is let go. Later rows of that time change nothing, so a slot is bounded by its window.
    """
    reach = F.col("windowSizeMs") + LATENESS_MS
    span = reach * slot_reaches

    def slot_of(time):
        return F.call_function("div", time - F.pmod(time, span), span)

    own, reached = slot_of(F.col("timestamp")), slot_of(F.col("timestamp") + reach)
    same_time = Window.partitionBy("groupKey", "slot", "timestamp").orderBy("seq")
    return (
        rows.select(*SEQUENCE_COLUMNS, F.explode(F.sequence(own, reached)).alias("slot"))
        .withColumn("core", F.col("slot") == slot_of(F.col("timestamp")))
        .repartition("groupKey", "slot")
        .withColumn("_place", F.row_number().over(same_time))
        .where((F.col("_place") <= 2 * F.col("threshold") + 2) | (F.col("detector") != "count"))
        .drop("_place")
    )


def _composed(batches: Iterator[pa.RecordBatch], block_slots: int) -> Iterator[pa.RecordBatch]:
    """One map per block of slots, of those whose last slot the next block can see."""
    key, before, run = None, None, None
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            slot, one = row["slot"], slots.Map.read(row)
            inside = slot % block_slots
            if row["groupKey"] != key or slot - 1 != before or inside == 0:
                run = one if inside == 0 else one.always_fresh()
            else:
                run = run.then(one)
            key, before = row["groupKey"], slot
            if inside == block_slots - 1:
                out.append({"groupKey": key, "slot": slot // block_slots} | run.row())
        yield pa.RecordBatch.from_pylist(out, schema=slots.MAP_SCHEMA)


_STATE_SCHEMA = pa.schema(
    [("groupKey", pa.string()), ("slot", pa.int64()), ("held", pa.int64()), ("stateT", pa.int64()), ("stateQ", pa.int64())]
)


def _followed(batches: Iterator[pa.RecordBatch], block_slots: int) -> Iterator[pa.RecordBatch]:
    """The state in which the slot after each one starts. Where a block begins its state may be given."""
    key, before, state = None, None, slots.FRESH
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["groupKey"] != key or row["slot"] - 1 != before:
                state = slots.FRESH
            if row.get("stateT") is not None and row["slot"] % block_slots == 0:
                state = (row["held"], row["stateT"], row["stateQ"])
            key, before, state = row["groupKey"], row["slot"], slots.Map.read(row)(state)
            out.append((key, before + 1, *state))
        columns = list(zip(*out)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _STATE_SCHEMA)], schema=_STATE_SCHEMA)


def slot_states(maps: DataFrame, block_slots: int = BLOCK_SLOTS) -> DataFrame:
    """``groupKey, slot, held, stateT, stateQ``: the state a slot starts in, where the slot before it can tell."""
    inside = F.pmod("slot", F.lit(block_slots))
    blocked = maps.withColumn("block", F.call_function("div", F.col("slot") - inside, F.lit(block_slots)))
    by_block = blocked.repartition("groupKey", "block")
    composed, followed = partial(_composed, block_slots=block_slots), partial(_followed, block_slots=block_slots)
    blocks = by_block.drop("block").sortWithinPartitions("groupKey", "slot").mapInArrow(composed, MAPS)
    tops = blocks.repartition("groupKey").sortWithinPartitions("groupKey", "slot").mapInArrow(followed, STATES)
    given = tops.withColumnRenamed("slot", "block")
    placed = by_block.join(given, ["groupKey", "block"], "left").drop("block")
    return placed.sortWithinPartitions("groupKey", "slot").mapInArrow(followed, STATES)


def select_matches(
    rows: DataFrame, slot_reaches: int = slots.SLOT_REACHES, block_slots: int = BLOCK_SLOTS
) -> DataFrame:
    """All matches of ``rows``, whatever the length of slots and blocks."""
    slotted = in_time_slots(rows, slot_reaches)
    order = ["groupKey", "slot", "timestamp", "seq"]
    maps = slotted.sortWithinPartitions(*order).mapInArrow(partial(slots.slot_maps, slot_reaches=slot_reaches), MAPS)
    started = slotted.join(slot_states(maps, block_slots), ["groupKey", "slot"], "left")
    return started.sortWithinPartitions(*order).mapInArrow(slots.slot_matches, MATCHES)
