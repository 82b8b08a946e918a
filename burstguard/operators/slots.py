"""Sequence matches of whole batches of time slots, with whole arrays.

A batch holds the rows of many (key, slot) groups, sorted by key, slot, time and ``seq``; a group starts with the rows
within one reach (window + lateness) before its slot, its ``core`` rows follow. Every detector reduces to candidates: row
*i* completes a match when the buffer still reaches back to ``need[i]``. All groups then step together from match to
match, so that work follows the rows and the matches, not the groups.

What passes from slot to slot is a state ``(held, t, q)``: a free one, whose buffer holds the rows after ``(t, q)`` in
order of time and ``seq``; or one that is held back since a match at time ``t``, because a later one ended at the same
time. A slot maps the state it starts in to the one it ends in. Such a map is a short list: free states differ only by
the candidates that cross the border and that they still allow, held ones by their time.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from burstguard.schemas import LATENESS_MS

# A slot is so many reaches long.
SLOT_REACHES = 8
# Rows that are gathered before a batch is worked on, unless a group is larger.
BATCH_ROWS = 65_536

DETECTORS = ["count", "pair", "pay", "chain"]
COUNT, PAIR, PAY, CHAIN = range(4)
ROLES = ["hit", "first", "second", "login", "small", "large"]
HIT, FIRST, SECOND, LOGIN, SMALL, LARGE = range(6)

LEAST = np.iinfo(np.int64).min
FRESH = (0, int(LEAST), int(LEAST))

MAP_FIELDS = "starts array<long>, exits array<long>, heldTimes array<long>, heldExits array<long>"
MATCH_SCHEMA = pa.schema(
    [
        ("groupKey", pa.string()),
        ("ruleId", pa.string()),
        ("userId", pa.string()),
        ("ip", pa.string()),
        ("deviceId", pa.string()),
        ("matchCount", pa.int32()),
        ("firstEventTimestamp", pa.int64()),
        ("lastEventTimestamp", pa.int64()),
        ("eventSeqs", pa.list_(pa.int64())),
    ]
)
_LONGS = pa.list_(pa.int64())
MAP_SCHEMA = pa.schema(
    [("groupKey", pa.string()), ("slot", pa.int64())] + [(n, _LONGS) for n in ("starts", "exits", "heldTimes", "heldExits")]
)


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows in portions that end where a (key, slot) group ends."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        ends = [(b["groupKey"][i].as_py(), b["slot"][i].as_py()) for b, i in ((held[0], 0), (batch, batch.num_rows - 1))]
        if rows < BATCH_ROWS or ends[0] == ends[1]:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        cut = int(_starts(table)[-1])
        yield table.slice(0, cut)
        held = table.slice(cut).to_batches()
        rows = table.num_rows - cut
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _column(table: pa.Table, name: str) -> pa.Array:
    return table[name].combine_chunks()


def _starts(table: pa.Table) -> np.ndarray:
    """Where the groups of a table begin."""
    key, slot = _column(table, "groupKey"), _column(table, "slot").to_numpy()
    n = len(key)
    other = pc.not_equal(key.slice(1), key.slice(0, n - 1)).to_numpy(zero_copy_only=False)
    return np.flatnonzero(np.concatenate([[True], other | (slot[1:] != slot[:-1])]))


def _bisect(low: np.ndarray, high: np.ndarray, before: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Per range the first position that is not ``before`` what is looked for."""
    low, high = low.copy(), high.copy()
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) // 2
        left = before(middle, open_)
        low[open_[left]] = middle[left] + 1
        high[open_[~left]] = middle[~left]
        open_ = open_[low[open_] < high[open_]]
    return low


class Slots:
    """The groups of one table."""

    def __init__(self, table: pa.Table, slot_reaches: int = SLOT_REACHES):
        self.table, self.slot_reaches = table, slot_reaches
        self.first = _starts(table)
        self.size = table.num_rows
        self.end = np.append(self.first[1:], self.size)
        lengths = self.end - self.first
        self.group = np.repeat(np.arange(len(self.first)), lengths)
        self.t = _column(table, "timestamp").to_numpy()
        self.q = _column(table, "seq").to_numpy()
        inside = _column(table, "core").to_numpy(zero_copy_only=False)
        self.core = self.first + np.add.reduceat((~inside).astype(np.int64), self.first)
        window = _column(table, "windowSizeMs").to_numpy()
        self.reach = window[self.first] + LATENESS_MS
        self.window, self.n = window, _column(table, "threshold").to_numpy().astype(np.int64)
        self.detector = self._codes("detector", DETECTORS)
        self.role = self._codes("role", ROLES)
        self.need = self._needs()
        ends = np.flatnonzero(self.need >= 0)
        # next_end[p]: the earliest row that completes a match starting at p or later
        first_end = np.full(self.size + 1, self.size)
        np.minimum.at(first_end, self.need[ends], ends)
        self.next_end = np.minimum.accumulate(first_end[::-1])[::-1]
        self.ends = ends

    def _codes(self, name: str, values: list[str]) -> np.ndarray:
        return pc.fill_null(pc.index_in(_column(self.table, name), pa.array(values)), -1).to_numpy()

    def _needs(self) -> np.ndarray:
        need = np.full(self.size, -1)
        begin = self.first[self.group]
        at = np.arange(self.size)
        hits = np.flatnonzero(self.detector == COUNT)
        start = at[hits] - self.n[hits] + 1
        near = (start >= begin[hits]) & (self.t[hits] - self.t[np.maximum(start, 0)] <= self.window[hits])
        need[hits[near]] = start[near]
        seconds = np.flatnonzero((self.detector == PAIR) & (self.role == SECOND))
        if len(seconds):
            start = np.maximum.accumulate(np.where((self.detector == PAIR) & (self.role == FIRST), at, -1))[seconds]
            near = (start >= begin[seconds]) & (self.t[seconds] - self.t[np.maximum(start, 0)] <= self.window[seconds])
            need[seconds[near]] = start[near]
        paying = (self.detector == PAY) | (self.detector == CHAIN)
        if (paying & (self.role == LARGE)).any():
            self._payment_needs(need, begin, paying)
        return need

    def _payment_needs(self, need: np.ndarray, begin: np.ndarray, paying: np.ndarray) -> None:
        self.ip = pc.fill_null(pc.utf8_lower(_column(self.table, "ip")), "").dictionary_encode()
        names, self.ip = self.ip.dictionary, self.ip.indices.to_numpy()
        self.no_ip = pc.index(names, "").as_py()
        smalls = np.flatnonzero(paying & (self.role == SMALL))
        logins = np.flatnonzero(paying & (self.role == LOGIN) & (self.ip != self.no_ip))
        larges = np.flatnonzero(paying & (self.role == LARGE))
        behind = np.searchsorted(smalls, larges) - self.n[larges]
        larges, behind = larges[behind >= 0], behind[behind >= 0]
        if not len(larges) or not len(logins):
            return
        oldest = smalls[behind]
        chain = self.detector[larges] == CHAIN
        # a chain's login stands before its small payments, that of a payment match before the large one
        place = np.searchsorted(logins, np.where(chain, oldest, larges)) - 1
        login = np.where(place >= 0, logins[place], -1)
        # the last login from another address than the one at ``place``
        turned = np.flatnonzero(np.diff(self.ip[logins])) + 1
        turn = np.searchsorted(turned, place, side="right") - 1
        before_turn = np.full(len(place), -1)
        if len(turned):
            before_turn = np.where(turn >= 0, logins[turned[turn] - 1], -1)
        same = (login >= 0) & (self.ip[login] == self.ip[larges]) & ~chain
        login = np.where(same, before_turn, login)
        login = np.where(~chain & (self.ip[larges] == self.no_ip), -1, login)
        ok = (login >= begin[larges]) & (oldest >= begin[larges])
        ok &= self.t[larges] - self.t[np.maximum(login, 0)] <= self.window[larges]
        ok &= self.t[larges] - self.t[oldest] <= self.window[larges]
        need[larges[ok]] = np.minimum(login, oldest)[ok]

    def _after(self, groups: np.ndarray, time: np.ndarray) -> np.ndarray:
        """The first row of each group later than ``time``."""
        return _bisect(self.first[groups], self.end[groups], lambda at, i: self.t[at] <= time[i])

    def run(self, group: np.ndarray, held: np.ndarray, place: np.ndarray, last: np.ndarray, taken: list | None = None):
        """Steps from match to match until nothing more happens in the groups; changes ``held, place, last`` in place.
        ``taken`` gets (run, end, start of the buffer) of the matches."""
        active = np.arange(len(group))
        while len(active):
            bound = held[active]
            free = active[~bound]
            end = self.next_end[place[free]]
            on = end < self.end[group[free]]
            free, end = free[on], end[on]
            tie = self.t[end] == last[free]
            held[free[tie]] = True
            moved, end = free[~tie], end[~tie]
            if taken is not None and len(moved):
                taken.append((moved, end, place[moved]))
            place[moved], last[moved] = end + 1, self.t[end]
            # a held key moves on with the first arrival past the reach of the rows that hold it
            bound = active[bound]
            arrival = self._after(group[bound], last[bound] + self.reach[group[bound]])
            on = arrival < self.end[group[bound]]
            bound, arrival = bound[on], arrival[on]
            buffer = self._after(group[bound], self.t[arrival] - self.reach[group[bound]] - 1)
            end = self.next_end[buffer]
            done = end <= arrival
            if taken is not None and done.any():
                taken.append((bound[done], end[done], buffer[done]))
            place[bound] = np.where(done, arrival + 1, buffer)
            last[bound] = np.where(done, self.t[np.minimum(end, self.size - 1)], LEAST)
            held[bound] = False
            active = np.sort(np.concatenate([free, bound]))

    def _states(self, group: np.ndarray, held: np.ndarray, place: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Where runs ended, as rows (held, t, q)."""
        some = ~held & (place > self.first[group])
        t = np.where(held, last, np.where(some, self.t[place - 1], LEAST))
        return np.stack([held.astype(np.int64), t, np.where(some, self.q[place - 1], np.where(held, 0, LEAST))], axis=1)

    def maps(self) -> pa.RecordBatch:
        """The maps of the groups that the slot after them can see."""
        slot = _column(self.table, "slot").to_numpy()
        span = self.reach * self.slot_reaches
        seen = (self.core < self.end) & (self.t[self.end - 1] >= (slot[self.first] + 1) * span - self.reach)
        groups = np.flatnonzero(seen)
        linked = seen & (self.core > self.first)
        # free states: those from which a candidate across the border can still be reached, and all later ones
        of = self.group[self.ends]
        start = self.need[self.ends]
        crossing = linked[of] & (self.ends >= self.core[of]) & (start < self.core[of])
        start = np.unique(start[crossing])
        of = self.group[start]
        useful = self.next_end[start] >= self.core[of]
        start, of = start[useful], of[useful]
        ahead = self.next_end[start]
        # of starts that lead to the same match only the last one counts
        final = np.append((ahead[1:] != ahead[:-1]) | (of[1:] != of[:-1]), np.ones(min(1, len(of)), bool))
        start, of = start[final], of[final]
        # held states: the times at which a whole match can stand, and any earlier time
        ties = self.ends[(self.t[self.need[self.ends]] == self.t[self.ends])]
        ties = ties[linked[self.group[ties]] & (ties < self.core[self.group[ties]])]
        tie_of, tie_t = self.group[ties], self.t[ties]
        fresh = np.ones(len(ties), bool)
        fresh[1:] = (tie_of[1:] != tie_of[:-1]) | (tie_t[1:] != tie_t[:-1])
        tie_of, tie_t = tie_of[fresh], tie_t[fresh]
        older = groups[linked[groups]]
        group = np.concatenate([of, groups, tie_of, older])
        place = np.concatenate([start, np.where(linked[groups], self.core[groups], self.first[groups]), tie_of * 0, older * 0])
        held = np.arange(len(group)) >= len(of) + len(groups)
        last = np.full(len(group), LEAST)
        last[held] = np.concatenate([tie_t, self.t[self.core[older]] - self.reach[older] - 1])
        self.run(group, held, place, last)
        ends = self._states(group, held, place, last)
        n_free = len(of) + len(groups)
        # in a group its starts come first, then the state that allows none; so with times
        free_order = np.lexsort((np.repeat([0, 1], [len(of), len(groups)]), group[:n_free]))
        held_order = n_free + np.lexsort((np.repeat([0, 1], [len(tie_of), len(older)]), group[n_free:]))

        def lists(owners: np.ndarray, values: np.ndarray) -> pa.Array:
            width = values.shape[1]
            sizes = np.bincount(owners, minlength=len(self.first))[groups] * width
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(values).ravel(), pa.int64()))

        chosen = pa.array(self.first[groups])
        arrays = [
            _column(self.table, "groupKey").take(chosen), pa.array(slot[self.first[groups]]),
            lists(of, np.stack([self.t[start], self.q[start]], axis=1)), lists(group[free_order], ends[free_order]),
            lists(tie_of, tie_t[:, None]), lists(group[held_order], ends[held_order]),
        ]
        return pa.RecordBatch.from_arrays(arrays, schema=MAP_SCHEMA)

    def matches(self) -> pa.RecordBatch:
        """The matches of all groups that have rows of their own, from the states in ``held, stateT, stateQ``."""
        group = np.flatnonzero(self.core < self.end)
        rows = pa.array(self.first[group])
        given = {
            name: pc.fill_null(_column(self.table, name).take(rows), default).to_numpy()
            for name, default in (("held", 0), ("stateT", int(LEAST)), ("stateQ", int(LEAST)))
        }
        t, q = given["stateT"], given["stateQ"]
        place = _bisect(
            self.first[group], self.core[group],
            lambda at, i: (self.t[at] < t[i]) | ((self.t[at] == t[i]) & (self.q[at] <= q[i])),
        )
        taken: list = []
        self.run(group, given["held"] == 1, place, t.copy(), taken)
        found = [self._matched(int(e), int(p)) for _, ends, starts in taken for e, p in zip(ends, starts)]
        first = pa.array([int(rows[0]) for rows in found], pa.int64())
        columns = [_column(self.table, name).take(first) for name in ("groupKey", "ruleId", "userId", "ip", "deviceId")]
        counts = np.array([len(rows) for rows in found], np.int64)
        flat = np.concatenate(found) if found else np.zeros(0, np.int64)
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
        last = np.concatenate([ends for _, ends, _ in taken]) if taken else np.zeros(0, np.int64)
        arrays = columns + [
            pa.array(counts.astype(np.int32)), pa.array(self.t[first.to_numpy()]), pa.array(self.t[last]),
            pa.ListArray.from_arrays(offsets, pa.array(self.q[flat])),
        ]
        return pa.RecordBatch.from_arrays(arrays, schema=MATCH_SCHEMA)

    def _matched(self, end: int, buffer: int) -> np.ndarray:
        """The rows of a match by time; of equal times in a payment match the login stands first."""
        kind = self.detector[end]
        if kind == COUNT:
            return np.arange(end - self.n[end] + 1, end + 1)
        if kind == PAIR:
            return np.array([self.need[end], end])
        span = np.arange(self.need[end] if kind == CHAIN else buffer, end)
        span = span[self.t[end] - self.t[span] <= self.window[end]]
        smalls = span[self.role[span] == SMALL]
        if kind == CHAIN:
            return np.concatenate([[self.need[end]], smalls, [end]])
        logins = span[(self.role[span] == LOGIN) & (self.ip[span] != self.no_ip) & (self.ip[span] != self.ip[end])]
        found = np.concatenate([[logins[np.argmax(self.t[logins])]], smalls, [end]])
        return found[np.argsort(self.t[found], kind="stable")]


def slot_maps(batches: Iterator[pa.RecordBatch], slot_reaches: int) -> Iterator[pa.RecordBatch]:
    for table in whole_groups(batches):
        yield Slots(table, slot_reaches).maps()


def slot_matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in whole_groups(batches):
        yield Slots(table).matches()


class Map:
    """What a slot, or a run of slots, makes of the state it starts in."""

    def __init__(self, starts, exits, held_times, held_exits):
        self.starts, self.exits, self.held_times, self.held_exits = starts, exits, held_times, held_exits

    @classmethod
    def read(cls, row: dict) -> Map:
        flat, held = row["exits"], row["heldExits"]
        starts = list(zip(row["starts"][::2], row["starts"][1::2]))
        exits = list(zip(flat[::3], flat[1::3], flat[2::3]))
        return cls(starts, exits, row["heldTimes"], list(zip(held[::3], held[1::3], held[2::3])) or exits)

    def row(self) -> dict:
        return {
            "starts": [x for s in self.starts for x in s], "exits": [x for s in self.exits for x in s],
            "heldTimes": self.held_times, "heldExits": [x for s in self.held_exits for x in s],
        }

    def __call__(self, state: tuple[int, int, int]) -> tuple[int, int, int]:
        held, t, q = state
        if not held:
            return self.exits[bisect_right(self.starts, (t, q))]
        at = bisect_left(self.held_times, t)
        known = at < len(self.held_times) and self.held_times[at] == t
        return self.held_exits[at if known else -1]

    def then(self, other: Map) -> Map:
        return Map(self.starts, [other(s) for s in self.exits], self.held_times, [other(s) for s in self.held_exits])

    def always_fresh(self) -> Map:
        end = self(FRESH)
        return Map([], [end], [], [end])
