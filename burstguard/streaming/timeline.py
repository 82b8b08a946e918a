"""One key's live events, kept so that an arrival costs what it displaces, not what is there.

Events stand in order of time, equal times in order of arrival, in one sorted list per role. Since an event can only
complete matches that end with it or after it, the search goes on where it last ended: ``clean`` says that no match ends
before it, and an arrival moves it back to its own place at most. An event in order of time is looked at once.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from burstguard.schemas import LATENESS_MS

Key = tuple[int, int]  # time, number of arrival
START: Key = (-(1 << 63), -1)
OPEN: Key = ((1 << 63) - 1, 0)

ROLES = {"count": ("hit",), "pair": ("first", "second"), "pay": ("login", "small", "large")}
ENDS = {"count": "hit", "pair": "second", "pay": "large"}


class Line:
    """Sorted keys; those at the front fall out without moving the others."""

    __slots__ = ("keys", "head")

    def __init__(self):
        self.keys: list[Key] = []
        self.head = 0

    def __len__(self) -> int:
        return len(self.keys) - self.head

    def add(self, key: Key) -> None:
        if not self.keys or key > self.keys[-1]:
            self.keys.append(key)
        else:
            insort(self.keys, key, lo=self.head)

    def discard(self, key: Key) -> None:
        at = self.before(key)
        if at < len(self.keys) and self.keys[at] == key:
            del self.keys[at]

    def before(self, key: tuple) -> int:
        """Position of the first key that is not smaller."""
        return bisect_left(self.keys, key, self.head)

    def last_before(self, key: tuple) -> Key | None:
        at = self.before(key) - 1
        return self.keys[at] if at >= self.head else None

    def expire(self, oldest: int) -> list[Key]:
        """Drops the keys older than a time and returns them."""
        if self.head == len(self.keys) or self.keys[self.head][0] >= oldest:
            return []
        begin, self.head = self.head, self.before((oldest,))
        gone = self.keys[begin : self.head]
        if self.head > 64 and self.head * 2 > len(self.keys):
            del self.keys[: self.head]
            self.head = 0
        return gone


class KeyBuffer:
    """Takes in the events of one key in order of arrival and gives the matches they complete.

    An event is any object; its time, role and ip are handed over with it. The rule's parameters are those of the version
    the event was matched with; when they change the search starts anew.
    """

    def __init__(self, finders: dict | None = None):
        self.finders = finders or {}
        self.newest: int | None = None
        self.emitted: int | None = None
        self.arrived = 0
        self.clean: Key = START
        self.shape: tuple | None = None
        self.floor = 0  # what is older has fallen out
        self.emptied = False
        self.looked = 0  # events that were tried as the end of a match
        self._empty()

    def _empty(self) -> None:
        self.events: dict[Key, tuple] = {}  # key -> (event, role, lower-case ip)
        self.lines: dict[str, Line] = {}
        self.turns = Line()  # logins that come from another ip than the login before them

    def restore(self, key: Key, event, role: str, ip: str | None) -> None:
        """Puts back an event that was kept; keys ascend."""
        self._place(key, event, role, ip)

    def _line(self, role: str) -> Line:
        if role not in self.lines:
            self.lines[role] = Line()
        return self.lines[role]

    def _place(self, key: Key, event, role: str, ip: str | None) -> None:
        self.events[key] = (event, role, ip)
        line = self._line(role)
        line.add(key)
        if role == "login":
            at = line.before(key)
            self._mark(line, at)
            self._mark(line, at + 1)

    def _mark(self, logins: Line, at: int) -> None:
        """Notes whether the login at a position comes from another ip than the one before it."""
        if at >= len(logins.keys):
            return
        key = logins.keys[at]
        turned = at > logins.head and self.events[logins.keys[at - 1]][2] != self.events[key][2]
        self.turns.discard(key)
        if turned:
            self.turns.add(key)

    def _expire(self, oldest: int) -> None:
        self.floor = oldest
        for line in self.lines.values():
            for key in line.expire(oldest):
                del self.events[key]
        self.turns.expire(oldest)

    def arrive(self, time: int, role: str, ip: str | None, event, detector: str, window: int, threshold: int) -> list | None:
        """The events of the match that this arrival completes, by time; None without one."""
        self.newest = time if self.newest is None else max(self.newest, time)
        if self.shape != (detector, window, threshold):
            self.shape, self.clean = (detector, window, threshold), START
        key = (time, self.arrived)
        self.arrived += 1
        ip = ip.lower() if ip else None
        # what no match can hold is not kept: other roles, payments and logins without an address
        find = self.finders.get(detector)
        if find or (role in ROLES[detector] and (ip or role not in ("login", "large"))):
            self._place(key, event, role, ip)
            self.clean = min(self.clean, key)
        self._expire(max(0, self.newest - window - LATENESS_MS))
        if find:
            return self._found(find, window, threshold)
        end = self._next_match(detector, window, threshold)
        if end is None or (self.emitted is not None and end[0] <= self.emitted):
            return None
        return self._taken([self.events[k][0] for k in self._matched(end, detector, window, threshold)], end[0])

    def _taken(self, found: list, time: int) -> list:
        self.emitted, self.newest, self.clean = time, None, START
        self._empty()
        self.emptied = True
        return found

    def _found(self, find, window: int, threshold: int) -> list | None:
        """A user's detector: it is given the whole buffer at every arrival, under the same rules for what may end."""
        self.looked += len(self.events)
        found = find([self.events[k][0] for k in sorted(self.events)], window, threshold)
        if not found:
            return None
        last = max(k[0] for k, (event, _, _) in self.events.items() if any(event is f for f in found))
        return None if self.emitted is not None and last <= self.emitted else self._taken(found, last)

    def _next_match(self, detector: str, window: int, threshold: int) -> Key | None:
        """The first end of a match; ``clean`` moves there, so that a match that may not end yet is found at once."""
        ends = self._line(ENDS[detector])
        completes = getattr(self, f"_{detector}")
        for at in range(ends.before(self.clean), len(ends.keys)):
            self.looked += 1
            if completes(ends, at, window, threshold):
                self.clean = ends.keys[at]
                return self.clean
        self.clean = OPEN
        return None

    def _count(self, hits: Line, at: int, window: int, threshold: int) -> bool:
        first = at - threshold + 1
        return first >= hits.head and hits.keys[at][0] - hits.keys[first][0] <= window

    def _pair(self, seconds: Line, at: int, window: int, threshold: int) -> bool:
        first = self._line("first").last_before(seconds.keys[at])
        return first is not None and seconds.keys[at][0] - first[0] <= window

    def _smalls(self, end: Key, window: int) -> list[Key]:
        line = self._line("small")
        return line.keys[line.before((end[0] - window,)) : line.before(end)]

    def _remote_login(self, end: Key) -> Key | None:
        """The latest login before a payment from another address: the latest one, or the one before its run began."""
        logins = self._line("login")
        latest = logins.last_before(end)
        if latest is None or self.events[latest][2] != self.events[end][2]:
            return latest
        turn = self.turns.last_before((latest[0], latest[1] + 1))
        return logins.last_before(turn) if turn is not None else None

    def _pay(self, larges: Line, at: int, window: int, threshold: int) -> bool:
        end = larges.keys[at]
        line = self._line("small")
        if line.before(end) - line.before((end[0] - window,)) < threshold:
            return False
        login = self._remote_login(end)
        return login is not None and end[0] - login[0] <= window

    def _matched(self, end: Key, detector: str, window: int, threshold: int) -> list[Key]:
        if detector == "count":
            hits = self._line("hit")
            at = hits.before(end)
            return hits.keys[at - threshold + 1 : at + 1]
        if detector == "pair":
            return [self._line("first").last_before(end), end]
        time, home = self._remote_login(end)[0], self.events[end][2]
        logins = self._line("login")
        # of logins at that time the first to arrive; of equal times the login stands first
        at = logins.before((time,))
        while self.events[logins.keys[at]][2] == home:
            at += 1
        return sorted([logins.keys[at], *self._smalls(end, window), end], key=lambda k: k[0])
