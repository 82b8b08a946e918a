"""Plain one-key-at-a-time model of the detectors, fed in arrival order. Test oracle only."""

LATENESS = 5000


def small(e):
    return e["actionType"] == "PAYMENT" and e["amount"] is not None and e["amount"] < 100


def suspicious(e):
    if e["actionType"] == "PAYMENT_FRAUD":
        return True
    return e["actionType"] == "PAYMENT" and e["amount"] is not None and e["amount"] >= 1000


LOGIN = ("LOGIN", "LOGIN_SUCCESS")
SENSITIVE = ("CHANGE_PASSWORD", "BIND_PHONE", "WITHDRAW", "LARGE_TRANSFER")


def find_count(buf, w, n):
    for right in range(len(buf)):
        left = right
        while left > 0 and buf[right]["timestamp"] - buf[left - 1]["timestamp"] <= w:
            left -= 1
        if right - left + 1 >= n:
            return buf[left : right + 1]
    return None


def find_pair(buf, w, n):
    login = None
    for e in buf:
        if e["actionType"] in LOGIN:
            login = e
        elif e["actionType"] in SENSITIVE and login is not None and 0 <= e["timestamp"] - login["timestamp"] <= w:
            return [login, e]
    return None


def find_pay(buf, w, n):
    for i, c in enumerate(buf):
        if not suspicious(c):
            continue
        near = [e for e in buf[:i] if 0 <= c["timestamp"] - e["timestamp"] <= w]
        smalls = [e for e in near if small(e)]
        if len(smalls) < n or not c["ip"]:
            continue
        best = None
        for e in near:
            if e["actionType"] in LOGIN and e["ip"] and e["ip"].lower() != c["ip"].lower():
                if best is None or e["timestamp"] > best["timestamp"]:
                    best = e
        if best is not None:
            return [best, *smalls, c]
    return None


FIND = {"count": find_count, "pair": find_pair, "pay": find_pay}


def run(events, detector, w, n):
    """Matches (lists of events sorted by time) of one key's events in the given order."""
    buf, newest, emitted, out = [], None, None, []
    for e in events:
        buf.append(e)
        newest = e["timestamp"] if newest is None else max(newest, e["timestamp"])
        floor = max(0, newest - w - LATENESS)
        buf = sorted([x for x in buf if x["timestamp"] >= floor], key=lambda x: x["timestamp"])
        found = FIND[detector](buf, w, n)
        if found is not None and (emitted is None or found[-1]["timestamp"] > emitted):
            out.append(sorted(found, key=lambda x: x["timestamp"]))
            emitted = found[-1]["timestamp"]
            buf, newest = [], None
    return out
