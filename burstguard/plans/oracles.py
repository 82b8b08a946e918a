"""The registered queries in SQL, written independently of the Spark plans, for comparison."""

HOUR = 3_600_000

EV = """
ev AS (
  SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS userId,
    CASE WHEN event_type = 'error' THEN 'LOGIN_FAIL' WHEN event_type = 'signup' THEN 'LOGIN'
         WHEN event_type = 'purchase' THEN 'PAYMENT' WHEN event_type = 'view' THEN 'VIEW'
         WHEN event_type = 'click' AND k % 4 = 0 THEN 'CHANGE_PASSWORD' WHEN event_type = 'click' THEN 'ADD_CART'
    END AS actionType,
    '10.0.0.' || (k % 20) AS ip, epoch_us(ts) // 1000 AS t, user_id || ':' || strftime(ts, '%Y-%m-%d') AS sessionId,
    CASE WHEN k % 10 <> 0 THEN 'd' || (k % 7) END AS deviceId, value * 10 AS amount
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
)"""

# Fixture rules: id, type, watched actions, key, window in hours, threshold, weight, gate.
RULES = {
    "fx-stuffing": ("CREDENTIAL_STUFFING", "'LOGIN_FAIL'", "ip", 24, 3, 2.0),
    "fx-order": ("ORDER_BRUSH", "'PAYMENT'", "userId", 72, 3, 1.8),
    "fx-view": ("HIGH_FREQ_ACCESS", "'VIEW'", "sessionId", 24, 2, 1.3),
    "fx-login": ("ABNORMAL_LOGIN", "'LOGIN','CHANGE_PASSWORD'", "userId", 24, 2, 1.6),
    "fx-pay": ("PAYMENT_FRAUD", "'LOGIN','PAYMENT'", "userId", 120, 2, 2.5),
}


def rule_table() -> str:
    rows = ", ".join(
        f"('{r}', '{kind}', {h * HOUR}::BIGINT, {n}, {w}::DOUBLE)" for r, (kind, _, _, h, n, w) in RULES.items()
    )
    return f"rule(ruleId, ruleType, w, n, weight) AS (VALUES {rows})"


def matched_rows() -> str:
    parts = [
        f"SELECT '{r}' AS ruleId, '{r}:' || coalesce({key}, 'UNKNOWN') AS gk, * FROM ev WHERE actionType IN ({acts})"
        for r, (_, acts, key, _, _, _) in RULES.items()
    ]
    return f"""
m AS (
  SELECT *, row_number() OVER (PARTITION BY gk ORDER BY t, seq) AS rn,
    CASE WHEN actionType = 'PAYMENT' AND amount < 100 THEN 'small' WHEN actionType = 'PAYMENT' AND amount >= 1000
         THEN 'large' WHEN actionType = 'LOGIN' THEN 'login' ELSE 'other' END AS role
  FROM ({' UNION ALL '.join(parts)})
)"""


# Candidate matches as (key, start, end) row numbers. Everything else follows from them.
CANDIDATES = """
cand AS (
  SELECT gk, rn - n + 1 AS s, rn AS e FROM (
    SELECT m.*, rule.n, rule.w,
      CASE n WHEN 2 THEN lag(t, 1) OVER x WHEN 3 THEN lag(t, 2) OVER x END AS t0
    FROM m JOIN rule USING (ruleId) WHERE ruleId IN ('fx-stuffing', 'fx-order', 'fx-view')
    WINDOW x AS (PARTITION BY gk ORDER BY t, seq))
  WHERE t - t0 <= w
  UNION ALL
  SELECT gk, s, e FROM (
    SELECT m.gk, m.t, w, actionType, rn AS e,
      max(CASE WHEN actionType = 'LOGIN' THEN rn END) OVER x AS s,
      max(CASE WHEN actionType = 'LOGIN' THEN t END) OVER x AS st
    FROM m JOIN rule USING (ruleId) WHERE ruleId = 'fx-login' WINDOW x AS (PARTITION BY gk ORDER BY t, seq))
  WHERE actionType = 'CHANGE_PASSWORD' AND t - st <= w
  UNION ALL
  SELECT gk, least(small, login) AS s, e FROM (
    SELECT l.gk, l.rn AS e,
      (SELECT list(p.rn ORDER BY p.rn DESC)[2] FROM m p WHERE p.gk = l.gk AND p.role = 'small' AND p.rn < l.rn
         AND l.t - p.t <= 432000000) AS small,
      (SELECT max(p.rn) FROM m p WHERE p.gk = l.gk AND p.role = 'login' AND p.rn < l.rn AND p.ip <> l.ip
         AND l.t - p.t <= 432000000) AS login
    FROM m l WHERE l.ruleId = 'fx-pay' AND l.role = 'large')
  WHERE small IS NOT NULL AND login IS NOT NULL
)"""


def greedy(candidates: str = "cand") -> str:
    """Earliest end first, each match starting after the one before it; ``p`` is where the buffer begins."""
    return f"""
nxt AS (
  SELECT c.gk, c.e, min(d.e) AS ne FROM (SELECT DISTINCT gk, e FROM {candidates}) c
  JOIN {candidates} d ON d.gk = c.gk AND d.s > c.e GROUP BY c.gk, c.e
),
pick AS (
  SELECT gk, min(e) AS e, 1::BIGINT AS p FROM {candidates} GROUP BY gk
  UNION ALL
  SELECT pick.gk, nxt.ne, pick.e + 1 FROM pick JOIN nxt ON nxt.gk = pick.gk AND nxt.e = pick.e
)"""


# The matched rows of every pick.
MATCHED = """
hit AS (
  SELECT k.gk, k.e, x.rn FROM pick k JOIN m z ON z.gk = k.gk AND z.rn = k.e JOIN rule ON rule.ruleId = z.ruleId
  JOIN m x ON x.gk = k.gk AND x.rn BETWEEN k.p AND k.e
  WHERE CASE
    WHEN z.ruleId IN ('fx-stuffing', 'fx-order', 'fx-view') THEN x.rn > k.e - n
    WHEN z.ruleId = 'fx-login' THEN x.rn = k.e OR x.rn = (SELECT max(s) FROM cand c WHERE c.gk = k.gk AND c.e = k.e)
    ELSE x.rn = k.e OR (x.role = 'small' AND z.t - x.t <= w) OR x.rn = (
      SELECT max(l.rn) FROM m l WHERE l.gk = k.gk AND l.role = 'login' AND l.ip <> z.ip AND l.rn BETWEEN k.p AND k.e)
  END
),
al AS (
  SELECT hit.gk AS groupKey, z.ruleId, ruleType,
    CASE WHEN cnt >= 3 * n THEN 'CRITICAL' WHEN cnt >= 2 * n THEN 'HIGH' WHEN cnt >= n THEN 'MEDIUM' ELSE 'LOW' END
      AS level,
    f.userId, f.ip, f.deviceId, cnt::INTEGER AS matchCount,
    weight * (1.0::DOUBLE + cnt / n::DOUBLE + least(1.5::DOUBLE, (cnt / greatest(1.0::DOUBLE, w / 1000.0::DOUBLE)) / 10.0::DOUBLE))
      AS score,
    f.t AS firstEventTimestamp, z.t AS lastEventTimestamp, z.seq AS lastSeq, n
  FROM (SELECT gk, e, min(rn) AS s, count(*) AS cnt FROM hit GROUP BY gk, e) hit
  JOIN m f ON f.gk = hit.gk AND f.rn = hit.s JOIN m z ON z.gk = hit.gk AND z.rn = hit.e JOIN rule ON rule.ruleId = z.ruleId
)"""

ALERTS = f"WITH RECURSIVE {EV}, {rule_table()}, {matched_rows()}, {CANDIDATES}, {greedy()}, {MATCHED}"

ALERT_COLUMNS = (
    "groupKey, ruleId, ruleType, level, userId, ip, deviceId, matchCount, round(score, 6) AS riskScore, "
    "firstEventTimestamp, lastEventTimestamp"
)


def alerts_of(rule: str) -> str:
    return f"{ALERTS} SELECT {ALERT_COLUMNS} FROM al WHERE ruleId = '{rule}'"


def count_cand(action: str, key: str, n: int, hours: int) -> str:
    return f"""WITH {EV} SELECT seq, {key}, t0 AS "firstTimestamp", t AS "timestamp" FROM (
      SELECT *, lag(t, {n - 1}) OVER (PARTITION BY {key} ORDER BY t, seq) AS t0 FROM ev WHERE actionType = '{action}')
    WHERE t - t0 <= {hours * HOUR}"""


# --- documents ------------------------------------------------------------------------------

DOCS = """
doc AS (
  SELECT event_id AS seq, event_id AS e, epoch_us(ts) // 1000 AS ms, value, user_id, event_type,
    event_id % 61 = 0 AS cut, event_id % 53 = 0 AS words, event_id % 50 = 0 AS nouser
  FROM events
),
dec AS (
  SELECT *,
    CASE WHEN nouser THEN NULL ELSE CAST(user_id AS VARCHAR) END AS userId,
    CASE event_type WHEN 'click' THEN 'ADD_CART' WHEN 'signup' THEN 'REMOVE_CART' ELSE upper(event_type) END
      AS actionType,
    CASE WHEN e % 4 = 3 THEN (ms // 1000) * 1000 ELSE ms END AS t
  FROM doc
)"""

# The text of a document that is cut at 40 characters or holds a wordy amount, as far as it is kept.
REJECT_TEXT = """
CASE WHEN event_type = 'click' THEN ' add_to_cart ' WHEN event_type = 'signup' THEN 'Remove_From_Cart' ELSE event_type END
"""
DOC_TEXT = f"""
'{{"user_id":' || CASE WHEN nouser THEN 'null' ELSE CAST(user_id AS VARCHAR) END || ',"event_type":"' || {REJECT_TEXT}
|| '",' || CASE e % 4
  WHEN 0 THEN '"timestamp":' || ms
  WHEN 1 THEN '"event_time":"' || strftime(make_timestamp(ms * 1000), '%Y-%m-%d %H:%M:%S.%g') || '"'
  WHEN 2 THEN '"event_time":"' || strftime(make_timestamp(ms * 1000), '%Y-%m-%dT%H:%M:%S.%g') || 'Z"'
  ELSE '"TransactionDT":' || (ms // 1000 - 1512086400) END
|| ',"ip_address":"10.0.0.' || (e % 20) || '","user_session":"s' || (e % 7) || '","amount":'
|| CASE WHEN words THEN '"much"' ELSE '"' || value || '"' END || ',"unknown":[1,{{"a":2}}]}}'
"""

TIME_TEXTS = """
src AS (SELECT *, o_orderkey % 8 AS f, epoch_ms(CAST(o_orderdate AS TIMESTAMP)) // 1000 AS s FROM orders)
"""

RULE_LOG = """
log AS (
  SELECT s_suppkey * 100 AS seq, 'n' || s_nationkey AS ruleId, s_nationkey AS nk,
    CASE WHEN s_suppkey % 4 = 0 THEN 'DISABLED' ELSE 'ENABLED' END AS status,
    CASE s_nationkey % 3 WHEN 0 THEN 'PAYMENT' WHEN 1 THEN 'VIEW' ELSE 'ADD_CART' END AS act,
    s_suppkey % 3 + 1 AS threshold, s_suppkey % 5 AS version
  FROM supplier
),
step AS (SELECT *, sum(CASE WHEN status = 'DISABLED' THEN 1 ELSE 0 END) OVER (PARTITION BY ruleId ORDER BY seq) AS ep FROM log),
acc AS (
  SELECT * FROM (SELECT *, max(CASE WHEN status <> 'DISABLED' THEN version END) OVER
      (PARTITION BY ruleId, ep ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM step)
  WHERE status = 'DISABLED' OR best IS NULL OR version > best
),
hist AS (SELECT * FROM (SELECT *, lead(seq) OVER (PARTITION BY ruleId ORDER BY seq) AS til FROM acc) WHERE status <> 'DISABLED')
"""

CHANGES = """
chg AS (
  SELECT o_orderkey AS seq, 'r' || o_custkey AS ruleId,
    CASE WHEN o_custkey % 3 = 0 THEN 'ORDER_BRUSH' ELSE 'HIGH_FREQ_ACCESS' END AS ruleType,
    CASE WHEN o_orderkey % 5 = 0 THEN 'DISABLED' WHEN o_orderkey % 11 <> 0 THEN 'ENABLED' END AS status,
    CASE WHEN o_orderpriority <> '5-LOW' THEN 'PAYMENT' END AS targetActionType,
    (o_orderkey % 9) * 60000 AS windowSizeMs, (o_orderkey % 4 + 1)::INTEGER AS threshold,
    CASE WHEN o_orderstatus = 'F' THEN 'BY_USER_ID' ELSE 'BY_IP' END AS groupKeyType, o_orderkey % 7 AS version
  FROM orders
),
snap AS (
  SELECT * FROM (
    SELECT c.*, row_number() OVER (PARTITION BY c.ruleId ORDER BY version DESC, c.seq) AS place FROM chg c
    LEFT JOIN (SELECT ruleId, max(seq) AS off FROM chg WHERE status = 'DISABLED' GROUP BY ruleId) d ON d.ruleId = c.ruleId
    WHERE (status IS NULL OR status <> 'DISABLED') AND targetActionType IS NOT NULL AND windowSizeMs > 0
      AND (off IS NULL OR c.seq > off)
  ) WHERE place = 1
)
"""
RULE_FIELDS = "ruleId, ruleType, status, targetActionType, windowSizeMs, threshold, groupKeyType, version"

STAMPED = f"{ALERTS}, st AS (SELECT *, lastEventTimestamp % 400000 AS lag FROM al)"

LABELS = """
lab(rule_type, rule_label) AS (VALUES ('ABNORMAL_LOGIN', 'Abnormal Login'), ('ORDER_BRUSH', 'Order Brush'),
  ('HIGH_FREQ_ACCESS', 'High Frequency Access')),
"""


def quality(source: str) -> str:
    return f"""{LABELS}
ex AS (SELECT rule_type, userId AS usr FROM lab, (SELECT DISTINCT userId FROM ev WHERE CAST(userId AS BIGINT) % 2 = 1)),
de AS (SELECT DISTINCT ruleType AS rule_type, userId AS usr FROM {source}),
cnt AS (
  SELECT lab.rule_type, rule_label,
    (SELECT count(*) FROM ex WHERE ex.rule_type = lab.rule_type) AS expected_users,
    (SELECT count(*) FROM de WHERE de.rule_type = lab.rule_type) AS detected_users,
    (SELECT count(*) FROM ex JOIN de USING (rule_type, usr) WHERE ex.rule_type = lab.rule_type) AS tp_users
  FROM lab
),
q AS (
  SELECT *, detected_users - tp_users AS fp_users, expected_users - tp_users AS fn_users,
    CASE WHEN detected_users > 0 THEN tp_users / detected_users::DOUBLE ELSE 0 END AS p,
    CASE WHEN expected_users > 0 THEN tp_users / expected_users::DOUBLE ELSE 0 END AS r FROM cnt
),
qf AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM q),
tot AS (
  SELECT sum(expected_users)::BIGINT AS expected_positive_users, sum(detected_users)::BIGINT AS detected_users,
    sum(tp_users)::BIGINT AS tp_users, sum(fp_users)::BIGINT AS fp_users, sum(fn_users)::BIGINT AS fn_users,
    sum(tp_users) / sum(detected_users)::DOUBLE AS p, sum(tp_users) / sum(expected_users)::DOUBLE AS r,
    round(avg(p), 6) AS macro_precision, round(avg(r), 6) AS macro_recall, round(avg(f), 6) AS macro_f1
  FROM qf
)"""


QUALITY_SUMMARY = """expected_positive_users, detected_users, tp_users, fp_users, fn_users, round(p, 6) AS "precision",
  round(r, 6) AS recall, round(2 * p * r / (p + r), 6) AS f1, macro_precision, macro_recall, macro_f1"""

LATENCY = """
  round(avg(lag::DOUBLE), 3) AS avg_latency_ms,
  quantile_disc(lag, 0.99)::DOUBLE AS p99_latency_ms"""


FEATURE_WRITES = """
  SELECT lastSeq AS seq, lastEventTimestamp AS wt, ruleType, userId, CASE WHEN lastSeq % 5 <> 0 THEN ip END AS fip,
    CASE WHEN lastSeq % 3 = 0 THEN 'x' || lastSeq END AS extra FROM al"""
DOCUMENT_WRITES = """
  SELECT lastEventTimestamp AS seq, lastEventTimestamp + lastEventTimestamp % 400000 AS wt, ruleType, userId, ip AS fip,
    NULL::VARCHAR AS extra FROM al"""


def feature(scope: str, writes: str = FEATURE_WRITES) -> str:
    key = {"userId": "userId", "ip": "fip"}[scope]
    return f"""{ALERTS},
w AS ({writes}),
g AS (
  SELECT *, {key} AS k, CASE WHEN wt - lag(wt) OVER x < {6 * HOUR} THEN 0 ELSE 1 END AS fresh FROM w
  WHERE {key} IS NOT NULL WINDOW x AS (PARTITION BY {key} ORDER BY wt, seq, ruleType)
),
l AS (SELECT *, sum(fresh) OVER (PARTITION BY k ORDER BY wt, seq, ruleType) AS life FROM g),
z AS (SELECT * FROM l WHERE (k, life) IN (SELECT k, max(life) FROM l GROUP BY k))
SELECT k AS "featureKey", max(wt) AS "writtenAt", max_by(ruleType, (wt, seq, ruleType)) AS "ruleType",
  max_by(fip, (wt, seq, fip)) FILTER (fip IS NOT NULL) AS ip,
  max_by(extra, (wt, seq, extra)) FILTER (extra IS NOT NULL) AS extra FROM z GROUP BY k"""


CASES = f"""{ALERTS}, cs AS (
  SELECT ['p', 'w', 'b', 's'][un % 4 + 1] || (un % 40) AS "case", count(*) AS alerts, sum(matchCount) AS raw, min(un) AS low,
    max(lastEventTimestamp - firstEventTimestamp) AS win, avg(matchCount) * 40000 AS lat
  FROM (SELECT *, CAST(userId AS BIGINT) AS un FROM al) GROUP BY 1)"""


def count_machine(rows: str) -> str:
    """Count rules in order of arrival, one event of a key after the other: ``rows`` has gk, ruleId, ruleType, w, n,
    weight, arrival and the event's columns. The buffer is sorted by time; what is older than window and lateness behind
    the newest event falls out; the earliest full window that ends later than the last match is taken, and the buffer
    emptied."""
    return f"""
ord AS (SELECT *, row_number() OVER (PARTITION BY gk ORDER BY arrival) AS rn FROM ({rows})),
run(gk, rn, buf, emitted, hit, whole) AS (
  SELECT DISTINCT gk, 0::BIGINT, []::STRUCT(t BIGINT, a BIGINT)[], -1::BIGINT, NULL::BIGINT, []::STRUCT(t BIGINT, a BIGINT)[]
  FROM ord
  UNION ALL
  SELECT gk, rn, CASE WHEN found THEN [] ELSE b END, CASE WHEN found THEN b[pos].t ELSE emitted END,
    CASE WHEN found THEN pos END, b
  FROM (
    SELECT *, pos IS NOT NULL AND b[pos].t > emitted AS found FROM (
      SELECT *, list_min(list_filter(range(n, len(b) + 1), lambda i: b[i].t - b[i - n + 1].t <= w)) AS pos FROM (
        SELECT gk, rn, emitted, n, w, list_filter(grown, lambda x: x.t >= list_max(list_transform(grown, lambda y: y.t)) - w - 5000) AS b
        FROM (
          SELECT o.gk, o.rn, r.emitted, o.n, o.w,
            list_sort(list_append(r.buf, {{'t': o.t, 'a': o.arrival}})) AS grown
          FROM run r JOIN ord o ON o.gk = r.gk AND o.rn = r.rn + 1))))
),
got AS (
  SELECT o.gk, o.ruleId, o.ruleType, o.n, o.w, o.weight, f.userId, f.ip, f.deviceId, f.t AS t0, whole[hit].t AS t1
  FROM run JOIN ord o USING (gk, rn) JOIN ord f ON f.gk = run.gk AND f.arrival = whole[hit - o.n + 1].a WHERE hit IS NOT NULL
)
SELECT gk AS "groupKey", ruleId, ruleType, 'MEDIUM' AS level, userId, ip, deviceId, n::INTEGER AS "matchCount",
  round(weight * (2.0::DOUBLE + least(1.5::DOUBLE, n / greatest(1.0::DOUBLE, w / 1000.0::DOUBLE) / 10.0::DOUBLE)), 6) AS "riskScore",
  t0 AS "firstEventTimestamp", t1 AS "lastEventTimestamp" FROM got"""


def arrival_machine(rows: str) -> str:
    """All detectors in order of arrival, one event of a key after the other: ``rows`` has gk, ruleId, ruleType, kind, w, n,
    weight, arrival, part and the event's columns. As ``count_machine``, with the first match by its end: ``pos`` is that
    end in the sorted buffer ``b``, ``hits`` the positions of its rows."""
    near = "b[i].t - b[j].t <= w"
    smalls = f"list_filter(range(1, i), lambda j: b[j].part = 'small' AND {near})"
    logins = f"list_filter(range(1, i), lambda j: b[j].part = 'login' AND b[j].ip <> b[i].ip AND {near})"
    first = "list_max(list_filter(range(1, i), lambda j: b[j].part = 'first'))"
    ends = f"""CASE kind
      WHEN 'count' THEN i >= n AND b[i].t - b[i - n + 1].t <= w
      WHEN 'pair' THEN b[i].part = 'second' AND coalesce(b[i].t - b[{first}].t <= w, false)
      ELSE b[i].part = 'large' AND len({smalls}) >= n AND len({logins}) > 0 END"""
    pay = [x.replace("(1, i)", "(1, pos)").replace("b[i]", "b[pos]") for x in (smalls, logins, first)]
    login = f"list_min(list_transform({pay[1]}, lambda j: {{'t': -b[j].t, 'j': j}})).j"
    hits = f"""CASE kind WHEN 'count' THEN range(pos - n + 1, pos + 1) WHEN 'pair' THEN [{pay[2]}, pos]
      ELSE list_concat([{login}], list_concat({pay[0]}, [pos])) END"""
    event = "STRUCT(t BIGINT, a BIGINT, part VARCHAR, ip VARCHAR)[]"
    return f"""
ord AS (SELECT *, row_number() OVER (PARTITION BY gk ORDER BY arrival) AS rn FROM ({rows})),
run(gk, rn, buf, emitted, hit, whole) AS (
  SELECT DISTINCT gk, 0::BIGINT, []::{event}, -1::BIGINT, NULL::BIGINT[], []::{event} FROM ord
  UNION ALL
  SELECT gk, rn, CASE WHEN found THEN [] ELSE b END, CASE WHEN found THEN b[pos].t ELSE emitted END,
    CASE WHEN found THEN {hits} END, b
  FROM (
    SELECT *, pos IS NOT NULL AND b[pos].t > emitted AS found FROM (
      SELECT *, list_min(list_filter(range(1, len(b) + 1), lambda i: {ends})) AS pos FROM (
        SELECT gk, rn, emitted, n, w, kind, list_filter(grown, lambda x: x.t >= list_max(list_transform(grown, lambda y: y.t)) - w - 5000) AS b
        FROM (
          SELECT o.gk, o.rn, r.emitted, o.n, o.w, o.kind,
            list_sort(list_append(r.buf, {{'t': o.t, 'a': o.arrival, 'part': o.part, 'ip': o.ip}})) AS grown
          FROM run r JOIN ord o ON o.gk = r.gk AND o.rn = r.rn + 1))))
),
taken AS (
  SELECT gk, rn, len(hit) AS cnt, whole[list_max(hit)].t AS t1,
    list_min(list_transform(hit, lambda j: {{'t': whole[j].t, 'late': whole[j].part <> 'login', 'a': whole[j].a}})) AS f
  FROM run WHERE hit IS NOT NULL
)
SELECT k.gk AS "groupKey", o.ruleId, o.ruleType,
  CASE WHEN cnt >= 3 * o.n THEN 'CRITICAL' WHEN cnt >= 2 * o.n THEN 'HIGH' WHEN cnt >= o.n THEN 'MEDIUM' ELSE 'LOW' END AS level,
  f.userId, f.ip, f.deviceId, cnt::INTEGER AS "matchCount",
  round(o.weight * (1.0::DOUBLE + cnt / o.n::DOUBLE + least(1.5::DOUBLE, cnt / greatest(1.0::DOUBLE, o.w / 1000.0::DOUBLE) / 10.0::DOUBLE)), 6) AS "riskScore",
  f.t AS "firstEventTimestamp", t1 AS "lastEventTimestamp"
FROM taken k JOIN ord o USING (gk, rn) JOIN ord f ON f.gk = k.gk AND f.arrival = k.f.a"""


def pattern(name_key: str, where: str, cand: str, count: str, first: str) -> str:
    """A pattern as rows ``m``, candidates ``cand`` and greedy picks."""
    return f"""WITH RECURSIVE {EV},
m AS (SELECT *, {name_key} AS gk, row_number() OVER (PARTITION BY {name_key} ORDER BY t, seq) AS rn FROM ev WHERE {where}),
cand AS ({cand}), {greedy()}
SELECT k.gk AS "groupKey", ({count})::INTEGER AS "matchCount", f.t AS "firstEventTimestamp", z.t AS "lastEventTimestamp"
FROM pick k JOIN m z ON z.gk = k.gk AND z.rn = k.e JOIN m f ON f.gk = k.gk AND f.rn = ({first})"""


def times_pattern(key: str, action: str, n: int, hours: int) -> str:
    cand = f"""SELECT gk, rn - {n - 1} AS s, rn AS e FROM (
      SELECT *, lag(t, {n - 1}) OVER (PARTITION BY gk ORDER BY t, seq) AS t0 FROM m) WHERE t - t0 <= {hours * HOUR}"""
    return pattern(key, f"actionType = '{action}'", cand, str(n), f"k.e - {n - 1}")


PAIR_CAND = f"""SELECT gk, s, rn AS e FROM (
  SELECT *, max(CASE WHEN actionType = 'LOGIN' THEN rn END) OVER x AS s,
    max(CASE WHEN actionType = 'LOGIN' THEN t END) OVER x AS st
  FROM m WINDOW x AS (PARTITION BY gk ORDER BY t, seq))
WHERE actionType = 'CHANGE_PASSWORD' AND t - st <= {48 * HOUR}"""

CHAIN_CAND = f"""SELECT y.gk, login AS s, e FROM (
  SELECT gk, e, t, (SELECT max(x.rn) FROM m x WHERE x.gk = l.gk AND x.actionType = 'LOGIN' AND x.rn < third) AS login
  FROM (SELECT b.gk, b.rn AS e, b.t, (SELECT list(x.rn ORDER BY x.rn DESC)[3] FROM m x
          WHERE x.gk = b.gk AND x.actionType = 'PAYMENT' AND x.amount < 100 AND x.rn < b.rn) AS third
        FROM m b WHERE b.actionType = 'PAYMENT' AND b.amount >= 1000) l)
y JOIN m x ON x.gk = y.gk WHERE x.rn = login AND y.t - x.t <= {240 * HOUR}"""

CHAIN_COUNT = """2 + (SELECT count(*) FROM m x WHERE x.gk = k.gk AND x.actionType = 'PAYMENT' AND x.amount < 100
  AND x.rn > (SELECT max(c.s) FROM cand c WHERE c.gk = k.gk AND c.e = k.e) AND x.rn < k.e)"""

PICK_START = "SELECT max(c.s) FROM cand c WHERE c.gk = k.gk AND c.e = k.e"


# --- CSV layouts ----------------------------------------------------------------------------

CSV = """
c AS (SELECT *, o_orderkey AS k, epoch_ms(CAST(o_orderdate AS TIMESTAMP)) AS ms,
  CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS usr,
  CASE WHEN o_orderkey % 11 <> 0 THEN 's' || (o_custkey % 100) END AS sess FROM orders)
"""
NOW = "1800000000000"

ORACLES = {
    "behavior_normalized": f"""WITH {DOCS} SELECT seq, userId, actionType, '10.0.0.' || (e % 20) AS ip,
      t AS "timestamp", 's' || (e % 7) AS sessionId, value AS amount FROM dec WHERE NOT cut AND NOT words AND NOT nouser""",
    "behavior_rejects": f"""WITH {DOCS}, txt AS (SELECT seq, cut, words, {DOC_TEXT} AS x FROM dec)
      SELECT seq, CASE WHEN cut THEN substr(x, 1, 40) ELSE x END AS rejected FROM txt WHERE cut OR words""",
    "behavior_invalid_counts": f"""WITH {DOCS} SELECT count(*) AS total, count(*) FILTER (cut OR words) AS rejected,
      count(*) FILTER (NOT cut AND NOT words AND nouser) AS invalid,
      count(*) FILTER (NOT cut AND NOT words AND NOT nouser) AS converted FROM dec""",
    "flex_event_time": f"""WITH {TIME_TEXTS} SELECT o_orderkey,
      CASE f WHEN 0 THEN s * 1000 WHEN 1 THEN s * 1000 + 250 WHEN 5 THEN s * 1000 + 125
        WHEN 2 THEN CASE WHEN s > 0 THEN s * 1000 END
        WHEN 3 THEN CASE WHEN s * 1000 >= 10000000000 THEN s * 1000 WHEN s > 0 THEN s * 1000000 END END AS flex_ms,
      coalesce(CASE f WHEN 0 THEN s * 1000 WHEN 1 THEN s * 1000 + 250 WHEN 4 THEN s * 1000 WHEN 5 THEN s * 1000 + 125
        WHEN 2 THEN CASE WHEN s > 0 THEN s * 1000 END
        WHEN 3 THEN CASE WHEN s * 1000 >= 10000000000 THEN s * 1000 WHEN s > 0 THEN s * 1000000 END END, -1) AS csv_ms,
      CASE WHEN o_custkey > 5 THEN 1512086400000 + (o_custkey - 5) * 1000 END AS transaction_ms FROM src""",
    "rule_decoded": """SELECT o_orderkey AS seq, 'r' || o_custkey AS ruleId,
      CASE WHEN o_orderkey % 6 <> 0 THEN 'ORDER_BRUSH' END AS ruleType,
      CASE o_orderkey % 4 WHEN 0 THEN 'ENABLED' WHEN 3 THEN 'DISABLED' END AS status, 'ORDER' AS targetActionType,
      (o_orderkey % 9) * 1000 AS windowSizeMs, (o_orderkey % 5)::INTEGER AS threshold, 'BY_USER_ID' AS groupKeyType,
      o_orderkey AS version, CASE o_orderkey % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 0.0 ELSE 2.5 END::DOUBLE AS severityWeight,
      100 AS priority FROM orders WHERE o_orderkey % 13 <> 0 AND o_orderkey % 10 <> 9""",
    "rule_snapshot": f"WITH {CHANGES} SELECT {RULE_FIELDS}, seq FROM snap",
    "rule_history": f"""WITH {CHANGES},
      step AS (SELECT *, sum(CASE WHEN status = 'DISABLED' THEN 1 ELSE 0 END) OVER (PARTITION BY ruleId ORDER BY seq) AS ep
        FROM chg WHERE status = 'DISABLED' OR (targetActionType IS NOT NULL AND windowSizeMs > 0)),
      acc AS (SELECT * FROM (SELECT *, max(CASE WHEN status = 'DISABLED' THEN NULL ELSE version END) OVER
          (PARTITION BY ruleId, ep ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM step)
        WHERE status = 'DISABLED' OR best IS NULL OR version > best)
      SELECT ruleId, version, status, seq AS "validFrom", til AS "validTo" FROM (
        SELECT *, lead(seq) OVER (PARTITION BY ruleId ORDER BY seq) AS til FROM acc)
      WHERE status IS NULL OR status <> 'DISABLED'""",
    "rule_lint": f"WITH {CHANGES} SELECT ruleId, ruleType, 'not enabled' AS reason FROM snap WHERE status IS NULL",
    "rule_defaults": f"""WITH {CHANGES}, d AS (SELECT ruleId, seq % 200 AS pr FROM snap)
      SELECT ruleId, CASE WHEN pr % 2 = 0 THEN 'PAYMENT_FRAUD' ELSE 'CUSTOM' END AS ruleType,
        CASE WHEN pr % 2 = 0 THEN 2.5 ELSE round(greatest(1.0, least(2.0, 150.0 / pr)), 6) END::DOUBLE AS severityWeight,
        CASE WHEN pr % 2 = 0 THEN 3.0 ELSE 1.8 END::DOUBLE AS scoreThreshold FROM d""",
    "rule_match": f"""WITH {EV} SELECT seq, ruleId, groupKey FROM (
      SELECT seq, 'fx-stuffing' AS ruleId, 'fx-stuffing:' || ip AS groupKey FROM ev WHERE actionType IN ('LOGIN_FAIL', 'LOGIN')
      UNION ALL SELECT seq, 'fx-order', 'fx-order:' || userId FROM ev WHERE actionType = 'PAYMENT'
      UNION ALL SELECT seq, 'fx-view', 'fx-view:' || sessionId FROM ev WHERE actionType = 'VIEW'
      UNION ALL SELECT seq, 'fx-login', 'fx-login:' || userId FROM ev WHERE actionType IN ('LOGIN', 'CHANGE_PASSWORD')
      UNION ALL SELECT seq, 'fx-pay', 'fx-pay:' || userId FROM ev WHERE actionType IN ('LOGIN', 'PAYMENT'))""",
    "rule_match_asof": f"""WITH {EV}, {RULE_LOG} SELECT ev.seq, ruleId, version, threshold::INTEGER AS threshold,
      ruleId || ':' || CASE WHEN nk % 2 = 0 THEN ip ELSE coalesce(deviceId, 'UNKNOWN') END AS groupKey
      FROM ev JOIN hist ON act = actionType AND ev.seq >= hist.seq AND (til IS NULL OR ev.seq < til)""",
    "group_keys": f"""WITH {EV} SELECT seq, keyType, 'r:' || CASE keyType WHEN 'BY_USER_ID' THEN userId WHEN 'BY_IP' THEN ip
        WHEN 'BY_DEVICE_ID' THEN coalesce(deviceId, 'UNKNOWN') ELSE sessionId END AS "groupKey", userId AS "byUser",
        ip AS "byIp", coalesce(deviceId, 'UNKNOWN') AS "byDevice"
      FROM ev, (VALUES ('BY_USER_ID'), ('BY_IP'), ('BY_DEVICE_ID'), ('BY_SESSION_ID')) v(keyType)""",
    "order_brush_candidates": count_cand("PAYMENT", "userId", 3, 72),
    "high_freq_candidates": count_cand("VIEW", "sessionId", 2, 24),
    "stuffing_candidates": count_cand("LOGIN_FAIL", "ip", 3, 24),
    "login_candidates": f"""WITH {EV} SELECT seq, userId, st AS "firstTimestamp", t AS "timestamp" FROM (
      SELECT *, max(CASE WHEN actionType = 'LOGIN' THEN t END) OVER (PARTITION BY userId ORDER BY t, seq) AS st FROM ev
      WHERE actionType IN ('LOGIN', 'CHANGE_PASSWORD')) WHERE actionType = 'CHANGE_PASSWORD' AND t - st <= {24 * HOUR}""",
    "payment_candidates": f"""WITH {EV}, p AS (SELECT l.seq, l.userId, l.t,
        (SELECT count(*) FROM ev x WHERE x.userId = l.userId AND x.actionType = 'PAYMENT' AND x.amount < 100 AND x.t < l.t
          AND l.t - x.t <= {120 * HOUR}) AS smalls,
        (SELECT max(x.t) FROM ev x WHERE x.userId = l.userId AND x.actionType = 'LOGIN' AND x.ip <> l.ip AND x.t < l.t
          AND l.t - x.t <= {120 * HOUR}) AS login
        FROM ev l WHERE l.actionType = 'PAYMENT' AND l.amount >= 1000)
      SELECT seq, userId, smalls AS "smallPayments", login AS "loginTimestamp", t AS "timestamp" FROM p
      WHERE smalls >= 2 AND login IS NOT NULL""",
    "order_brush_alerts": alerts_of("fx-order"),
    "high_freq_alerts": alerts_of("fx-view"),
    "stuffing_alerts": alerts_of("fx-stuffing"),
    "abnormal_login_alerts": alerts_of("fx-login"),
    "payment_fraud_alerts": alerts_of("fx-pay"),
    "all_alerts": f"{ALERTS} SELECT {ALERT_COLUMNS} FROM al",
    "arrival_alerts": f"{ALERTS} SELECT {ALERT_COLUMNS} FROM al",
    "alert_messages": f"""{ALERTS} SELECT groupKey, lastEventTimestamp, '[' || ruleType || '] 检测到异常行为：用户[' || userId
      || '] IP[' || ip || '] 在时间段[' || strftime(make_timestamp(firstEventTimestamp * 1000), '%Y-%m-%d %H:%M:%S') || ' ~ '
      || strftime(make_timestamp(lastEventTimestamp * 1000), '%Y-%m-%d %H:%M:%S') || ']内触发规则[' || ruleId
      || ']，匹配事件数：' || matchCount || '，阈值：' || n AS message FROM al""",
    "alert_levels": f"{ALERTS} SELECT ruleType, level, count(*) AS cnt FROM al GROUP BY ALL",
    "risk_scores": f"""{ALERTS} SELECT ruleId, matchCount, count(*) AS cnt, round(max(score), 6) AS riskScore FROM al
      GROUP BY ruleId, matchCount""",
    "alert_evidence": f"""{ALERTS}, ord AS (SELECT *, row_number() OVER (PARTITION BY gk, e ORDER BY rn) - 1 AS place FROM hit)
      SELECT ruleId, actionType, count(*) AS cnt, sum(seq)::BIGINT AS "seqSum", sum(place)::BIGINT AS places
      FROM ord JOIN m USING (gk, rn) GROUP BY ruleId, actionType""",
    "alert_trigger_events": f"""{ALERTS}, x AS (SELECT * FROM hit JOIN m USING (gk, rn))
      SELECT ruleId, min_by(userId, rn) AS userId, count(*)::INTEGER AS matchCount, count(*)::INTEGER AS events, min(t) AS firstTs,
        max(t) AS lastTs, round(sum(amount ORDER BY rn), 4) AS amount FROM x GROUP BY ruleId, gk, e""",
    "alert_table": f"""{STAMPED} SELECT ruleId, ruleType, level, userId, ip, coalesce(deviceId, '') AS deviceId, '' AS extra,
      matchCount::BIGINT AS matchCount, round(score, 6) AS riskScore, lastEventTimestamp + lag AS alertTimestampMs,
      lastEventTimestamp AS lastEventTimestampMs, (lastEventTimestamp + lag) // 1000 AS alertSecond,
      strftime(make_timestamp((lastEventTimestamp + lag) * 1000), '%Y%m') AS month FROM st""",
    "alert_keys": f"{ALERTS} SELECT userId AS key, count(*) AS cnt FROM al GROUP BY userId",
    "alerts_per_minute": f"""{ALERTS} SELECT lastEventTimestamp // 60000 * 60 AS bucket, ruleType, count(*) AS cnt,
      round(avg(score), 6) AS avgRiskScore FROM al GROUP BY 1, 2""",
    "alerts_per_hour": f"""{ALERTS} SELECT lastEventTimestamp // 3600000 * 3600 AS bucket, ruleType, count(*) AS cnt,
      round(avg(score), 6) AS avgRiskScore FROM al GROUP BY 1, 2""",
    "type_share": f"""{ALERTS} SELECT ruleType, count(*) AS cnt, round(count(*) / (SELECT count(*) FROM al)::DOUBLE, 6) AS share
      FROM al GROUP BY ruleType""",
    "top_sources": f"{ALERTS} SELECT ip, count(*) AS cnt FROM al GROUP BY ip ORDER BY cnt DESC, ip LIMIT 10",
    "rule_totals": f"""{ALERTS} SELECT ruleId, count(*) AS alertCount, sum(matchCount)::BIGINT AS totalMatchCount FROM al
      GROUP BY ruleId""",
    "feature_by_user": feature("userId"),
    "feature_by_ip": feature("ip"),
    "dedup_alerts": f"""{STAMPED}, r AS (SELECT *, row_number() OVER (PARTITION BY ruleType, userId ORDER BY lag, lastSeq) AS o
        FROM st) SELECT ruleType, userId, lastEventTimestamp, lag AS processingLagMs, lastSeq AS seq FROM r WHERE o = 1""",
    "quality_by_rule": f"""{ALERTS}, {quality("al")} SELECT 'fixture' AS "case", rule_type, rule_label, expected_users,
      detected_users, tp_users, fp_users, fn_users, round(p, 6) AS "precision", round(r, 6) AS recall, round(f, 6) AS f1
      FROM qf""",
    "quality_summary": f"""{ALERTS}, {quality("al")} SELECT {QUALITY_SUMMARY} FROM tot""",
    "latency_p99": f"""{STAMPED} SELECT {LATENCY.replace("lag", "least(lag, 300000)")} FROM st""",
    "scope_split": f"""{ALERTS} SELECT CASE WHEN ruleId = 'fx-view' THEN 'out' ELSE 'in' END AS scope, ruleId, count(*) AS cnt
      FROM al GROUP BY 1, 2""",
    "verification_summary": f"""{ALERTS} SELECT count(*) AS alerts_raw_total,
      count(*) FILTER (ruleId <> 'fx-view') AS alerts_scoped_total, count(*) FILTER (ruleId = 'fx-view') AS unexpected_alerts,
      count(*) FILTER (ruleId = 'fx-view') = 0 AS scope_valid,
      count(DISTINCT userId) FILTER (ruleId <> 'fx-view') AS affected_users,
      string_agg(DISTINCT ruleType, ',' ORDER BY ruleType) FILTER (ruleId <> 'fx-view') AS recognized_types,
      string_agg(DISTINCT ruleId, ',' ORDER BY ruleId) FILTER (ruleId = 'fx-view') AS unexpected_rule_ids FROM al""",
    "alerts_by_type": f"{ALERTS} SELECT ruleType, count(*) AS cnt FROM al GROUP BY ruleType",
    "case_summary": f"""{STAMPED}, sc AS (SELECT * FROM st WHERE ruleId <> 'fx-view'), {quality("sc")}
      SELECT 'w60000' AS "case", 4 AS parallelism, 60000 AS "window", 'heap' AS backend, (SELECT count(*) FROM ev)::INTEGER AS events,
        (SELECT count(*) FROM sc) AS alerts, (SELECT count(*) FROM st) AS alerts_raw_total,
        (SELECT count(*) FROM st WHERE ruleId = 'fx-view') AS unexpected_alerts,
        NOT EXISTS (SELECT 1 FROM st WHERE ruleId = 'fx-view') AS scope_valid, (SELECT round(count(*) / ((max(t) - min(t)) / 1000.0::DOUBLE), 6) FROM ev) AS throughput,
        l.avg_latency_ms, l.p99_latency_ms, 1.0::DOUBLE AS cpu_pct, 2.0::DOUBLE AS mem_mb, {QUALITY_SUMMARY}
      FROM tot, (SELECT {LATENCY.replace("lag", "least(lag, 300000)")} FROM sc) l""",
    "abnormal_users": f"""{ALERTS} SELECT ruleType AS rule_type, count(DISTINCT userId) AS users FROM al GROUP BY ruleType""",
    "detection_rate": f"""{CASES} SELECT "case", alerts, round(raw / (SELECT max(raw) FROM cs)::DOUBLE, 6) AS detection_rate,
      lat >= 0.98 * greatest(120000, 5 * win) AS censored FROM cs""",
    "case_family": f"""{CASES} SELECT "case", win AS "window" FROM cs WHERE "case" LIKE 'w%'""",
    "reference_case": f"""{CASES} SELECT "case", alerts FROM cs
      ORDER BY CASE "case" WHEN 'w60000' THEN 0 WHEN 'p4' THEN 1 ELSE 2 END, low LIMIT 1""",
    "pattern_times_or_more": times_pattern("userId", "LOGIN_FAIL", 2, 96),
    "pattern_times_overlapping": f"""WITH {EV} SELECT userId AS "groupKey", seq, t0 AS "firstTimestamp", t AS "timestamp" FROM (
      SELECT *, lag(t) OVER (PARTITION BY userId ORDER BY t, seq) AS t0 FROM ev WHERE actionType = 'LOGIN_FAIL')
      WHERE t - t0 <= {96 * HOUR}""",
    "pattern_followed_by": pattern(
        "coalesce(deviceId, 'UNKNOWN')", "actionType IN ('LOGIN', 'CHANGE_PASSWORD')", PAIR_CAND, "2", PICK_START
    ),
    "pattern_payment_chain": pattern(
        "'chain:' || userId",
        "actionType = 'LOGIN' OR (actionType = 'PAYMENT' AND (amount < 100 OR amount >= 1000))",
        CHAIN_CAND, CHAIN_COUNT, PICK_START,
    ),
    "pattern_custom": times_pattern("'custom:' || userId", "ADD_CART", 2, 48),
    "csv_multi_category": f"""WITH {CSV} SELECT k AS "row", coalesce(usr, sess, 'unknown-user') AS userId,
      CASE k % 3 WHEN 0 THEN 'REMOVE_CART' WHEN 1 THEN 'PURCHASE' ELSE 'VIEW' END AS actionType, 'unknown-ip' AS ip,
      CASE WHEN k % 13 = 0 THEN -1 ELSE ms END AS "timestamp", sess AS sessionId, 'p' || (k % 50) AS productId,
      CASE WHEN k % 17 <> 0 THEN o_totalprice END AS amount FROM c""",
    "csv_clickstream": f"""WITH {CSV} SELECT k AS "row", coalesce(sess, 'unknown-user') AS userId, 'VIEW' AS actionType,
      CASE WHEN k % 5 = 0 THEN 'unknown-ip' ELSE CAST(o_custkey % 30 AS VARCHAR) END AS ip,
      CASE WHEN k % 19 = 0 THEN {NOW} ELSE ms END AS "timestamp", sess AS sessionId, 'B' || (k % 40) AS productId,
      NULL::DOUBLE AS amount FROM c""",
    "csv_ieee": f"""WITH {CSV} SELECT k AS "row", coalesce(usr, CAST(k AS VARCHAR)) AS userId,
      CASE WHEN k % 29 = 0 THEN 'PAYMENT_FRAUD' ELSE 'PAYMENT' END AS actionType,
      'addr-' || CASE WHEN k % 3 = 0 THEN 'na' ELSE CAST(o_custkey % 300 AS VARCHAR) END || '-'
        || CASE WHEN k % 4 = 0 THEN 'na' ELSE '87' END AS ip,
      CASE WHEN k % 23 = 0 THEN {NOW} ELSE 1512086400000 + k * 60000 END AS "timestamp", CAST(k AS VARCHAR) AS sessionId,
      NULL::VARCHAR AS productId, o_totalprice AS amount FROM c""",
    "csv_generic": f"""WITH {CSV} SELECT k AS "row", coalesce(usr, sess, 'unknown-user') AS userId,
      CASE WHEN k % 2 = 0 THEN 'ADD_CART' ELSE 'ORDER' END AS actionType,
      CASE WHEN k % 5 = 0 THEN 'unknown-ip' ELSE CAST(o_custkey % 30 AS VARCHAR) END AS ip,
      CASE WHEN k % 13 = 0 THEN {NOW} ELSE ms END AS "timestamp", sess AS sessionId, NULL::VARCHAR AS productId,
      o_totalprice AS amount FROM c""",
    "csv_import_counts": """SELECT count(*) AS total, count(*) FILTER (o_orderkey % 13 <> 0) AS converted,
      count(*) FILTER (o_orderkey % 13 = 0) AS invalid FROM orders""",
    "baseline_normalized": f"""WITH {DOCS} SELECT seq, coalesce(userId, 'unknown-user') AS userId,
      CASE event_type WHEN 'click' THEN ' ADD_TO_CART ' WHEN 'signup' THEN 'REMOVE_FROM_CART' ELSE upper(event_type) END
        AS actionType,
      '10.0.0.' || (e % 20) AS ip, CASE WHEN e % 4 = 0 THEN ms ELSE {NOW} END AS "timestamp", 's' || (e % 7) AS sessionId,
      CASE WHEN NOT words THEN value END AS amount FROM dec WHERE NOT cut""",
    "keyed_events": f"WITH {EV} SELECT sessionId AS key, count(*) AS cnt FROM ev GROUP BY sessionId",
    "first_events": f'WITH {EV} SELECT seq, t AS "timestamp" FROM ev ORDER BY t, seq LIMIT 100',
    "merged_events": f"""WITH {EV} SELECT seq, actionType, t AS "timestamp",
      CASE WHEN actionType = 'PAYMENT' THEN amount END AS amount FROM ev WHERE actionType IN ('LOGIN', 'LOGIN_FAIL', 'PAYMENT')""",
    "templates_matched": f"""WITH {EV} SELECT seq, ruleId, ruleId || ':' || CASE k WHEN 'ip' THEN ip WHEN 's' THEN sessionId
        ELSE userId END AS "groupKey", threshold, "severityWeight" FROM ev JOIN (VALUES
        ('mc-login-fail-burst', 'LOGIN_FAIL', 'ip', 3, 2.0::DOUBLE), ('mc-login-fail-burst', 'LOGIN', 'ip', 3, 2.0),
        ('mc-cart-bot-session', 'ADD_CART', 's', 20, 2.0), ('cs-page-view-burst', 'VIEW', 's', 50, 2.0),
        ('cs-cart-burst', 'ADD_CART', 'u', 15, 2.0), ('ieee-payment-fraud', 'PAYMENT', 'u', 3, 2.5),
        ('ieee-payment-fraud', 'LOGIN', 'u', 3, 2.5), ('ieee-payment-burst', 'PAYMENT', 'u', 10, 2.0),
        ('ieee-card-probe', 'LOGIN_FAIL', 'ip', 8, 2.0), ('ieee-card-probe', 'LOGIN', 'ip', 8, 2.0)
      ) r(ruleId, act, k, threshold, "severityWeight") ON act = actionType""",
    "scoped_rule_match": f"""WITH {EV}, r(ruleId, act, k) AS (VALUES ('fx-stuffing', 'LOGIN_FAIL', 'ip'), ('fx-stuffing', 'LOGIN', 'ip'),
        ('fx-order', 'PAYMENT', 'u'), ('fx-view', 'VIEW', 's'), ('fx-login', 'LOGIN', 'u'), ('fx-login', 'CHANGE_PASSWORD', 'u'),
        ('fx-pay', 'LOGIN', 'u'), ('fx-pay', 'PAYMENT', 'u'))
      SELECT ruleId || '-run7' AS ruleId, 1::BIGINT AS version, count(*) AS cnt,
        count(DISTINCT CASE k WHEN 'ip' THEN ip WHEN 's' THEN sessionId ELSE userId END) AS keys
      FROM ev JOIN r ON act = actionType GROUP BY ruleId""",
    "experiment_rule_match": f"""WITH {EV} SELECT ruleId, 60000::BIGINT AS "windowSizeMs", threshold, count(*) AS cnt,
        count(DISTINCT userId) AS keys
      FROM ev JOIN (VALUES ('t-abnormal-login', 'LOGIN', 2), ('t-abnormal-login', 'CHANGE_PASSWORD', 2),
        ('t-high-freq-view', 'VIEW', 100)) r(ruleId, act, threshold) ON act = actionType GROUP BY ruleId, threshold""",
    "pattern_order": times_pattern("'order:' || userId", "PAYMENT", 3, 72),
    "pattern_high_freq": times_pattern("'views:' || sessionId", "VIEW", 2, 24),
    "gated_alerts": f"""{ALERTS} SELECT {ALERT_COLUMNS} FROM al
      WHERE score >= CASE ruleId WHEN 'fx-pay' THEN 8 WHEN 'fx-login' THEN 9 ELSE 0 END""",
    "pipeline_alerts": f"{ALERTS} SELECT {ALERT_COLUMNS} FROM al",
    "topic_alerts": f"{ALERTS} SELECT {ALERT_COLUMNS} FROM al",
    "asof_alerts": f"""WITH RECURSIVE {EV}, {RULE_LOG}, {count_machine("""
      SELECT ruleId || ':' || CASE WHEN nk % 2 = 0 THEN ip ELSE coalesce(deviceId, 'UNKNOWN') END AS gk, ruleId,
        'HIGH_FREQ_ACCESS' AS ruleType, 3600000::BIGINT AS w, threshold::BIGINT AS n, 1.0::DOUBLE AS weight, ev.seq AS arrival,
        userId, ip, deviceId, t
      FROM ev JOIN hist ON act = actionType AND ev.seq >= hist.seq AND (til IS NULL OR ev.seq < til)""")}""",
    "arrival_disorder": f"""WITH RECURSIVE {EV}, {rule_table()}, {matched_rows()}, {arrival_machine("""
      SELECT gk, m.ruleId, ruleType, w, n::BIGINT AS n, weight, userId, ip, deviceId, t,
        CASE m.ruleId WHEN 'fx-login' THEN 'pair' WHEN 'fx-pay' THEN 'pay' ELSE 'count' END AS kind,
        CASE WHEN m.ruleId = 'fx-login' AND actionType = 'LOGIN' THEN 'first' WHEN m.ruleId = 'fx-login' THEN 'second'
          ELSE role END AS part,
        (seq + CASE WHEN seq % 11 = 0 THEN 900 WHEN seq % 5 = 0 THEN 20 ELSE 0 END) * 10000000 + seq AS arrival
      FROM m JOIN rule USING (ruleId)""")}""",
    "tied_alerts": f"""WITH RECURSIVE {EV.replace("epoch_us(ts) // 1000", "epoch_us(ts) // 43200000000 * 43200000")}, {rule_table()}, {matched_rows()},
    {arrival_machine("""
      SELECT gk, m.ruleId, ruleType, w, n::BIGINT AS n, weight, userId, ip, deviceId, t,
        CASE m.ruleId WHEN 'fx-login' THEN 'pair' WHEN 'fx-pay' THEN 'pay' ELSE 'count' END AS kind,
        CASE WHEN m.ruleId = 'fx-login' AND actionType = 'LOGIN' THEN 'first' WHEN m.ruleId = 'fx-login' THEN 'second'
          ELSE role END AS part, row_number() OVER (ORDER BY t, seq) AS arrival
      FROM m JOIN rule USING (ruleId)""")}""",
    "jsonl_roundtrip": f"""WITH {EV} SELECT actionType, deviceId, count(*) AS cnt, sum(t)::BIGINT AS times,
      round(sum(amount), 2) AS amount FROM ev GROUP BY ALL""",
    "csv_roundtrip": f"""WITH {CSV} SELECT CASE k % 3 WHEN 0 THEN 'REMOVE_CART' WHEN 1 THEN 'PURCHASE' ELSE 'VIEW' END AS actionType,
      'p' || (k % 50) AS productId, count(*) AS cnt, sum(ms)::BIGINT AS times FROM c WHERE k % 13 <> 0 GROUP BY ALL""",
    "features_from_documents": feature("userId", DOCUMENT_WRITES),
    "rollup_from_documents": f"""{STAMPED} SELECT (lastEventTimestamp + lag) // 60000 * 60 AS bucket, ruleType, count(*) AS cnt,
      round(avg(score), 6) AS avgRiskScore FROM st GROUP BY 1, 2""",
}

# Alerts as their documents hold them: absent text is '', numbers are long.
_DOCUMENT = """"ruleId", "ruleType", level, "userId", ip, coalesce("deviceId", '') AS "deviceId", "matchCount"::BIGINT AS "matchCount",
  "riskScore", "firstEventTimestamp" AS "firstEventTimestampMs", "lastEventTimestamp" AS "lastEventTimestampMs\""""

ORACLES |= {
    "array_roundtrip": ORACLES["jsonl_roundtrip"],
    "rule_array_roundtrip": f"WITH {CHANGES} SELECT {RULE_FIELDS} FROM chg",
    "rule_topic_snapshot": f"WITH {CHANGES} SELECT {RULE_FIELDS} FROM snap",
    "captured_alerts": f"""{STAMPED} SELECT ruleId, level, count(*) AS cnt, sum(matchCount)::BIGINT AS matched FROM st
      GROUP BY ruleId, level""",
    "matched_tap": f"""WITH {EV}, {matched_rows()}, kinds(ruleId, kind) AS (VALUES {
        ", ".join(f"('{r}', '{kind}')" for r, (kind, *_) in RULES.items())})
      SELECT 'MATCHED ruleType=' || kind || ' ruleId=' || ruleId || ' action=' || actionType || ' userId=' || userId
        || ' ts=' || t AS "value" FROM (SELECT * FROM m JOIN kinds USING (ruleId))
      UNION ALL SELECT 'MATCHED ruleType=CREDENTIAL_STUFFING ruleId=fx-stuffing action=LOGIN userId=' || userId || ' ts=' || t
      FROM ev WHERE actionType = 'LOGIN'""",
    "alert_tap": f"""{STAMPED} SELECT 'ALERT ruleType=' || ruleType || ' ruleId=' || ruleId || ' userId=' || userId
      || ' matchCount=' || matchCount || ' ts=' || (lastEventTimestamp + lag) AS "value" FROM st""",
    "sampled_events": "SELECT least(count(*), 100) AS cnt, least(count(*), 100) AS different FROM events",
    "topic_roundtrip": f"SELECT {_DOCUMENT} FROM ({ORACLES['topic_alerts']})",
    "topic_stream_alerts": f"SELECT {_DOCUMENT} FROM ({ORACLES['topic_alerts']})",
    "live_rule_alerts": f"SELECT {_DOCUMENT} FROM ({ORACLES['asof_alerts']})",
    "stream_rollup": ORACLES["rollup_from_documents"],
    "feature_state_by_user": ORACLES["feature_by_user"],
    "feature_state_by_ip": ORACLES["feature_by_ip"],
    "stream_alert_table": ORACLES["alert_table"],
}
