"""DuckDB SQL of the corpus queries that SQL can express."""

from burstguard.llm.sharding import BUCKETS, SEED

OP6 = r"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls,
         row_number() OVER () AS r
  FROM documents
), windows AS (
  SELECT r, unnest(range(1, len(w) - 3)) AS i,
         unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS five
  FROM split WHERE len(w) >= 5
), marked AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, five) AS n FROM windows
), covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM marked WHERE n > 1) GROUP BY r
), counted AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
         len(ls) AS n_lines,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_capitals,
         length(t) - length(replace(t, '!', '')) AS n_bangs
  FROM split LEFT JOIN covered c USING (r)
), judged AS (
  SELECT *, CAST(
      (n_words < 10)::INT + 2 * (100 * n_repeat_words > 20 * n_words)::INT + 4 * (10 * n_symbols > 3 * n_words)::INT
    + 8 * (word_chars < 2 * n_words)::INT + 16 * (word_chars > 14 * n_words)::INT + 32 * (10 * n_dup_lines > 3 * n_lines)::INT
    + 64 * (2 * n_capitals > word_chars)::INT + 128 * (4 * n_bangs > n_words)::INT AS BIGINT) AS fail_bits
  FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits
FROM judged
"""

#: CRC-32 of a text in SQL: the byte table follows from the polynomial.
_CRC = """
  SELECT list(c ORDER BY b) AS tab FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS b))
"""

OP8 = f"""
WITH crc AS ({_CRC}), rows_ AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         CAST(strlen(coalesce(text, '')) + 8 AS BIGINT) AS size,
         coalesce('s' || source, 'n') AS stratum,
         CAST('0x' || substr(md5(concat_ws('|', '{SEED}', coalesce(CAST(doc_id AS VARCHAR), ''), coalesce(text, ''))), 1, 15) AS BIGINT) AS key
  FROM documents
), summed AS (
  SELECT rows_.*, xor(list_reduce(
    list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda h: CAST('0x' || h AS BIGINT))),
    lambda c, b: xor(c >> 8, crc.tab[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM rows_, crc
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY key, doc_id, text_crc32, size) AS rank,
         count(*) OVER (PARTITION BY stratum) AS n
  FROM summed
), cells AS (
  SELECT *, (rank - CAST(0.5 AS DOUBLE)) / n AS fraction FROM ranked
), placed AS (
  SELECT *, row_number() OVER (ORDER BY CAST(floor(fraction * {BUCKETS}) AS INT), fraction, stratum, rank) - 1 AS position,
         count(*) OVER () AS total
  FROM cells
)
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law,
       CAST(position * 24 // total AS INT) AS shard,
       CAST(position - ((position * 24 // total) * total + 23) // 24 AS BIGINT) AS slot,
       CAST(NULL AS INT) AS grown_shard, source
FROM placed
"""

ORACLES = {"op6_quality_rules": OP6, "op8_sharding": OP8}

OP9 = """
WITH used AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v, row_number() OVER () AS r
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, q.r AS qr, c.vec_id,
         CAST(list_sum(list_transform(range(1, least(len(q.v), len(c.v)) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM used q JOIN used c ON q.r <> c.r WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(n AS INT) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id, qr ORDER BY score DESC, vec_id) AS n FROM scored) WHERE n <= 5
"""

ORACLES["op9_topk_search"] = OP9


def _op13(k: int = 40, rounds: int = 5) -> str:
    """The rounds one after the other: c0, a0, c1, a1, ... are the centroids and the vectors' nearest of them."""
    parts = [
        """v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS c, v FROM v
  QUALIFY c < {k})""",
    ]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v, min({{'d': d, 'c': c}}) AS near FROM (
    SELECT r, vec_id, v.v, c, CAST(list_sum(list_transform(range(1, 65), lambda i: (v.v[i] - m.v[i]) * (v.v[i] - m.v[i]))) AS BIGINT) AS d
    FROM v, c{i} AS m) GROUP BY r)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c, coalesce(n.v, o.v) AS v FROM c{i} AS o LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY d) AS v FROM (
      SELECT near.c AS c, d, sum(CAST(v[d] AS HUGEINT)) AS s, count(*) AS n FROM a{i}, range(1, 65) AS dims(d) GROUP BY 1, 2)
    GROUP BY c) AS n USING (c))""")
    return "WITH " + ", ".join(parts) + f"""
SELECT vec_id, CAST(near.c AS INT) AS cluster, CAST(near.d AS BIGINT) AS distance,
       CAST(sum(near.d) OVER (PARTITION BY near.c) AS BIGINT) AS cluster_inertia, CAST(sum(near.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM a{rounds} AS a JOIN c{rounds} AS m ON m.c = a.near.c"""


ORACLES["op13_centroids"] = _op13()

ORACLES["op12_divergence_audit"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), places AS MATERIALIZED (
  SELECT r, lang, source, unnest(words) AS term FROM docs
), kept AS MATERIALIZED (
  SELECT lang, term, count(*) OVER (PARTITION BY lang) AS v FROM (
    SELECT lang, term FROM places GROUP BY lang, term HAVING count(DISTINCT r) >= 10)
), counts AS MATERIALIZED (
  SELECT lang, source, term, count(*) AS n FROM places SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), totals AS (
  SELECT lang, source, sum(n) AS total FROM counts GROUP BY lang, source
), groups_ AS (
  SELECT DISTINCT lang, source FROM docs
), shares AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(t.total, 0) + 2 * k.v) AS p
  FROM groups_ g JOIN kept k ON k.lang = g.lang
  LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), whole AS (
  SELECT k.lang, k.term, 1 + (1000000000::HUGEINT * (coalesce(sum(c.n), 0) + 2))
                           // (coalesce((SELECT sum(total) FROM totals t WHERE t.lang = k.lang), 0) + 2 * any_value(k.v)) AS q
  FROM kept k LEFT JOIN counts c USING (lang, term) GROUP BY k.lang, k.term
), compared AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(c.value, 0) AS value
  FROM groups_ a JOIN groups_ b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN compared c ON c.lang = a.lang AND c.source = a.source AND c.item = b.source
  UNION ALL
  SELECT s.lang, s.source, 'term', s.term, (p - q) * (p - q) // (p + q)
  FROM shares s JOIN whole w ON w.lang = s.lang AND w.term = s.term WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""

ORACLES["op11_warc"] = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS digits,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last
  FROM pages
)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
         (CAST('0x' || substr(digits, CAST(i // 4 * 5 + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - i % 4 * 5 AS INT)) & 31 AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM last THEN NULL ELSE last END AS refers_to
FROM payloads
"""
