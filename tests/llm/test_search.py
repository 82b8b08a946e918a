"""SimHash components, connected components and top-k search against plain versions."""

import random
from collections import Counter

import numpy as np
from plain import groups, hard_rows, simhash, spark_docs

from burstguard.llm import components, simhash as S, topk


def test_fingerprints(corpus_spark):
    got = S.fingerprints(spark_docs(corpus_spark).select("doc_id", "text")).collect()
    assert Counter((r[0], r[1] % 2**64) for r in got) == Counter((r[0], simhash(r[1])) for r in hard_rows())


def near_values(rng, n):
    """Clusters whose members differ in a few bits, and noise."""
    out = []
    for _ in range(n):
        base = rng.getrandbits(64)
        for _ in range(rng.randint(1, 9)):
            value = base
            for b in rng.sample(range(64), rng.randint(0, 4)):
                value ^= 1 << b
            out.append(value)
    return sorted(set(out))


def check_links(spark, values, bucket_rows):
    frame = spark.createDataFrame([(S.signed(v),) for v in values], "fp long")
    at = {S.signed(v): i for i, v in enumerate(values)}
    found = [(at[r["a"]], at[r["b"]]) for r in S.fingerprint_links(frame, bucket_rows).collect()]
    true = [(i, j) for i in range(len(values)) for j in range(i) if bin(values[i] ^ values[j]).count("1") <= 3]
    assert all(bin(values[i] ^ values[j]).count("1") <= 3 for i, j in found)
    assert groups(len(values), found) == groups(len(values), true)


def test_links_are_whole(corpus_spark):
    check_links(corpus_spark, near_values(random.Random(2), 60), S.BUCKET_ROWS)


def test_links_are_whole_when_buckets_are_dealt_again(corpus_spark):
    rng = random.Random(4)
    values = near_values(rng, 4) + [0xABCDEF << 40 | rng.getrandbits(10) for _ in range(60)]
    check_links(corpus_spark, sorted(set(values)), 8)


def test_near_duplicates(corpus_spark):
    docs = spark_docs(corpus_spark)
    rows = hard_rows()
    prints = [simhash(r[1]) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= 3]
    root = groups(len(rows), links)
    least = {}
    for r, g in zip(rows, root):
        if r[0] is not None:
            least[g] = min(r[0], least.get(g, r[0]))
    got = S.near_duplicates(docs).collect()
    assert Counter((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in got) == Counter(
        (r[0], p, least.get(g)) for r, p, g in zip(rows, prints, root)
    )
    assert S.near_duplicates(docs.limit(0)).count() == 0


def test_components(corpus_spark):
    rng = random.Random(7)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 380)]
    got = components.components(corpus_spark.createDataFrame(edges + [(None, 3), (5, 5)], "a long, b long")).collect()
    root = groups(381, edges)
    on = {x for a, b in edges if a != b for x in (a, b)}
    assert {r["node"]: r["root"] for r in got} == {x: root[x] for x in on} and len(got) == len(on)
    empty = corpus_spark.createDataFrame([], "a long, b long")
    assert components.components(empty).count() == 0


def plain_top(rows, k):
    """rows: (vec_id, ints); queries: even ids."""
    out = []
    for i, (q, x) in enumerate(rows):
        if q % 2 == 0:
            scored = [(-sum(a * b for a, b in zip(x, y)), v) for j, (v, y) in enumerate(rows) if j != i]
            out += [(q, n + 1, v, -s) for n, (s, v) in enumerate(sorted(scored)[:k])]
    return Counter(out)


def test_top_k(corpus_spark, monkeypatch):
    rng = np.random.default_rng(1)
    vectors = [(int(i), [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(300, 8)).astype("float32"))]
    vectors += [(4, vectors[4][1]), (6, vectors[7][1]), (1000, [0.0] * 8), (1002, [1.0, 2.0])]
    bad = [(1, None), (2, [1.0, None]), (3, [float("nan")] * 8), (8, [float("inf")] + [0.0] * 7), (None, [1.0] * 8)]
    frame = corpus_spark.createDataFrame(vectors + bad, "vec_id long, embedding array<float>")
    monkeypatch.setattr(topk, "BLOCK", 70)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 50)
    monkeypatch.setattr(topk, "POSSIBLE", 10)
    got = topk.top_k(frame, "vec_id % 2 = 0", k=5).collect()
    ints = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in vectors]
    assert Counter(map(tuple, got)) == plain_top(ints, 5)
    assert topk.top_k(frame.limit(0), "vec_id % 2 = 0").count() == 0
    two = frame.filter("vec_id in (1000, 10)")
    assert topk.top_k(two, "vec_id % 2 = 0").count() == 2


def test_the_scan_stops_on_proof():
    """Postings read: far fewer than all where few components hold a score, fewer than all on vectors without structure;
    what is proved impossible really is."""
    rng = np.random.default_rng(3)
    skewed = np.zeros((4000, 64), np.int64)
    for row in skewed:
        row[rng.choice(64, 3, replace=False, p=1 / np.arange(1, 65) / np.sum(1 / np.arange(1, 65)))] = rng.integers(20, 256, 3)
        row += rng.integers(-2, 3, 64)
    loose = rng.normal(0, 32, (4000, 64)).astype(np.int64)
    for matrix, share in ((skewed, 0.35), (loose, 0.85)):
        block = topk.Block(matrix, topk.segments(matrix))
        for i in range(40):
            other = np.arange(len(matrix)) != i
            exact = matrix @ matrix[i]
            floor = int(np.sort(exact[other])[-5])
            found, scores = block.best(matrix[i], other, 5, floor)
            assert (scores == exact[found]).all()
            assert set(np.flatnonzero((exact >= floor) & other)) <= set(found)
        assert block.read < share * 40 * np.count_nonzero(matrix)


def test_components_beyond_one_number():
    """Scores that leave no room for the count beside them are taken exactly for all rows."""
    matrix = np.array([[1 << 27, -(1 << 27)], [1 << 26, 5], [0, 0]], np.int64)
    block = topk.Block(matrix, topk.segments(matrix))
    found, scores = block.best(matrix[0], np.array([False, True, True]), 1, 0)
    assert dict(zip(found.tolist(), scores.tolist()))[1] == (1 << 53) - 5 * (1 << 27)
