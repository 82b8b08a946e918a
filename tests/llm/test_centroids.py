import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from burstguard.llm import centroids

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, k, rounds, dims):
    """The contract, one vector at a time in plain integers."""
    kept = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    drawn = sorted((hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    cents = [v for _, v in drawn[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents))

    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(nearest(v)[1], []).append(v)
        cents = [
            [sum(column) // len(members[n]) for column in zip(*members[n])] if n in members else c for n, c in enumerate(cents)
        ]
    placed = [(i, *nearest(v)[::-1]) for i, v in kept]
    total = sum(d for _, _, d in placed)
    return sorted(
        (
            -1 if i is None else i, c, d, sum(e for _, o, e in placed if o == c), total,
            hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest(),
        )
        for i, c, d in placed
    )


def got(df):
    return sorted((-1 if r["vec_id"] is None else r["vec_id"], *r[1:]) for r in df.collect())


def vectors(n, dims, seed):
    rng = random.Random(seed)
    middle = [[rng.choice([-0.5, 0.0, 0.3]) for _ in range(dims)] for _ in range(3)]
    return [(i, [round(m + rng.gauss(0, 0.02), 3) for m in rng.choice(middle)]) for i in range(n)]


HARD = [
    (None, [0.5] * 4), (900, None), (901, [0.1, None, 0.2, 0.3]), (902, [math.nan, 0.0, 0.0, 0.0]), (903, [math.inf, 0.0, 0.0, 0.0]),
    (904, [0.1] * 3), (905, []), (906, [0.25] * 4), (906, [0.25] * 4), (907, [0.25] * 4), (908, [-0.001, -0.0, 1e-9, 3.0]),
]


@pytest.mark.parametrize("k, rounds", [(1, 2), (5, 3), (7, 0), (400, 2)])
def test_equals_plain_version(corpus_spark, k, rounds):
    rows = vectors(150, 4, k) + HARD
    df = corpus_spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({c: F.lit(1) for c in ("values", "cluster", "n", "draw")})
    floats = [(r["vec_id"], r["embedding"]) for r in df.select("vec_id", "embedding").collect()]
    found, final = centroids.clustered(df, k=k, rounds=rounds, dims=4)
    assert got(found) == plain(floats, k, rounds, 4)
    assert len(final) == min(k, len([1 for r in plain(floats, k, 0, 4)]))


def test_empty_centroid_stays(corpus_spark):
    """Equal vectors: every centroid but the first has no vectors and keeps its place."""
    found, final = centroids.clustered(corpus_spark.createDataFrame([(i, [1.0, 2.0]) for i in range(9)], SCHEMA), k=3, dims=2)
    assert {(r["cluster"], r["distance"]) for r in found.collect()} == {(0, 0)}
    assert final == [[256, 512]] * 3


def test_no_vectors(corpus_spark):
    found, final = centroids.clustered(corpus_spark.createDataFrame(HARD[1:7], SCHEMA), dims=64)
    assert found.count() == 0 and final == []
    assert centroids.clustered(corpus_spark.createDataFrame([], SCHEMA))[0].columns == found.columns


def test_many_blocks_of_wide_values(corpus_spark, monkeypatch):
    monkeypatch.setattr(centroids, "BLOCK", 16)
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-50_000, 50_000) for _ in range(3)]) for i in range(120)]
    df = corpus_spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(centroids.clustered(df, k=6, rounds=4, dims=3)[0]) == plain(rows, 6, 4, 3)


def test_components_out_of_reach_take_no_part(corpus_spark):
    df = corpus_spark.createDataFrame([(1, [1e30, 0.0]), (2, [1.0, 0.0])], "vec_id long, embedding array<double>")
    assert [r["vec_id"] for r in centroids.clustered(df, k=2, dims=2)[0].collect()] == [2]
