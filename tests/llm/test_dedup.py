"""Suffix-array dedup against plain versions."""

import random
from collections import Counter

import numpy as np
import pytest
from plain import hard_rows, sha, spark_docs, without_repeats

from burstguard.llm import suffix_dedup, suffixes


def test_suffix_array_is_sorted():
    rng = random.Random(1)
    for _ in range(300):
        text = [rng.randint(1, rng.choice([1, 2, 3, 26])) for _ in range(rng.randint(0, 60))] + [0]
        got = suffixes.suffix_array(np.array(text, np.int64)).tolist()
        assert got == sorted(range(len(text)), key=lambda i: text[i:])


def test_repeated_starts():
    rng = random.Random(2)
    for _ in range(300):
        parts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 30))) for _ in range(rng.randint(1, 6))]
        length = rng.randint(1, 8)
        count = Counter(p[i : i + length] for p in parts for i in range(len(p) - length + 1))
        got = suffixes.repeated_starts(parts, length)
        assert [g.tolist() for g in got] == [
            [count[p[i : i + length]] > 1 for i in range(len(p) - length + 1)] for p in parts
        ]


def check(spark, rows, length, anchor):
    docs = spark_docs(spark, rows)
    keys = docs.withColumns(suffix_dedup.text_keys()).select("doc_id", "text", "text_id", "n_bytes")
    found = suffix_dedup.repeated_spans(docs, length, anchor)
    got = keys.join(found, ["text_id", "n_bytes"], "left").collect()
    want = without_repeats([r[1] for r in rows], length)
    assert Counter(
        (r["doc_id"], r["n_removed"], len(r["spans"]) // 2, r["kept_sha256"]) if r["spans"] else (r["doc_id"], 0, 0, None)
        for r in got
    ) == Counter(
        (r[0], removed, runs, sha(left)) if removed else (r[0], 0, 0, None) for r, (removed, runs, left) in zip(rows, want)
    )


@pytest.mark.parametrize("length, anchor", [(400, 64), (40, 8)])
def test_hard_rows(corpus_spark, length, anchor):
    check(corpus_spark, hard_rows(), length, anchor)


def test_random_passages(corpus_spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 50)
    rng = random.Random(3)
    passages = ["".join(rng.choice("abc é") for _ in range(rng.randint(10, 60))) for _ in range(12)]
    rows = [
        (i, "".join(rng.choice([*passages, "".join(rng.choice("abcd") for _ in range(20))]) for _ in range(5)), "", "", 0)
        for i in range(80)
    ]
    check(corpus_spark, rows, 24, 6)


def test_anchors_with_many_segments_are_cut(corpus_spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD_SEGMENTS", 5)
    rng = random.Random(4)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(120))
    word = lambda: "".join(rng.choice("ab") for _ in range(rng.randint(1, 30)))
    rows = [(i, word() + passage + word(), "", "", 0) for i in range(60)]
    check(corpus_spark, rows, 40, 8)


def test_empty_table(corpus_spark):
    assert suffix_dedup.repeated_spans(spark_docs(corpus_spark).limit(0)).count() == 0
