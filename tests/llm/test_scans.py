"""Licence scan, quality rules, BPE, packing and sharding against plain versions on hard rows."""

from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from plain import base_places, crc, hard_rows, rule_counts, spark_docs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from burstguard.llm import bpe, licences, packing, rules, sharding

KEY = lambda r: (r[0] is None, r[0] or 0, r[1] or "")


def test_rules_match_plain_counts(corpus_spark):
    docs = spark_docs(corpus_spark)
    got = rules.apply_policy(rules.ledger(docs)).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert Counter((r["doc_id"], *(r[n] for n in names)) for r in got) == Counter(
        (r[0], *rule_counts(r[1])) for r in hard_rows()
    )
    assert all(not r["kept"] for r in got if r["n_words"] < 10)
    assert rules.ledger(docs.limit(0)).count() == 0


def test_ablation_counts(corpus_spark):
    frame = corpus_spark.createDataFrame([(1, 1), (2, 1), (3, 3), (4, 0), (5, 2)], "doc_id long, fail_bits long")
    got = {r["rule"]: (r["failed"], r["failed_alone"]) for r in rules.ablation(frame, "base-1").collect()}
    assert got == {"few_words": (3, 2), "repeated_windows": (2, 1)}


def test_licences_match_plain_places(corpus_spark):
    got = licences.scan(spark_docs(corpus_spark)).select("doc_id", "found.*").collect()
    want = Counter((r[0], *base_places(r[1], licences.BASE_PHRASES)) for r in hard_rows())
    assert Counter(tuple(r)[:6] for r in got) == want
    assert all(0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) for r in got)
    spdx = next(r for r in got if r["doc_id"] == 7)
    assert spdx["expressions"] == "mit gpl-2.0-only classpath-exception-2.0 with or cc-by-4.0 and"
    assert spdx["score"] == pytest.approx(0.2)


@pytest.mark.parametrize(
    "text, want",
    [("MIT", 0.1), ("GPL-3.0-or-later", 0.7), ("MIT AND GPL-2.0", 0.7), ("MIT OR (GPL-2.0 AND MPL-2.0)", 0.1),
     ("GPL-2.0 WITH x", 0.4), ("odd-name", 0.5), ("MIT */", 0.1), ("cc0-1.0 or mit", 0.0)],
)
def test_expressions(text, want):
    assert licences.evaluate(licences.postfix(text)) == pytest.approx(want)


@pytest.mark.parametrize("text", ["", "AND MIT", "(MIT", "MIT OR", "MIT)", "()"])
def test_malformed_expressions(text):
    assert licences.postfix(text) is None


def test_bpe_equals_the_library(corpus_spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    got = bpe.decode(bpe.encode(spark_docs(corpus_spark), path), path).select("doc_id", "ids", "decoded").collect()
    want = []
    for r in hard_rows():
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        want.append((r[0], tuple(ids), library.decode(ids, skip_special_tokens=False)))
    assert Counter((r[0], tuple(r[1]), r[2]) for r in got) == Counter(want)


def test_bpe_random_texts_equal_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, machine = Tokenizer.from_file(path), bpe.ForcedBoundaryEncoder(path)
    rng = np.random.default_rng(5)
    letters = list("abcdeABC   \n\t'ts.,!019éÉßİſ漢字か́ ​<|>endoftext\x1c\x00😀ẛ")
    for _ in range(1500):
        text = "".join(rng.choice(letters, rng.integers(0, 40)))
        assert np.frombuffer(machine.encode(text), "<i4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert machine.never[ord("a"), ord(" ")] and not machine.never[ord("t"), ord("h")]


def check_packing(rows, docs, capacity, end):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for r in docs:
        ids = tuple(library.encode(r[1] or "", add_special_tokens=False).ids) + ((end,) if end is not None else ())
        if ids:
            want[(r[0], ids)] += 1
    by_doc, by_sequence = {}, {}
    for r in rows:
        ids = tuple(np.frombuffer(r["ids"], "<u4").tolist())
        assert len(ids) == r["length"] > 0
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], ids))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(len(ids) * n for (_, ids), n in want.items())
    assert sum(len(i) for p in by_doc.values() for _, i in p) == total
    single = {k: v for k, v in by_doc.items() if sum(len(i) for _, i in v) == k[1]}
    for (doc_id, tokens), pieces in single.items():
        pieces.sort()
        assert [s for s, _ in pieces] == [sum(len(i) for _, i in pieces[:j]) for j in range(len(pieces))]
        assert want[(doc_id, tuple(x for _, i in pieces for x in i))] == 1
    return len(by_sequence), total


@pytest.mark.parametrize("capacity, opened, end", [(1024, 8, 0), (64, 2, 0), (16, 1, None)])
def test_packing(corpus_spark, capacity, opened, end):
    docs = spark_docs(corpus_spark).repartition(3)
    rows = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity, opened, end).collect()
    sequences, total = check_packing(rows, hard_rows(), capacity, end)
    assert sequences <= -(-total // capacity) + 3 * opened
    assert packing.pack(docs.limit(0), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


def test_encoder_equals_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, machine = Tokenizer.from_file(path), packing.Encoder(path)
    assert machine.ordinary is not None
    rng = np.random.default_rng(3)
    letters = list("ab cd   \n\t'ts.,!01éßñ \x1c\x85”…ÀŸ½") + [" 's", " don't", "tion", "the "]
    other = letters + list("漢　😀ж") + ["<|endoftext|>"]
    for i in range(3000):
        text = "".join(rng.choice(other if i % 3 else letters, rng.integers(0, 30)))
        assert np.frombuffer(machine.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_sharding(corpus_spark):
    docs = spark_docs(corpus_spark)
    got = sharding.interleave(docs, shards=5).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (r[0], len((r[1] or "").encode()) + 8, crc(r[1])) for r in hard_rows()
    )
    shards = {}
    for r in got:
        shards.setdefault(r["shard"], []).append(r)
    sizes = [len(v) for v in shards.values()]
    assert set(shards) == set(range(5)) and max(sizes) - min(sizes) <= 1
    assert all(sorted(r["slot"] for r in v) == list(range(len(v))) for v in shards.values())
    hot = Counter(r["source"] for r in got)["a"]
    assert all(abs(sum(r["source"] == "a" for r in v) - hot / 5) <= 2 for v in shards.values())
    again = sharding.interleave(docs.repartition(7), shards=5)
    assert Counter((r["doc_id"], r["text_crc32"], r["shard"], r["slot"]) for r in again.collect()) == Counter(
        (r["doc_id"], r["text_crc32"], r["shard"], r["slot"]) for r in got
    )
    assert sharding.interleave(docs.limit(0)).count() == 0
    one = docs.filter(F.col("doc_id") == 1)
    assert [(r["shard"], r["slot"]) for r in sharding.interleave(one, shards=24).collect()] == [(0, 0)]
