import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from burstguard.llm import divergence
from burstguard.llm.transducers import Transducer, build
from plain import hard_rows, spark_docs

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain(rows, min_docs, top=10):
    """The contract on whole Python lists: every group, every kept term."""
    docs = [(lang or "", source or "", TERM.findall(lowered(text))) for _, text, lang, source, _ in rows]
    standing, counts, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, _, words in docs:
        standing[lang].update(set(words))
    kept = {lang: sorted((t for t, n in c.items() if n >= min_docs), key=str.encode) for lang, c in standing.items()}
    for lang, source, words in docs:
        counts[lang, source].update(w for w in words if standing[lang][w] >= min_docs)
        langs[lang].update(w for w in words if standing[lang][w] >= min_docs)

    def shares(found, terms):
        return [1 + 10**9 * (found[t] + 2) // (sum(found.values()) + 2 * len(terms)) for t in terms]

    def value(p, q):
        return (p - q) ** 2 // (p + q)

    out = []
    for lang, source in counts:
        terms = kept[lang]
        p = shares(counts[lang, source], terms)
        others = [
            (sum(map(value, p, shares(counts[lang, o], terms))), o) for (other, o) in counts if other == lang and o != source
        ]
        used = [(value(a, b), t) for t, a, b in zip(terms, p, shares(langs[lang], terms)) if counts[lang, source][t] and a > b]
        for part, found in (("pair", others), ("term", used)):
            ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[: None if part == "pair" else top]
            out += [(lang, source, part, item, v, r) for r, (v, item) in enumerate(ranked, 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def made_rows(n, seed):
    rng = random.Random(seed)
    words = ["The", "the", "árbol", "été", "Été", "漢字", "a", "ab", "abc", "abd", "b", "ba", "\U0001f600x", "don", "t", "zz"]
    rows = []
    for i in range(n):
        lang, source = rng.choice(["en", "en", "fr", None, ""]), rng.choice(["s0", "s0", "s0", "s1", "S1", "é", None])
        text = rng.choice([" ", "'", "1", "\n"]).join(rng.choices(words, [3, 5] + [1] * 14, k=rng.randrange(25)))
        rows.append((i, text or None, lang, source, 1))
    return rows


@pytest.mark.parametrize("min_docs", [1, 10, 1000])
def test_equals_plain_version(corpus_spark, min_docs):
    rows = made_rows(150, min_docs) + hard_rows() + [(1, None, "xx", "alone", 0), (1, "9", "yy", "a", 0), (1, "9", "yy", "b", 0)]
    assert got(divergence.audit(spark_docs(corpus_spark, rows).repartition(3), min_docs)) == plain(rows, min_docs)


def test_small_ranges_rounds_blocks_and_tiles(corpus_spark, monkeypatch):
    """Every cut of the work at once: several transducers a language, one a round, short portions of text."""
    for name, value in dict(RANGE_TERMS=3, ROUND_BYTES=200, TEXT_BYTES=40, HELD_TERMS=5, BLOCK=2, TILE=2).items():
        monkeypatch.setattr(divergence, name, value)
    rows = made_rows(120, 3) + hard_rows()
    assert got(divergence.audit(spark_docs(corpus_spark, rows), 2)) == plain(rows, 2)


def test_empty_table(corpus_spark):
    assert divergence.audit(spark_docs(corpus_spark, [])).count() == 0


def test_one_source_holds_most_and_ties_go_by_bytes(corpus_spark):
    rows = [(i, "same words é z Z", "en", "hot" if i % 3 else f"s{i % 2}", 1) for i in range(90)]
    found = got(divergence.audit(spark_docs(corpus_spark, rows), 10))
    assert found == plain(rows, 10)
    assert [r[3] for r in found if r[:3] == ("en", "hot", "pair")] == ["s0", "s1"]


def walked(packed, words):
    text = np.frombuffer(b"\0".join(words) + b"\0", np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    return Transducer.load(packed).walk(text, ends - [len(w) for w in words], ends).tolist()


@settings(max_examples=150, deadline=None)
@given(st.sets(st.binary(min_size=1, max_size=6).map(lambda b: bytes(x % 4 + 97 for x in b)), max_size=60), st.randoms())
def test_transducer_numbers_terms(terms, rng):
    order = sorted(terms)
    packed = build(order)
    words = [bytes(rng.choices(b"abcd", k=rng.randrange(1, 8))) for _ in range(80)] + order
    place = {t: i for i, t in enumerate(order)}
    assert walked(packed, words) == [place.get(w, -1) for w in words]
    assert [Transducer.load(packed).term(i) for i in range(len(order))] == order


def test_transducer_is_minimal():
    """Two states with the same continuations would be one: what is left equals the distinct sets of endings."""
    terms = sorted({a + b + c for a in (b"x", b"yy", b"z") for b in (b"", b"in", b"on") for c in (b"s", b"ing")})
    endings = {frozenset(t[len(p):] for t in terms if t.startswith(p)) for t in terms for p in (t[:i] for i in range(len(t) + 1))}
    loaded = Transducer.load(build(terms))
    assert len(loaded.finals) == len(endings)


def test_transducer_wants_ascending_terms():
    with pytest.raises(ValueError):
        build([b"b", b"a"])


def test_long_terms_and_texts(corpus_spark, monkeypatch):
    monkeypatch.setattr(divergence, "TEXT_BYTES", 1000)
    long_word = "w" * 5000
    rows = [(i, f"{long_word} {'many words ' * 700}{i}", "en", f"s{i % 2}", 1) for i in range(12)]
    assert got(divergence.audit(spark_docs(corpus_spark, rows), 10)) == plain(rows, 10)


def test_other_columns_are_not_read(corpus_spark):
    rows = made_rows(30, 9)
    names = {c: F.lit("x") for c in ("term", "ordinal", "p", "base", "block", "tile", "value", "item")}
    assert got(divergence.audit(spark_docs(corpus_spark, rows).withColumns(names), 2)) == plain(rows, 2)


def test_portions_of_text_count_as_the_whole(monkeypatch):
    """In this process, where the sizes of portions can be made small: every word once, none cut in two."""
    import pyarrow as pa

    monkeypatch.setattr(divergence, "TEXT_BYTES", 7)
    rng = random.Random(8)
    words = ["a", "ab", "abc", "straße", "漢字", "longerthanaportion", "zz"]
    docs = [(rng.choice("xy"), " ".join(rng.choices(words, k=rng.randrange(30)))) for _ in range(40)]
    terms = sorted(w.encode() for w in words[:-1])
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["en"] * 40), pa.array([s for s, _ in docs]), pa.array([t.upper().replace("SS", "ss").replace("ẞ", "ß").encode() for _, t in docs])],
        names=["lang", "source", "text"],
    )
    found = Counter()
    for out in divergence.Counting([("en", 0, build(terms[:3])), ("en", 3, build(terms[3:]))])(iter([batch])):
        for source, ordinal, n in zip(*(out[c].to_pylist() for c in ("source", "ordinal", "n"))):
            found[source, terms[ordinal]] += n
    expected = Counter((s, t.encode()) for s, d in docs for t in TERM.findall(lowered(d.upper().replace("SS", "ss"))) if t.encode() in terms)
    assert found == expected
