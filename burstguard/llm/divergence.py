"""How far the sources of a language diverge from each other, and which terms a source overuses.

1. Terms are counted once a document; those in enough documents of their language are kept.
2. Kept terms are sorted and dealt into ranges; each range becomes a minimal acyclic transducer whose ordinals, raised by
   the terms of the ranges before, number the kept terms of a language in byte order.
3. All texts stream through the transducers once more, which turns words into ordinals: counts per group and ordinal. The
   transducers travel to the tasks in rounds of bounded size; a vocabulary larger than that takes more passes.
4. Shares, divergences and ranks follow in exact integers; ordinals stand for terms, in joins and as tie-break.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from burstguard.llm.common import written
from burstguard.llm.transducers import Transducer, build

#: Terms, and bytes of terms, of one transducer.
RANGE_TERMS, RANGE_BYTES = 100_000, 4 << 20
#: Bytes of transducers that travel to the tasks at a time.
ROUND_BYTES = 64 << 20
#: Bytes of text that are walked at a time.
TEXT_BYTES = 4 << 20
#: Counted terms that a task holds before it hands them on.
HELD_TERMS = 200_000
#: Ordinals of a block and sources of a tile in the comparison of sources.
BLOCK, TILE = 4096, 256

#: Bytes of a term: letters of ASCII and all of other characters; only A-Z is lower-cased.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 0 for b in range(256))
_WORD, _BREAK = re.compile(rb"[^\x00]+"), re.compile(rb"\x00")


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    return docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), text)


def _portions(folded: bytes) -> Iterator[bytes]:
    """A text in which all but terms is zero bytes, cut between terms into portions of about ``TEXT_BYTES``."""
    begin = 0
    while len(folded) - begin > TEXT_BYTES:
        gap = _BREAK.search(folded, begin + TEXT_BYTES)
        end = gap.start() if gap else len(folded)
        yield folded[begin:end]
        begin = end
    yield folded[begin:]


def kept_terms(docs: DataFrame, min_docs: int) -> DataFrame:
    """``lang, term``: the terms that stand in at least ``min_docs`` documents of their language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        schema = pa.schema([("lang", pa.string()), ("term", pa.binary()), ("n", pa.int64())])

        def handed() -> Iterator[pa.RecordBatch]:
            for lang, found in held.items():
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(found)), pa.array(list(found), pa.binary()), pa.array(list(found.values()))], schema=schema
                    )
            held.clear()

        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"]):
                words = set().union(*(_WORD.findall(portion) for portion in _portions(text.as_py().translate(_LOWER))))
                held.setdefault(lang, Counter()).update(words)
                if len(words) + sum(map(len, held.values())) > HELD_TERMS:
                    yield from handed()
        yield from handed()

    partial = _texts(docs).select("lang", "text").mapInArrow(count, "lang string, term binary, n long")
    return (
        partial.groupBy("lang", "term").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_docs)
        .select("lang", F.col("term").cast("string").alias("term"))
    )


def vocabulary(terms: DataFrame) -> DataFrame:
    """``lang, base, n_terms, packed``: the transducers of each language's ranges, ``base`` being the terms before."""

    def ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lang, held, size = None, [], 0

        def closed() -> pd.DataFrame:
            return pd.DataFrame({"lang": [lang], "first": [held[0]], "n_terms": [len(held)], "packed": [build(held)]})

        for frame in batches:
            for one, term in zip(frame["lang"], frame["term"]):
                term = bytes(term)
                if held and (one != lang or len(held) == RANGE_TERMS or size > RANGE_BYTES):
                    yield closed()
                    held, size = [], 0
                lang = one
                held.append(term)
                size += len(term)
        if held:
            yield closed()

    parts = max(1, -(-terms.count() // RANGE_TERMS))
    ordered = terms.repartitionByRange(parts, "lang", "term").sortWithinPartitions("lang", "term")
    built = ordered.select("lang", F.col("term").cast("binary").alias("term")).mapInPandas(
        ranges, "lang string, first binary, n_terms long, packed binary"
    )
    before = W.partitionBy("lang").orderBy("first").rowsBetween(W.unboundedPreceding, -1)
    # a row for a hundred thousand terms: the window is over the few ranges of a language
    return written(built).select("lang", F.coalesce(F.sum("n_terms").over(before), F.lit(0)).alias("base"), "n_terms", "packed")


class Counting:
    """Streams texts through the transducers of one round."""

    def __init__(self, ranges: list[tuple[str, int, bytes]]):
        self.of: dict[str, list] = {}
        for lang, base, packed in ranges:
            self.of.setdefault(lang, []).append((base, Transducer.load(packed)))

    def pieces(self, docs: list[tuple[str, bytes]]) -> Iterator[list[tuple[str, bytes]]]:
        """Texts of one language, folded, in portions; a longer text is cut between words."""
        held, size = [], 0
        for source, whole in docs:
            for text in _portions(whole.translate(_LOWER)):
                if held and size + len(text) > TEXT_BYTES:
                    yield held
                    held, size = [], 0
                held.append((source, text))
                size += len(text)
        if held:
            yield held

    def count(self, lang: str, docs: list[tuple[str, bytes]]) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        """Per source: ordinals and how often they occur."""
        sources = sorted({s for s, _ in docs})
        number = {s: i for i, s in enumerate(sources)}
        owner = np.array([number[s] for s, _ in docs])
        text = np.frombuffer(b"\0".join([t for _, t in docs]) + b"\0", np.uint8)
        border = np.diff((text != 0).astype(np.int8), prepend=np.int8(0))
        starts, ends = np.flatnonzero(border == 1), np.flatnonzero(border == -1)
        limits = np.cumsum([len(t) + 1 for _, t in docs])
        group = owner[np.searchsorted(limits, starts, "right")]
        found_keys = []
        for begin in range(0, len(starts), 1 << 19):
            part = slice(begin, begin + (1 << 19))
            for base, transducer in self.of[lang]:
                ordinals = transducer.walk(text, starts[part], ends[part])
                hit = ordinals >= 0
                found_keys.append((group[part][hit] << 40) | (ordinals[hit] + base))
        keys, n = np.unique(np.concatenate(found_keys) if found_keys else np.zeros(0, np.int64), return_counts=True)
        for i, source in enumerate(sources):
            low, high = np.searchsorted(keys, [i << 40, (i + 1) << 40])
            if low < high:
                yield source, keys[low:high] & ((1 << 40) - 1), n[low:high]

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("ordinal", pa.int64()), ("n", pa.int64())])
        for batch in batches:
            by_lang: dict[str, list] = {}
            for lang, source, text in zip(*(batch[c].to_pylist() for c in ("lang", "source", "text"))):
                if lang in self.of:
                    by_lang.setdefault(lang, []).append((source, text))
            for lang, docs in by_lang.items():
                for portion in self.pieces(docs):
                    for source, ordinals, n in self.count(lang, portion):
                        arrays = [pa.array([lang] * len(n)), pa.array([source] * len(n)), pa.array(ordinals), pa.array(n.astype(np.int64))]
                        yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def recount(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """``lang, source, ordinal, n``: occurrences of kept terms in each group, those that occur."""
    # one row for a hundred thousand terms: how the ranges fall into rounds is settled on the driver
    sizes = ranges.select("lang", "base", F.length("packed").alias("bytes")).orderBy("lang", "base").collect()
    rounds: dict[int, list[tuple[str, int]]] = {}
    size = 0
    for row in sizes:
        rounds.setdefault(size // ROUND_BYTES, []).append((row["lang"], row["base"]))
        size += row["bytes"]
    counted = []
    for wanted in rounds.values():
        names = docs.sparkSession.createDataFrame(wanted, "lang string, base long")
        chosen = ranges.join(F.broadcast(names), ["lang", "base"], "left_semi")
        local = [(row["lang"], row["base"], bytes(row["packed"])) for row in chosen.collect()]
        sent = docs.sparkSession.sparkContext.broadcast(local)  # at most ROUND_BYTES and one range

        def count(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            yield from Counting(sent.value)(batches)

        counted.append(_texts(docs).mapInArrow(count, "lang string, source string, ordinal long, n long"))
    if not counted:
        return docs.sparkSession.createDataFrame([], "lang string, source string, ordinal long, n long")
    return reduce(DataFrame.unionByName, counted).groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))


def _share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (n + 2) / (total + 2 kept)), exact."""
    above = (n + 2).cast("decimal(20,0)") * F.lit(1_000_000_000).cast("decimal(10,0)")
    below = (total + 2 * kept).cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", above, below)


def _difference(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _compared(frame: pd.DataFrame) -> pd.DataFrame:
    """Differences of the sources of two tiles over the terms of one block."""
    width = int(frame["width"].iat[0])
    low, high = int(frame["tile_a"].iat[0]), int(frame["tile_b"].iat[0])
    shares = np.repeat(frame["rest"].to_numpy(np.int64)[:, None], width, axis=1)
    for row, (at, p) in enumerate(zip(frame["at"], frame["p"])):
        if at is not None and len(at):
            shares[row, np.asarray(at, np.int64)] = np.asarray(p, np.int64)
    sources, tiles = frame["source"].to_numpy(object), frame["tile"].to_numpy()
    out = []
    for i in np.flatnonzero(tiles == low):
        others = np.flatnonzero(tiles == high)
        others = others[others > i] if low == high else others
        if len(others):
            q, p = shares[others], shares[i]
            values = ((p - q) ** 2 // (p + q)).sum(axis=1)
            for j, value in zip(others, values.tolist()):
                out += [(sources[i], sources[j], value), (sources[j], sources[i], value)]
    found = pd.DataFrame(out, columns=["source", "item", "value"])
    return found.assign(lang=frame["lang"].iat[0])


def pair_values(groups: DataFrame, counts: DataFrame) -> DataFrame:
    """``lang, source, item, value``: each group against each other source of its language, over all kept terms.

    Work is cut into blocks of terms and pairs of tiles of sources, so that no task grows with either.
    """
    block = F.floor(F.col("ordinal") / BLOCK).alias("block")
    packed = (
        counts.select("lang", "source", block, F.struct(F.pmod("ordinal", F.lit(BLOCK)).alias("at"), "p").alias("cell"))
        .groupBy("lang", "source", "block").agg(F.collect_list("cell").alias("cells"))
    )
    tiles = groups.groupBy("lang").agg(F.ceil(F.count("*") / TILE).alias("tiles"))
    last = F.greatest(F.floor((F.col("kept") - 1) / BLOCK), F.lit(0))
    spread = (
        groups.join(tiles, "lang")
        .withColumn("tile", F.pmod(F.xxhash64("source"), F.col("tiles")))
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        .withColumn("width", F.least(F.col("kept") - F.col("block") * BLOCK, F.lit(BLOCK)))
        .join(packed, ["lang", "source", "block"], "left")
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
        .select(
            "lang", "source", "block", "tile", "width", "rest", F.least("tile", "other").alias("tile_a"),
            F.greatest("tile", "other").alias("tile_b"), F.col("cells.at").alias("at"), F.col("cells.p").alias("p"),
        )
    )
    compared = spread.groupBy("lang", "block", "tile_a", "tile_b").applyInPandas(
        _compared, "source string, item string, value long, lang string"
    )
    return compared.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def term_values(groups: DataFrame, counts: DataFrame, top: int) -> DataFrame:
    """``lang, source, ordinal, value, rank``: the terms that a group uses more than its language, the ``top`` furthest."""
    totals = groups.groupBy("lang").agg(F.sum("total").alias("all_total"))
    whole = counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("all_n"))
    over = (
        counts.join(whole, ["lang", "ordinal"])
        .join(totals, "lang")
        .withColumn("q", _share(F.col("all_n"), F.col("all_total"), F.col("kept")))
        .filter(F.col("p") > F.col("q"))
        .withColumn("value", _difference(F.col("p"), F.col("q")))
    )
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    ranked = over.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", "source", "ordinal", "value", "rank")


def _spelt(chosen: pd.DataFrame, ranges: pd.DataFrame) -> pd.DataFrame:
    """Ordinals of one range back to terms."""
    if not len(chosen) or not len(ranges):
        return pd.DataFrame([], columns=["lang", "source", "item", "value", "rank"])
    transducer, base = Transducer.load(ranges["packed"].iat[0]), int(ranges["base"].iat[0])
    terms = {o: transducer.term(o - base).decode() for o in set(chosen["ordinal"])}
    return chosen.assign(item=chosen["ordinal"].map(terms))[["lang", "source", "item", "value", "rank"]]


def with_terms(chosen: DataFrame, ranges: DataFrame) -> DataFrame:
    """Rows with ``ordinal``, few of each group, with the term instead, as ``item``."""
    limits = ranges.groupBy("lang").agg(F.sort_array(F.collect_list("base")).alias("bases"))
    # the range of an ordinal is the last one whose base it reaches
    placed = chosen.join(limits, "lang").withColumn("base", F.array_max(F.filter("bases", lambda b: b <= F.col("ordinal"))))
    return (
        placed.drop("bases").groupBy("lang", "base").cogroup(ranges.groupBy("lang", "base"))
        .applyInPandas(_spelt, "lang string, source string, item string, value long, rank int")
    )


def audit(docs: DataFrame, min_docs: int = 10, top: int = 10) -> DataFrame:
    """``lang, source, part, item, value, rank`` over ``text, lang, source``.

    Part ``pair``: value of every other source of the language, all ranks. Part ``term``: the ``top`` terms that the group
    uses more than its language does. Null texts, languages and sources count as empty; the empty language is one like
    any other. A language without kept terms has value 0 for its pairs and no terms; one with a single source has no
    pairs. Equal values rank by item in byte order. Repeated rows are documents of their own. Texts of any length are
    read whole, in portions. An empty table gives no rows; other columns are not read.
    """
    ranges = vocabulary(written(kept_terms(docs, min_docs)))
    ranges = written(ranges)
    counts = written(recount(docs, ranges))
    kept = ranges.groupBy("lang").agg(F.sum("n_terms").alias("kept"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    groups = (
        _texts(docs).select("lang", "source").distinct()
        .join(totals, ["lang", "source"], "left").join(kept, "lang", "left")
        .select("lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("kept", zero).alias("kept"))
        .withColumn("rest", F.when(F.col("kept") > 0, _share(zero, F.col("total"), F.col("kept"))).otherwise(zero))
    )
    groups = written(groups)
    shares = counts.join(groups.drop("rest"), ["lang", "source"]).withColumn(
        "p", _share(F.col("n"), F.col("total"), F.col("kept"))
    )
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_values(groups, shares).withColumn("rank", F.row_number().over(order))
    terms = with_terms(term_values(groups, shares, top), ranges)
    return pairs.withColumn("part", F.lit("pair")).unionByName(terms.withColumn("part", F.lit("term"))).select(
        "lang", "source", "part", "item", "value", "rank"
    )
