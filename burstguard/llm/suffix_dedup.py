"""Removal of repeated byte strings by suffix arrays of shards.

A position is repeated if the ``length`` bytes from it also start anywhere else in the corpus; every byte that a
repeated string covers is removed. Each such string is named by an anchor, the one of its short substrings with the
least hash, so equal strings have equal anchors. The strings of one document that share an anchor are consecutive: a
segment. Segments are first counted by content. A segment found twice is repeated throughout; an anchor with one
segment needs nothing else. What remains, different segments of a common anchor, goes to shards by anchor. A shard
gets a suffix array by induced sorting and permuted common prefixes, which tell the repeated starts (``suffixes``).

An anchor with very many different segments (a passage embedded in many documents has such anchors at its ends) is
not sorted in one task: its segments are cut into four blocks by how far before the anchor their strings start, and a
part belongs to the hash of the bytes that all strings of its block share. Parts of one content are counted, the others
sorted, or cut again, down to single strings, which counting decides.

Copies of a text are one text here: everything is keyed by text, and the result joined back to documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burstguard.llm.common import written
from burstguard.llm.suffixes import repeated_starts

LENGTH = 400
#: Bytes of an anchor.
ANCHOR = 64
#: Bytes hashed at once; longer texts are cut here, which only cuts segments.
CHUNK = 1 << 20
#: Different segments of an anchor that one task sorts; beyond, they are cut.
SHARD_SEGMENTS = 4096
#: Bytes of segments from which a shard is sorted.
SHARD_BYTES = 2_000_000
#: Texts up to this many are named in a broadcast, to shuffle only their bytes; beyond, all texts are shuffled.
BROADCAST_TEXTS = 1_000_000
MULTIPLIER = 0x9E3779B97F4A7C15 | 1
BODIES = "anchor long, segment long, copies long, back int, cores array<long>, body binary"
PARTS = (
    "anchor long, segment long, copies long, at int, part_anchor long, part_segment long, back int, cores array<long>, "
    "body binary"
)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        up, down = np.full(n, MULTIPLIER, np.uint64), np.full(n, pow(MULTIPLIER, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _POWERS["up"], _POWERS["down"] = np.cumprod(up), np.cumprod(down)
    return _POWERS["up"], _POWERS["down"]


def anchor_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Mixed hashes of all substrings of ``size`` bytes."""
    up, down = _powers(max(len(data), 1 << 16))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    n = len(data) - size + 1
    h = (sums[size:] - sums[:n]) * down[:n]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values, the position of its leftmost least one."""
    best, at, reach = values, np.arange(len(values), dtype=np.int32), 1
    while reach < width:
        step = min(reach, width - reach)
        n = len(best) - step
        later = best[step:] < best[:n]
        at = np.where(later, at[step:], at[:n])
        best = np.where(later, best[step:], best[:n])
        reach += step
    return at


def segments_of(raw: bytes, length: int, anchor: int) -> Iterator[tuple[int, int, int, int]]:
    """(anchor's hash, hash of the content, first start, starts) for every segment of a text."""
    for base in range(0, len(raw) - length + 1, CHUNK):
        part = raw[base : base + CHUNK + length - 1]
        hashes = anchor_hashes(np.frombuffer(part, np.uint8), anchor)
        at = leftmost_least(hashes, length - anchor + 1)
        first = np.flatnonzero(np.diff(at, prepend=-1))
        last = np.append(first[1:], len(at)) - 1
        names = hashes[at[first]].view(np.int64).tolist()
        for h, a, b in zip(names, first.tolist(), last.tolist()):
            yield h, xxhash.xxh3_64_intdigest(part[a : b + length]) - (1 << 63), base + a, b - a + 1


def _occurrences(length: int, anchor: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows: list[tuple] = []
            for text_id, n_bytes, text in zip(frame["text_id"], frame["n_bytes"], frame["text"]):
                if n_bytes >= length:
                    rows += [(text_id, n_bytes, *s) for s in segments_of(text.encode("utf-8", "replace"), length, anchor)]
            yield pd.DataFrame(rows, columns=["text_id", "n_bytes", "anchor", "segment", "start", "starts"])

    return run


def _runs(mask: np.ndarray) -> list[int]:
    """Begins and ends of the true runs, one after the other."""
    return np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))).tolist()


def _sort_shards(length: int):
    """Rows (anchor, segment, copies, body) sorted by anchor; a shard is a number of whole anchors."""

    def solve(rows: list[tuple]) -> pd.DataFrame:
        out = []
        if rows:
            for (anchor, segment, copies, _), mask in zip(rows, repeated_starts([r[3] for r in rows], length)):
                if copies == 1 and mask.any():
                    out.append((anchor, segment, _runs(mask)))
        return pd.DataFrame(out, columns=["anchor", "segment", "runs"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        size = 0
        for frame in frames:
            for row in frame[["anchor", "segment", "copies", "body"]].itertuples(index=False, name=None):
                if size >= SHARD_BYTES and held[-1][0] != row[0]:
                    yield solve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        yield solve(held)

    return run


def _blocks(size: int, back: int, length: int, block: int) -> Iterator[tuple[int, int, int, int, int]]:
    """Blocks of the starts of a body by how far they are before the anchor: number, first and last start, and begin
    and end of the core, the bytes that all strings of such a block share in any body."""
    nearest = back - (size - length)  # distance of the last start
    for k in range(nearest // block, back // block + 1):
        core = back - k * block
        yield k, back - min(back, k * block + block - 1), back - max(nearest, k * block), core, core - block + 1 + length


def _cores(body: bytes, back: int, length: int, block: int) -> list[int]:
    return [
        xxhash.xxh3_64_intdigest(body[a:b], seed=k + 1) - (1 << 63)
        for k, _, _, a, b in _blocks(len(body), back, length, block)
    ]


def _split(length: int, block: int):
    """Cut segments into blocks of their starts; a part's anchor is the hash of its core."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for row in frame[["anchor", "segment", "copies", "back", "body"]].itertuples(index=False, name=None):
                anchor, segment, copies, back, body = row
                for (_, a, b, _, _), core in zip(_blocks(len(body), back, length, block), _cores(body, back, length, block)):
                    part = body[a : b + length]
                    name = xxhash.xxh3_64_intdigest(part) - (1 << 63)
                    cores = _cores(part, back - a, length, -(-block // 4))
                    rows.append((anchor, segment, copies, a, core, name, back - a, cores, part))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in PARTS.split(", ")])

    return run


def different_segments(
    bodies: DataFrame, length: int, starts: int, most: int | None = None
) -> DataFrame:
    """``anchor, segment, runs`` of the repeated starts in rows ``anchor, segment, copies, back, cores, body``, all
    different.

    ``runs`` are begins and ends; only segments of one copy are told, as the others are repeated throughout. ``back``
    is the anchor's place in the body, ``starts`` how many starts a segment has at most, ``cores`` the hashes of the cores
    of four blocks of starts. A segment that shares no core with another one of its anchor has no repeated start.
    """
    most = SHARD_SEGMENTS if most is None else most
    cores = bodies.select("anchor", "segment", "copies", F.explode("cores").alias("core"))
    shared = cores.groupBy("anchor", "core").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    live = written(cores.join(shared, ["anchor", "core"]).select("anchor", "segment", "copies").distinct())
    sizes = live.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.min("copies").alias("least"))
    sized = bodies.join(live.join(sizes.filter("least = 1"), "anchor").select("anchor", "segment", "kinds"), ["anchor", "segment"])
    few = (
        sized.filter(F.col("kinds") <= most)
        .select("anchor", "segment", "copies", "body")
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInPandas(_sort_shards(length), "anchor long, segment long, runs array<int>")
    )
    many = sized.filter(F.col("kinds") > most)
    if many.isEmpty():
        return few
    block = -(-starts // 4)
    parts = written(
        many.select("anchor", "segment", "copies", "back", "body").mapInPandas(
            _split(length, block), PARTS
        )
    )
    key = ["part_anchor", "part_segment"]
    kinds = parts.groupBy(*key).agg(F.sum("copies").alias("copies"))
    by_anchor = kinds.groupBy("part_anchor").agg(F.count(F.lit(1)).alias("kinds"), F.min("copies").alias("least"))
    rest = kinds.join(by_anchor.filter("kinds > 1 and least = 1"), "part_anchor").select(*key, F.col("copies").alias("all"))
    # bodies of one part are equal: any of them will do
    one = (
        parts.join(rest, key)
        .groupBy(F.col("part_anchor").alias("anchor"), F.col("part_segment").alias("segment"))
        .agg(*[F.first(c).alias(n) for c, n in {"all": "copies", "back": "back", "cores": "cores", "body": "body"}.items()])
    )
    sorted_parts = different_segments(written(one), length, block, most).select(
        F.col("anchor").alias("part_anchor"), F.col("segment").alias("part_segment"), "runs"
    )
    links = parts.select("anchor", "segment", "copies", "at", *key, (F.length("body") - length + 1).alias("starts"))
    whole = links.join(kinds.filter("copies > 1").select(*key), key).withColumn(
        "runs", F.array(F.lit(0), F.col("starts").cast("int"))
    )
    some = links.join(sorted_parts, key)
    told = (
        whole.unionByName(some)
        .filter("copies = 1")
        .groupBy("anchor", "segment")
        .agg(F.flatten(F.collect_list(F.transform("runs", lambda x: x + F.col("at")))).alias("runs"))
    )
    return few.unionByName(told)


def _bodies(length: int, anchor: int):
    block = -(-(length - anchor + 1) // 4)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for text, wanted in zip(frame["text"], frame["wanted"]):
                raw = text.encode("utf-8", "replace")
                for w in wanted:
                    body = raw[w["start"] : w["start"] + w["starts"] - 1 + length]
                    hashes = anchor_hashes(np.frombuffer(body[:length], np.uint8), anchor)
                    back = int(hashes.argmin())
                    rows.append((w["anchor"], w["segment"], w["copies"], back, _cores(body, back, length, block), body))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in BODIES.split(", ")])

    return run


def named(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``texts`` whose text is among ``keys``: by a broadcast of a checked size, so that other texts stay
    where they are, else left whole for the join that follows."""
    ids = keys.select("text_id", "n_bytes").distinct()
    if ids.limit(BROADCAST_TEXTS + 1).count() <= BROADCAST_TEXTS:
        return texts.join(F.broadcast(ids), ["text_id", "n_bytes"], "left_semi")
    return texts


def _cover(length: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for text_id, n_bytes, text, found in zip(frame["text_id"], frame["n_bytes"], frame["text"], frame["found"]):
                raw = text.encode("utf-8", "replace")
                edges = np.zeros(len(raw) + 1, np.int64)
                for start, runs in ((f["start"], f["runs"]) for f in found):
                    for a, b in zip(runs[::2], runs[1::2]):
                        edges[start + a] += 1
                        edges[start + b - 1 + length] -= 1
                gone = np.cumsum(edges[:-1]) > 0
                spans = _runs(gone)
                kept, at = [], 0
                for a, b in zip(spans[::2], spans[1::2]):
                    kept.append(raw[at:a])
                    at = b
                left = b"".join([*kept, raw[at:]])
                rows.append(
                    (text_id, n_bytes, int(gone.sum()), spans, hashlib.sha256(left).hexdigest(), left.decode("utf-8", "ignore"))
                )
            yield pd.DataFrame(rows, columns=["text_id", "n_bytes", "n_removed", "spans", "kept_sha256", "kept_text"])

    return run


def text_keys(text: str = "text") -> dict[str, Column]:
    """The columns that name a text: a hash and its bytes; a null text is the empty one."""
    body = F.coalesce(F.col(text), F.lit(""))
    return {"text_id": F.xxhash64(body), "n_bytes": F.octet_length(body)}


def repeated_spans(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """One row per different text of ``docs`` that loses bytes: ``text_id, n_bytes`` (see ``text_keys``),
    ``n_removed, spans`` (begins and ends), ``kept_sha256, kept_text``.

    Strings are judged on the input and may overlap, also themselves. Null texts are empty and lose nothing. A
    repeated row repeats all strings of its text. A cut inside a character leaves bytes that are no text: the hash is of
    the bytes, the text leaves out such halves. Ids and extra columns are not read; an empty table gives an empty one.
    """
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text")).select(
        *[c.alias(n) for n, c in text_keys().items()], "text"
    )
    texts = texts.filter(F.col("n_bytes") >= length)
    place = ["text_id", "n_bytes", "anchor", "segment", "start", "starts"]
    occurrences = written(
        texts.mapInPandas(
            _occurrences(length, anchor),
            "text_id long, n_bytes int, anchor long, segment long, start long, starts int",
        )
        .groupBy(*place)
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    kinds = occurrences.groupBy("anchor", "segment").agg(
        F.sum("copies").alias("copies"), F.min(F.struct("text_id", "n_bytes", "start", "starts")).alias("at")
    )
    kinds = written(kinds)
    mixed = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.min("copies").alias("least"))
    mixed = mixed.filter("kinds > 1 and least = 1").select("anchor")
    wanted = written(
        kinds.join(mixed, "anchor")
        .groupBy("at.text_id", "at.n_bytes")
        .agg(F.collect_list(F.struct("anchor", "segment", "copies", "at.start", "at.starts")).alias("wanted"))
    )
    bodies = written(
        named(texts, wanted)
        .dropDuplicates(["text_id", "n_bytes"])
        .join(wanted, ["text_id", "n_bytes"])
        .select("text", "wanted")
        .mapInPandas(_bodies(length, anchor), BODIES)
    )
    sorted_segments = different_segments(bodies, length, length - anchor + 1)
    twice = kinds.filter("copies > 1").select("anchor", "segment", F.lit(None).cast("array<int>").alias("runs"))
    hits = twice.unionByName(sorted_segments)
    found = written(
        occurrences.join(hits, ["anchor", "segment"])
        .withColumn("runs", F.coalesce("runs", F.array(F.lit(0), F.col("starts"))))
        .groupBy("text_id", "n_bytes")
        .agg(F.collect_list(F.struct("start", "runs")).alias("found"))
    )
    return (
        named(texts, found)
        .dropDuplicates(["text_id", "n_bytes"])
        .join(found, ["text_id", "n_bytes"])
        .mapInPandas(
            _cover(length),
            "text_id long, n_bytes int, n_removed long, spans array<int>, kept_sha256 string, kept_text string",
        )
    )


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with every repeated string of ``length`` bytes cut out of ``text``; other columns pass through.

    Empty and null texts stay as they are; a text that is repeated throughout becomes empty.
    """
    keyed = docs.select(F.struct("*").alias("row"), *[c.alias(n) for n, c in text_keys().items()])
    found = repeated_spans(docs, length).select("text_id", "n_bytes", "kept_text")
    text = F.coalesce("kept_text", "row.text").alias("text")
    return keyed.join(found, ["text_id", "n_bytes"], "left").select(
        *[text if c == "text" else F.col(f"row.{c}").alias(c) for c in docs.columns]
    )
