"""SimHash near-duplicates: fingerprints, pigeonring filtering, components.

The 64 bits form a ring of four segments. If two fingerprints differ in at most three bits, some chain of consecutive
segments that starts at ``i`` keeps within its share of the budget at every length: no difference in segment ``i``, at
most one in two segments, two in three, three in all. So segment ``i`` and one half of the next are equal, and 24-bit
buckets of (chain, segment, half) hold every linked pair. Inside a bucket the chain's prefixes are checked in turn
before the full Hamming distance. A bucket is a bit mask and the bits under it; one with too many fingerprints is dealt
again under four finer masks, each adding a quarter of its free bits, of which at least one quarter is equal in any
linked pair. All work is on distinct fingerprints, so copies cost nothing, and a bucket gives a spanning forest of its
links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from burstguard.llm.common import row_key, written
from burstguard.llm.components import components

BITS = 64
SEGMENTS = 4
BUDGET = 3
SHINGLE = 3
SEED = 42
#: Largest bucket compared in one task.
BUCKET_ROWS = 4096
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    words = text.encode("utf-8", "replace").translate(LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    digest = xxhash.xxh64_digest
    if len(words) <= shingle:
        held = digest(line, seed)
        n = 1
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        n = len(words) - shingle + 1
        starts = [0, *ends[: n - 1].tolist()]
        held = b"".join([digest(line[a:b], seed) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist())])
    counts = np.zeros(BITS, np.int64)
    octets = np.frombuffer(held, np.uint8).reshape(n, 8)
    for at in range(0, n, 8192):
        counts += np.unpackbits(octets[at : at + 8192], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with ``fp`` (long) in place of ``text``. Null and blank texts have fingerprint zero."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t or "", shingle) for t in texts], dtype="int64")

    return docs.withColumn("fp", of("text")).drop("text")


def chain_masks() -> list[tuple[int, int]]:
    """(mask, chain start) of the first buckets: a whole segment and one half of the next on the ring."""
    width = BITS // SEGMENTS
    out = []
    for i in range(SEGMENTS):
        first = ((1 << width) - 1) << (BITS - width * (i + 1))
        at = BITS - width * ((i + 1) % SEGMENTS + 1)
        for half in range(2):
            out.append((first | ((1 << width // 2) - 1) << (at + half * width // 2), i))
    return out


def finer(mask: int) -> list[int]:
    """Four masks that each add a quarter of the free bits."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    return [mask | sum(1 << b for b in free[q :: BUDGET + 1]) for q in range(BUDGET + 1)]


def signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _chain_limits(start: int) -> list[tuple[np.uint64, int]]:
    """Bits of the chain's first segments, and how many of them may differ."""
    width, held, out = BITS // SEGMENTS, 0, []
    for length in range(1, SEGMENTS + 1):
        held |= ((1 << width) - 1) << (BITS - width * ((start + length - 1) % SEGMENTS + 1))
        out.append((np.uint64(held), length * BUDGET // SEGMENTS))
    return out


def linked(values: np.ndarray, start: int) -> Iterator[tuple[int, int]]:
    """A spanning forest, as index pairs, of the links in one bucket of a chain."""
    parent = list(range(len(values)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    limits = _chain_limits(start)
    for i in range(len(values) - 1):
        rest = np.arange(i + 1, len(values))
        differing = values[i + 1 :] ^ values[i]
        for bits, most in limits:
            keep = np.bitwise_count(differing & bits) <= most
            rest, differing = rest[keep], differing[keep]
            if not len(rest):
                break
        for j in rest.tolist():
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                yield i, j


def _links_of_buckets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (chain, mask, bits, fp), sorted by the first three; a bucket may go on in the next frame."""
    key = ["chain", "mask", "bits"]
    held: list[pd.DataFrame] = []

    def links(frame: pd.DataFrame) -> Iterator[tuple[int, int]]:
        values = frame["fp"].to_numpy(np.int64).view(np.uint64)
        changed = np.flatnonzero((np.diff(frame[key].to_numpy(np.int64), axis=0) != 0).any(axis=1)) + 1
        cuts = [0, *changed.tolist(), len(frame)]
        for a, b in zip(cuts, cuts[1:]):
            if b - a > 1:
                some = values[a:b]
                for i, j in linked(some, int(frame["chain"].iat[a])):
                    yield int(some[i].view(np.int64)), int(some[j].view(np.int64))

    def out(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(list(links(frame)), columns=["a", "b"], dtype="int64")

    for frame in frames:
        if not len(frame):
            continue
        last = frame[key].iloc[-1]
        tail = (frame[key] == last).all(axis=1).to_numpy()
        cut = len(frame) - int(tail.sum())
        if cut:
            yield out(pd.concat([*held, frame.iloc[:cut]], ignore_index=True))
            held = [frame.iloc[cut:]]
        elif held and not (held[-1][key].iloc[-1] == last).all():
            yield out(pd.concat(held, ignore_index=True))
            held = [frame]
        else:
            held.append(frame)
    if held:
        yield out(pd.concat(held, ignore_index=True))


def fingerprint_links(distinct: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Edges ``a, b`` that connect all distinct fingerprints ``fp`` linked at three or fewer differing bits."""
    spark = distinct.sparkSession
    masks = F.array(*[F.struct(F.lit(signed(m)).alias("mask"), F.lit(c).alias("chain")) for m, c in chain_masks()])
    rows = distinct.select("fp", F.explode(masks).alias("m")).select("fp", "m.mask", "m.chain")
    known = sorted({m for m, _ in chain_masks()})
    found = None
    while True:
        rows = rows.withColumn("bits", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = rows.groupBy("chain", "mask", "bits").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        # few buckets hold two or more: rows of the others end here
        rows = written(rows.join(sizes, ["chain", "mask", "bits"]))
        small = rows.filter(F.col("n") <= bucket_rows).drop("n")
        links = (
            small.repartition("chain", "mask", "bits")
            .sortWithinPartitions("chain", "mask", "bits", "fp")
            .select("chain", "mask", "bits", "fp")
            .mapInPandas(_links_of_buckets, "a long, b long")
        )
        found = links if found is None else found.unionByName(links)
        large = rows.filter(F.col("n") > bucket_rows)
        if large.isEmpty():
            return found
        # four rows for each mask so far: a small table, whatever the number of fingerprints
        pairs = [(signed(m), signed(f)) for m in known for f in finer(m)]
        known = sorted({f for m in known for f in finer(m)})
        children = F.broadcast(spark.createDataFrame(pairs, "mask long, finer long"))
        rows = large.join(children, "mask").select("fp", F.col("finer").alias("mask"), "chain").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``doc_id, text``.

    A component is what is reachable over links of three or fewer differing bits; its id is the smallest doc_id in it
    (null only if all its ids are null). Texts of fewer than three words are one shingle; null and blank ones have
    fingerprint zero and link like any other. Repeated rows share a fingerprint and so a component. An empty table
    gives no rows; other columns are not read.
    """
    marked = written(fingerprints(docs.select("doc_id", "text"), shingle))
    return with_components(marked)


def with_components(marked: DataFrame) -> DataFrame:
    """Add ``root`` (a fingerprint) and ``component_id`` to rows that have ``doc_id`` and ``fp``."""
    classes = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(fingerprint_links(classes.select("fp")))
    placed = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    ids = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(placed.join(ids, "root").select("fp", "root", "component_id"), "fp")


def one_per_component(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` of which each component keeps one: the smallest doc_id (a null one last), then text.

    Representatives are chosen on ids alone; texts are only joined to the keys that stay. Repeated rows share a key, so
    the last step keeps one of each. Extra columns pass through.
    """
    marked = written(fingerprints(docs.select("doc_id", row_key().alias("row"), "text"), shingle))
    chosen = (
        with_components(marked)
        .groupBy("root")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("first"))
        .select(F.col("first.row").alias("__row"))
    )
    copies = W.partitionBy("__row").orderBy("__row")
    kept = docs.withColumn("__row", row_key()).join(chosen, "__row", "left_semi")
    return kept.withColumn("__copy", F.row_number().over(copies)).filter("__copy = 1").select(*docs.columns)
