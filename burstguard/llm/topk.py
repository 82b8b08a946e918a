"""Exact top-k search by an impact-ordered index, score at a time.

Vectors are dealt into blocks. A block's index holds, for each dimension and sign, posting segments: the rows whose
component falls into one quantised impact level, with their components. A query takes the segments one after the other in
descending order of its own component times the segment's largest one. A row's score is then what it has gathered plus,
for each dimension it was not yet seen in, at most the next impact. The scan stops once that proves for all but a few rows
that they stay below the query's floor, a score that k of its candidates are known to reach; those few are rescored
exactly on whole vectors. The first block of the table gives each query its floor for all others.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from burstguard.llm.common import written

BLOCK = 16_384
QUERY_BLOCK = 512
LEVELS = 4
#: Rows that are rescored at once: when no more can be members, the scan of the segments ends.
POSSIBLE = 2048
#: Segments between two looks at what is still possible.
STRIDE = 32
INDEX = (
    "block int, n int, dims int, vec_ids binary, uids binary, matrix binary, seg_dim binary, "
    "seg_low binary, seg_high binary, seg_start binary, seg_rows binary, seg_values binary"
)


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id, values``: floor(scale * x) of each component; rows with a null or non-finite component are left out."""
    finite = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))),
    )
    return vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("values"),
    )


def matrix_of(values: pd.Series) -> np.ndarray:
    """Rows of one length; missing components count as zero."""
    dims = max((len(v) for v in values), default=0)
    out = np.zeros((len(values), dims), np.int64)
    for i, v in enumerate(values):
        out[i, : len(v)] = v
    return out


def segments(matrix: np.ndarray) -> dict[str, np.ndarray]:
    """Posting segments of a block: dimension, smallest and largest component, rows and their components; zero components
    post nothing."""
    n, dims = matrix.shape
    size = np.abs(matrix)
    top = np.maximum(size.max(axis=0, initial=0), 1)
    level = np.minimum(size * LEVELS // top, LEVELS - 1) + np.where(matrix < 0, LEVELS, 0)
    key = (np.arange(dims) * 2 * LEVELS + level).T.ravel()  # by dimension, then row
    rows = np.tile(np.arange(n), dims)
    flat = matrix.T.ravel()
    used = flat != 0
    key, rows, flat = key[used], rows[used], flat[used]
    order = np.argsort(key, kind="stable")
    key, rows, flat = key[order], rows[order], flat[order]
    start = np.flatnonzero(np.diff(key, prepend=-1))
    low = np.minimum.reduceat(flat, start) if len(start) else flat
    high = np.maximum.reduceat(flat, start) if len(start) else flat
    return {
        "dim": key[start] // (2 * LEVELS), "low": low, "high": high, "start": np.append(start, len(key)), "rows": rows,
        "values": flat,
    }


class Block:
    """The index of one block, ready to search."""

    def __init__(self, matrix: np.ndarray, seg: dict[str, np.ndarray]):
        self.matrix, self.seg = matrix, seg
        self.starts = seg["start"].tolist()
        self.read = 0  # postings taken so far
        # how far a score of this block can go decides whether one number can hold it and the count of dimensions
        self.reach = np.abs(matrix).max(axis=0, initial=0)

    def possible(self, query: np.ndarray, floor: int | None) -> np.ndarray:
        """The rows that may score ``floor`` or more; all others are proved to score less."""
        n, seg = len(self.matrix), self.seg
        weight = query[seg["dim"]]
        most = np.maximum(weight * seg["low"], weight * seg["high"])
        impact = np.maximum(np.abs(weight * seg["low"]), np.abs(weight * seg["high"]))
        order = np.argsort(-impact, kind="stable")
        order = order[: np.count_nonzero(impact)]
        # the best a row can still get in a dimension: the largest score of the segments to come
        ahead = np.maximum(np.maximum.accumulate(most[order][::-1])[::-1], 0)
        used = np.count_nonzero(query)
        shift = int(np.abs(query) @ self.reach).bit_length() + 2
        unit = 1 << shift
        if floor is None or unit * (used + 1) >= 1 << 62:
            return np.arange(n)
        # gathered score and, in whole units above it, the number of dimensions a row was seen in
        gathered = np.zeros(n, np.int64)
        rows, values, starts = seg["rows"], seg["values"], self.starts
        for done, s in enumerate(order.tolist(), 1):
            part = slice(starts[s], starts[s + 1])
            gathered[rows[part]] += values[part] * weight[s] + unit
            self.read += starts[s + 1] - starts[s]
            if done % STRIDE and done < len(order):
                continue
            seen = (gathered + (unit >> 1)) >> shift
            bound = gathered - (seen << shift) + (used - seen) * (ahead[done] if done < len(order) else 0)
            members = np.flatnonzero(bound >= floor)
            if len(members) <= POSSIBLE:
                return members
        return members if len(order) else np.arange(n)[: n if floor <= 0 else 0]

    def best(self, query: np.ndarray, other: np.ndarray, k: int, floor: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Rows (a mask says which may be taken) and scores that hold the k best, of those that reach ``floor``."""
        if floor is None:  # k scores, taken exactly, are a floor
            first = np.flatnonzero(other)[: 16 * k]
            scores = self.matrix[first] @ query
            floor = int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else None
        found = self.possible(query, floor)
        found = found[other[found]]
        return found, self.matrix[found] @ query


def build_index(candidates: DataFrame) -> DataFrame:
    """One row per ``block`` of ``vec_id, uid, values``."""

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        matrix = matrix_of(frame["values"])
        seg = segments(matrix)
        small = np.int32 if np.abs(matrix).max(initial=0) < 2**31 else np.int64
        row = {
            "n": len(matrix),
            "dims": matrix.shape[1],
            "vec_ids": frame["vec_id"].to_numpy(np.int64).tobytes(),
            "uids": frame["uid"].to_numpy(np.int64).tobytes(),
            "matrix": np.array([matrix.astype(small).itemsize], np.int8).tobytes() + matrix.astype(small).tobytes(),
            "seg_dim": seg["dim"].astype(np.int32).tobytes(),
            "seg_low": seg["low"].astype(np.int64).tobytes(),
            "seg_high": seg["high"].astype(np.int64).tobytes(),
            "seg_start": seg["start"].astype(np.int64).tobytes(),
            "seg_rows": seg["rows"].astype(np.int32).tobytes(),
            "seg_values": seg["values"].astype(small).tobytes(),
        }
        return pd.DataFrame([{"block": int(frame["block"].iat[0])} | row])

    return candidates.groupBy("block").applyInPandas(build, INDEX)


FOUND = "query_id long, uid long, vec_id long, score long"


def _search(k: int):
    def search(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(index) and len(queries):
            row = index.iloc[0]
            n, dims = int(row["n"]), int(row["dims"])
            kind = np.int32 if row["matrix"][0] == 4 else np.int64
            matrix = np.frombuffer(row["matrix"], kind, offset=1).reshape(n, dims).astype(np.int64)
            vec_ids, uids = np.frombuffer(row["vec_ids"], np.int64), np.frombuffer(row["uids"], np.int64)
            seg = {x: np.frombuffer(row[f"seg_{x}"], np.int64) for x in ("low", "high", "start")}
            seg |= {x: np.frombuffer(row[f"seg_{x}"], np.int32) for x in ("dim", "rows")}
            block = Block(matrix, seg | {"values": np.frombuffer(row["seg_values"], kind).astype(np.int64)})
            for query_id, uid, values, floor in zip(*(queries[c] for c in ("vec_id", "uid", "values", "floor"))):
                query = np.zeros(dims, np.int64)
                query[: len(values)] = values[:dims]
                found, scores = block.best(query, uids != uid, k, None if pd.isna(floor) else int(floor))
                top = np.lexsort((vec_ids[found], -scores))[:k]
                out += [(query_id, uid, int(vec_ids[found[t]]), int(scores[t])) for t in top]
        return pd.DataFrame(out, columns=["query_id", "uid", "vec_id", "score"])

    return search


def _searched(index: DataFrame, queries: DataFrame, query_blocks: int, k: int) -> DataFrame:
    """Every block of queries meets every block of the index once."""
    met = index.withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    return (
        met.groupBy("block", "q_block").cogroup(queries.groupBy("block", "q_block")).applyInPandas(_search(k), FOUND)
    )


def top_k(vectors: DataFrame, queries: str, k: int = 5, scale: int = 256) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k highest integer inner products of every row of ``vec_id, embedding``
    that satisfies the SQL condition ``queries``, against all other rows; ties go to the smaller vec_id.

    Rows with a null vec_id, a null vector or a null or non-finite component take no part. Vectors of different
    lengths are compared as if the shorter ended in zeros. A repeated row is a row of its own: it is a candidate for
    its twin, and as a query gives its own k rows. Fewer than k candidates give fewer rows; an empty table none.
    """
    rows = written(quantised(vectors, scale).withColumn("uid", F.monotonically_increasing_id()))
    blocks = max(1, -(-rows.count() // BLOCK))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(blocks)).cast("int"))
    asked = rows.filter(queries)
    query_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    asked = asked.withColumn("q_block", F.pmod(F.xxhash64("uid", F.lit(1)), F.lit(query_blocks)).cast("int"))
    index = written(build_index(dealt))
    order = W.partitionBy("query_id", "uid").orderBy(F.desc("score"), "vec_id")
    none = F.lit(None).cast("long")
    first = written(_searched(index.filter("block = 0"), asked.withColumns({"block": F.lit(0), "floor": none}), query_blocks, k))
    found = first
    if blocks > 1:
        # k scores of a query are its floor; a query with fewer has none yet
        floors = first.groupBy("uid").agg(F.count("*").alias("n"), F.min("score").alias("low"))
        floored = asked.join(floors, "uid", "left").withColumn("floor", F.when(F.col("n") >= k, F.col("low")))
        spread = floored.withColumn("block", F.explode(F.sequence(F.lit(1), F.lit(blocks - 1)))).select(
            "vec_id", "uid", "values", "q_block", "block", "floor"
        )
        found = found.unionByName(_searched(index.filter("block > 0"), spread, query_blocks, k))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
