"""Centroid clustering of integer vectors with scalar lookup tables.

Vectors are packed once into blocks: for each dimension the integer values that occur in the block and a matrix of codes
that say which of them a vector has. In every round a task tabulates, for each dimension, occurring value and centroid,
their squared difference; the distances of a whole block are then gathers from these tables and sums. Only the centroids
(k times the dimensions) and their sums pass through the driver; blocks stay in the shared folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstguard.llm.common import written

#: Vectors of a block. Bounds the values of a dimension, and with them the tables: dims * BLOCK * k entries.
BLOCK = 4096
#: Components from here on would let a squared distance of 64 dimensions leave a long.
LARGEST = 1 << 27
BLOCKS = "vec_ids array<long>, codes binary, n_levels array<int>, levels binary"
RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def integer_vectors(vectors: DataFrame, dims: int = 64, scale: int = 256) -> DataFrame:
    """``vec_id, values``: floor(scale * x) of each component of the vectors with exactly ``dims`` finite components."""
    fits = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(LARGEST / scale)),
    )
    usable = F.coalesce((F.size("embedding") == dims) & fits, F.lit(False))
    return vectors.filter(usable).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("values"),
    )


def first_centroids(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """Values of the k vectors with the smallest SHA-256 of ``<seed>:<vec_id>``, in that order; a null id is no text."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    drawn = vectors.select(F.sha2(named, 256).alias("draw"), "values").orderBy("draw", "values").limit(k)
    return [row["values"] for row in drawn.collect()]


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in batches:
        for begin in range(0, len(frame), BLOCK):
            part = frame.iloc[begin : begin + BLOCK]
            matrix = np.stack(part["values"].to_numpy()).astype(np.int64)
            columns = [np.unique(column, return_inverse=True) for column in matrix.T]
            ids = [None if pd.isna(i) else int(i) for i in part["vec_id"].astype(object)]
            yield pd.DataFrame(
                {
                    "vec_ids": [ids],
                    "codes": [np.stack([codes for _, codes in columns]).astype(np.uint16).tobytes()],
                    "n_levels": [[len(levels) for levels, _ in columns]],
                    "levels": [np.concatenate([levels for levels, _ in columns]).tobytes()],
                }
            )


class Block:
    """The vectors of one row of ``BLOCKS``."""

    def __init__(self, row):
        self.vec_ids = row.vec_ids
        sizes = np.asarray(row.n_levels)
        self.codes = np.frombuffer(row.codes, np.uint16).reshape(len(sizes), len(row.vec_ids))
        self.levels = np.split(np.frombuffer(row.levels, np.int64), np.cumsum(sizes)[:-1])

    def values(self) -> np.ndarray:
        return np.stack([levels[codes] for levels, codes in zip(self.levels, self.codes)], axis=1)

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of every vector's nearest centroid, the smaller number among equals."""
        total = np.zeros((len(self.vec_ids), len(centroids)), np.int64)
        for levels, codes, column in zip(self.levels, self.codes, centroids.T):
            table = (levels[:, None] - column) ** 2
            total += table[codes]
        chosen = total.argmin(axis=1)
        return chosen, total[np.arange(len(total)), chosen]


def _summed(centroids: np.ndarray):
    """Per task and centroid: how many vectors are nearest to it, and the sums of their components."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, counts = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
        for frame in batches:
            for row in frame.itertuples(index=False):
                block = Block(row)
                chosen, _ = block.nearest(centroids)
                order = np.argsort(chosen, kind="stable")
                used, starts, n = np.unique(chosen[order], return_index=True, return_counts=True)
                sums[used] += np.add.reduceat(block.values()[order], starts)
                counts[used] += n
        used = np.flatnonzero(counts)
        if len(used):
            yield pd.DataFrame({"cluster": used.astype(np.int32), "n": counts[used], "sums": list(sums[used])})

    return work


def _assigned(centroids: np.ndarray):
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for row in frame.itertuples(index=False):
                block = Block(row)
                chosen, distance = block.nearest(centroids)
                ids = pd.array([None if pd.isna(i) else int(i) for i in block.vec_ids], "Int64")
                yield pd.DataFrame({"vec_id": ids, "cluster": chosen.astype(np.int32), "distance": distance})

    return work


def next_centroids(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every centroid that has vectors becomes the floor of their mean, component by component."""
    partial = blocks.mapInPandas(_summed(centroids), "cluster int, n long, sums array<long>")
    exact = [F.sum(F.col("sums")[d].cast("decimal(38,0)")).alias(f"d{d}") for d in range(centroids.shape[1])]
    moved = centroids.copy()
    for row in partial.groupBy("cluster").agg(F.sum("n").alias("n"), *exact).collect():
        moved[row["cluster"]] = [int(row[f"d{d}"]) // row["n"] for d in range(centroids.shape[1])]
    return moved


def clustered(
    vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: int = 2
) -> tuple[DataFrame, list[list[int]]]:
    """Rows ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` and the final centroids.

    Vectors that are null, have another number of components, or one that is null, not finite or of a size of 2^27 and
    more after scaling (a squared distance would no longer be a long) take no part. Fewer than ``k`` vectors give fewer
    centroids, none give no rows. Repeated rows count each; among equal draws the smaller values come first. A null
    vec_id is drawn by an empty id and stays null. Other columns are not read.
    """
    spark = vectors.sparkSession
    usable = integer_vectors(vectors, dims, scale)
    start = first_centroids(usable, k, seed)
    if not start:
        return spark.createDataFrame([], RESULT), []
    centroids = np.array(start, np.int64)
    blocks = written(usable.mapInPandas(_packed, BLOCKS))
    for _ in range(rounds):
        centroids = next_centroids(blocks, centroids)
    rows = written(blocks.mapInPandas(_assigned(centroids), "vec_id long, cluster int, distance long"))
    sums = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()
    inertia = sum(int(row["d"]) for row in sums)
    final = centroids.tolist()
    facts = [
        (row["cluster"], int(row["d"]), inertia, hashlib.sha256(",".join(map(str, final[row["cluster"]])).encode()).hexdigest())
        for row in sums
    ]
    # one row per centroid: k is a parameter
    named = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(named), "cluster").select(*[c.split(" ")[0] for c in RESULT.split(", ")]), final
