"""Packing token sequences with bounded space.

Every partition packs its documents as they come, with a fixed number of open windows. A document longer than a window
first fills whole windows; what is left goes to the open window with the smallest gap that takes it. If none does and
no more may be opened, the fullest window is topped up with the head of the piece and emitted, so that windows leave a
partition full. At a partition's end its few open windows are emitted unfilled and marked; these leftovers are merged
whole, best fit, over groups of partitions.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from burstguard.llm.bpe import byte_letters
from burstguard.llm.common import written

WINDOW = 1024
OPEN = 8
END_ID = 0
#: Partitions whose leftovers are merged together: at most ``OPEN`` windows each.
MERGED_PARTITIONS = 128
#: Ids are handed on in batches of about so many bytes.
BATCH_BYTES = 8_000_000
#: Characters outside the Latin blocks and common dashes, quotes and dots.
OTHER_SCRIPT = re.compile("[^\x00-\u024f\u2010-\u2027]")
#: How byte-level files of this type split a text before merging: a fixed value of the format.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, open boolean"
)


class Encoder:
    """Ids of whole texts, as the tokenizers library gives them for a byte-level BPE file.

    Texts in Latin letters are encoded by tiktoken from the same file's vocabulary, which is several times faster; it
    gives the same ids where every merge makes the next id, which is checked. Other scripts, for which the two libraries
    could know different Unicode tables, and written special tokens go to the library that the file belongs to.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.ordinary = self.by_ranks(path)

    @staticmethod
    def by_ranks(path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocabulary = spec["model"]["vocab"]
        byte = {c: b for b, c in enumerate(byte_letters())}
        merges = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        if any(vocabulary.get("".join(m)) != 256 + i for i, m in enumerate(merges)):
            return None
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(byte[c] for c in t): i for t, i in vocabulary.items() if t not in special}
        return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids."""
        if self.ordinary and "<|" not in text and (text.isascii() or not OTHER_SCRIPT.search(text)):
            ids = self.ordinary(text)
        else:
            ids = self.library.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, "<u4").tobytes()


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class OpenWindows:
    """At most ``limit`` open windows of ``capacity`` ids; each holds its placed pieces until it is emitted."""

    def __init__(self, capacity: int, limit: int, first_id: int):
        self.capacity, self.limit, self.next_id = capacity, limit, first_id
        self.windows: list[list] = []  # [fill, pieces]

    def place(self, doc_id, ids: bytes) -> Iterator[tuple]:
        """Cut and place one document; yields the pieces of every window that is emitted."""
        total = len(ids) // 4
        at = 0
        while at < total:
            left = total - at
            if left >= self.capacity:
                piece = (doc_id, at, self.capacity, ids[4 * at : 4 * (at + self.capacity)], total)
                yield from self.emit([self.capacity, [piece]])
                at += self.capacity
                continue
            fits = [w for w in self.windows if self.capacity - w[0] >= left]
            if fits:
                window, taken = max(fits, key=lambda w: w[0]), left
            elif len(self.windows) < self.limit:
                window, taken = [0, []], left
                self.windows.append(window)
            else:
                window = max(self.windows, key=lambda w: w[0])
                taken = self.capacity - window[0]
            window[1].append((doc_id, at, taken, ids[4 * at : 4 * (at + taken)], total))
            window[0] += taken
            at += taken
            if window[0] == self.capacity:
                self.windows.remove(window)
                yield from self.emit(window)

    def emit(self, window: list, unfilled: bool = False) -> Iterator[tuple]:
        offset = 0
        for piece in window[1]:
            yield (*piece, self.next_id, offset, unfilled)
            offset += piece[2]
        self.next_id += 1

    def rest(self) -> Iterator[tuple]:
        for window in self.windows:
            yield from self.emit(window, unfilled=True)
        self.windows = []


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
    columns = zip(*rows) if rows else [[] for _ in kinds]
    names = [c.split()[0] for c in PIECES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def merge_leftovers(fills: list[tuple[int, int]], capacity: int) -> list[tuple[int, int, int]]:
    """(window, new window, shift) of whole unfilled windows (window, fill): largest first into the smallest gap."""
    bins: list[list[int]] = []  # [fill, id]
    out = []
    for window, fill in sorted(fills, key=lambda f: (-f[1], f[0])):
        fits = [b for b in bins if capacity - b[0] >= fill]
        if fits:
            best = max(fits)
        else:
            best = [0, window]
            bins.append(best)
        out.append((window, best[1], best[0]))
        best[0] += fill
    return out


def pack(
    docs: DataFrame, path: str, capacity: int = WINDOW, open_windows: int = OPEN, end_id: int | None = END_ID
) -> DataFrame:
    """Pack all rows of ``doc_id, text`` into sequences; one row for each piece, with its ids as 32-bit integers.

    A null text is empty: its document is the end id alone (none at all if ``end_id`` is None, and then no piece).
    Repeated rows and null ids are documents of their own. An empty table gives no pieces. Other columns are not read.
    The packing is written once, so a lost executor never mixes two attempts of a partition.
    """
    end = b"" if end_id is None else np.asarray([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = OpenWindows(capacity, open_windows, TaskContext.get().partitionId() << 40)
        machine = encoder(path)
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = machine.encode(text.as_py() or "") + end
                rows += windows.place(doc_id, ids)
                size += len(ids)
                if size > BATCH_BYTES:
                    yield _table(rows)
                    rows, size = [], 0
        yield _table(rows)
        yield _table(list(windows.rest()))

    pieces = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES))
    group = F.shiftright("sequence_id", 40 + MERGED_PARTITIONS.bit_length() - 1)

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        moved = merge_leftovers(list(zip(frame["sequence_id"], frame["fill"])), capacity)
        return pd.DataFrame(moved, columns=["sequence_id", "merged_id", "shift"])

    left = pieces.filter("open")
    moved = (
        left.groupBy("sequence_id")
        .agg(F.sum("length").alias("fill"))
        .groupBy(group.alias("group"))
        .applyInPandas(merge, "sequence_id long, merged_id long, shift long")
    )
    merged = left.join(moved, "sequence_id").select(
        "doc_id", "start", "length", "ids", "doc_tokens", F.col("merged_id").alias("sequence_id"),
        (F.col("offset") + F.col("shift")).alias("offset"),
    )
    return pieces.filter("not open").drop("open").unionByName(merged)
