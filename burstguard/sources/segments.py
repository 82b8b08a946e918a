"""Exported topic segments as a data source, so that topics can be read and written without a broker.

A topic is a folder: ``segments`` holds Parquet files, each a run of records of one partition, and ``commits`` one small
JSON file per write that names its segments with their partition, first offset and length. Segments that no commit
names are not there yet, so a write appears as a whole or not at all. One job at a time writes a topic. Records carry
what those of a broker do: key, value, topic, partition, offset and record time.

Options: ``path`` (the folder of topics, any file system that Arrow opens), ``topic``; reading a stream
``startingOffsets`` (``earliest`` or ``latest``) and ``maxSegmentRows``, the records of one task; writing ``partitions``
and, for streams, ``writer``, under which a repeated batch is recognised and left out.
"""

from __future__ import annotations

import json
import time
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)

SCHEMA = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp"
_TIME = pa.timestamp("us", "UTC")
_STORED = pa.schema([("key", pa.binary()), ("value", pa.binary()), ("timestamp", _TIME)])
_RECORDS = pa.schema(
    [("key", pa.binary()), ("value", pa.binary()), ("topic", pa.string()), ("partition", pa.int32()), ("offset", pa.int64()),
     ("timestamp", _TIME)]
)
PARTITIONS, SEGMENT_ROWS = 8, 1_000_000


class Topic:
    """The folder of one topic."""

    def __init__(self, options: dict):
        self.name = options["topic"]
        root = options["path"]
        self.files, root = fs.FileSystem.from_uri(root) if ":" in root else (fs.LocalFileSystem(), root)
        self.folder = f"{root.rstrip('/')}/{self.name}"

    def commits(self) -> list[dict]:
        """What was written, in order."""
        listed = self.files.get_file_info(fs.FileSelector(f"{self.folder}/commits", allow_not_found=True))
        names = sorted(f.path for f in listed if f.path.endswith(".json"))
        return [json.loads(self.files.open_input_stream(n).read()) for n in names]

    def segments(self) -> list[dict]:
        return [s for c in self.commits() for s in c["segments"]]

    def ends(self) -> dict[str, int]:
        """The next offset of every partition."""
        out: dict[str, int] = {}
        for s in self.segments():
            key = str(s["partition"])
            out[key] = max(out.get(key, 0), s["base"] + s["count"])
        return out

    def pieces(self, start: dict, end: dict, most: int) -> list[Piece]:
        """Work for one task each: the records between two offsets per partition."""
        out = []
        for s in self.segments():
            key = str(s["partition"])
            low, high = max(s["base"], start.get(key, 0)), min(s["base"] + s["count"], end.get(key, 0))
            for begin in range(low, high, most):
                out.append(Piece(s["partition"], s["file"], s["base"], begin, min(begin + most, high)))
        return out

    def read(self, piece: Piece) -> Iterator[pa.RecordBatch]:
        file = pq.ParquetFile(self.files.open_input_file(f"{self.folder}/segments/{piece.file}"))
        at = piece.base
        for group in range(file.num_row_groups):
            rows = file.metadata.row_group(group).num_rows
            if at + rows > piece.begin and at < piece.end:
                place = at
                for batch in file.iter_batches(8192, row_groups=[group]):
                    low, high = max(piece.begin - place, 0), min(piece.end - place, batch.num_rows)
                    if low < high:
                        yield self._records(batch.slice(low, high - low), piece.partition, place + low)
                    place += batch.num_rows
            at += rows

    def _records(self, batch: pa.RecordBatch, partition: int, offset: int) -> pa.RecordBatch:
        n = batch.num_rows
        arrays = [
            batch["key"], batch["value"], pa.repeat(self.name, n), pa.repeat(pa.scalar(partition, pa.int32()), n),
            pa.array(np.arange(offset, offset + n)), batch["timestamp"],
        ]
        return pa.RecordBatch.from_arrays(arrays, schema=_RECORDS)

    def store(self, batches: Iterator[pa.RecordBatch], partitions: int) -> list[tuple[int, str, int]]:
        """Writes records into segments of their partitions: that in column ``partition``, else by the key, records without
        one in turn. Gives (partition, file, records)."""
        open_: dict[int, tuple[str, pq.ParquetWriter]] = {}
        counts: dict[int, int] = {}
        turn = 0
        self.files.create_dir(f"{self.folder}/segments", recursive=True)
        for batch in batches:
            n = batch.num_rows
            keys, given = ([None] * n if c not in batch.schema.names else batch[c].to_pylist() for c in ("key", "partition"))
            dealt = [
                p if p is not None else (turn + i if k is None else zlib.crc32(_bytes(k))) % partitions
                for i, (k, p) in enumerate(zip(keys, given))
            ]
            turn += n
            rows, places = self._stored(batch), np.array(dealt)
            for partition in sorted(set(dealt)):
                if partition not in open_:
                    file = f"{partition:05d}-{uuid.uuid4().hex}.parquet"
                    sink = self.files.open_output_stream(f"{self.folder}/segments/{file}")
                    open_[partition] = (file, pq.ParquetWriter(sink, _STORED))
                mine = rows.filter(pa.array(places == partition))
                open_[partition][1].write_batch(mine, row_group_size=65_536)
                counts[partition] = counts.get(partition, 0) + mine.num_rows
        for _, writer in open_.values():
            writer.close()
        return [(p, open_[p][0], counts[p]) for p in sorted(open_)]

    def _stored(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        n, names = batch.num_rows, batch.schema.names
        key = batch["key"].cast(pa.binary()) if "key" in names else pa.nulls(n, pa.binary())
        at = batch["timestamp"].cast(_TIME) if "timestamp" in names else pa.nulls(n, _TIME)
        now = pc.cast(pa.scalar(time.time_ns() // 1000, pa.int64()), _TIME)
        return pa.RecordBatch.from_arrays([key, batch["value"].cast(pa.binary()), pc.fill_null(at, now)], schema=_STORED)

    def commit(self, written: list[tuple[int, str, int]], writer: str | None = None, batch: int | None = None) -> None:
        """Gives the segments their offsets and makes them visible, once for a batch of a writer."""
        before = self.commits()
        if writer is not None and any(c.get("writer") == writer and c.get("batch") == batch for c in before):
            return
        ends, segments = self.ends(), []
        for partition, file, count in written:
            base = ends.get(str(partition), 0)
            segments.append({"partition": partition, "base": base, "count": count, "file": file})
            ends[str(partition)] = base + count
        self.files.create_dir(f"{self.folder}/commits", recursive=True)
        with self.files.open_output_stream(f"{self.folder}/commits/{len(before):012d}.json") as out:
            out.write(json.dumps({"writer": writer, "batch": batch, "segments": segments}).encode())


def _bytes(key: str | bytes) -> bytes:
    return key.encode() if isinstance(key, str) else key


@dataclass
class Piece(InputPartition):
    partition: int
    file: str
    base: int
    begin: int
    end: int


@dataclass
class Written(WriterCommitMessage):
    segments: list


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self):
        topic = Topic(self.options)
        return topic.pieces({}, topic.ends(), int(self.options.get("maxSegmentRows", SEGMENT_ROWS)))

    def read(self, partition):
        if partition is not None:  # that of an empty topic
            yield from Topic(self.options).read(partition)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.options = options

    def initialOffset(self) -> dict:
        ends = Topic(self.options).ends()
        return ends if self.options.get("startingOffsets", "latest") == "latest" else {p: 0 for p in ends}

    def latestOffset(self) -> dict:
        return Topic(self.options).ends()

    def partitions(self, start: dict, end: dict):
        return Topic(self.options).pieces(start, end, int(self.options.get("maxSegmentRows", SEGMENT_ROWS)))

    def read(self, partition):
        yield from Topic(self.options).read(partition)


class _Writing:
    def __init__(self, options: dict):
        self.options = options

    def write(self, iterator):
        return Written(Topic(self.options).store(iterator, int(self.options.get("partitions", PARTITIONS))))

    def _segments(self, messages) -> list:
        return [s for m in messages if m is not None for s in m.segments]


class _Writer(_Writing, DataSourceArrowWriter):
    def commit(self, messages) -> None:
        Topic(self.options).commit(self._segments(messages))


class _StreamWriter(_Writing, DataSourceStreamArrowWriter):
    def commit(self, messages, batchId) -> None:
        Topic(self.options).commit(self._segments(messages), self.options.get("writer"), batchId)


class TopicSegments(DataSource):
    """``spark.dataSource.register(TopicSegments)``, then ``format("topic_segments")``."""

    @classmethod
    def name(cls) -> str:
        return "topic_segments"

    def schema(self) -> str:
        return SCHEMA

    def _options(self) -> dict:
        wanted = ("path", "topic", "startingOffsets", "maxSegmentRows", "partitions", "writer")
        return {w: self.options[w] for w in wanted if self.options.get(w) is not None}

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self._options())

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(self._options())

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self._options())

    def streamWriter(self, schema, overwrite: bool) -> _StreamWriter:
        return _StreamWriter(self._options())
