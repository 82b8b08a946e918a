"""Large files that hold one JSON array, read by several tasks.

Spark cuts such a file after closing braces, at any byte range. Whether a range begins inside a string, and how deep in
the nesting, follows from the ranges before it: each range first says what it makes of either start (outside or inside a
string), these small facts are followed along the file, and each range is then cut at the commas between elements. What
lies before its first and after its last comma is joined with its neighbours. Signs are found in whole arrays of bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FACTS = "_file string, _block long, outEnds boolean, outDepth long, inEnds boolean, inDepth long"
_STARTS = "_file string, _block long, inString boolean, depth long"
_PARTS = "_file string, _block long, part int, value string"

_QUOTE, _BACKSLASH, _COMMA, _OPEN, _CLOSE = (ord(c) for c in '"\\,[]')
_BLANKS = b" \t\r\n"
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in '"[]{},']] = True
_DEPTH = np.zeros(256, np.int64)
_DEPTH[[ord(c) for c in "[{"]], _DEPTH[[ord(c) for c in "]}"]] = 1, -1


def _signs(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of brackets and commas, the signs there, and how many quotes stand before each; last the whole number of
    quotes. A quote after an odd number of backslashes is none; no range ends between the two."""
    at = np.flatnonzero(_SIGN[text])
    signs = text[at]
    quoted = signs == _QUOTE
    slashes = np.flatnonzero(text == _BACKSLASH)
    if len(slashes):
        fresh = np.flatnonzero(np.diff(slashes, prepend=-2) != 1)
        lengths = np.diff(np.append(fresh, len(slashes)))
        after = slashes[fresh] + lengths
        escaped = np.isin(at, after[lengths % 2 == 1]) & quoted
        at, signs, quoted = at[~escaped], signs[~escaped], quoted[~escaped]
    before = np.cumsum(quoted)
    total = before[-1:] if len(before) else np.zeros(1, np.int64)
    return at[~quoted], signs[~quoted], np.append(before[~quoted], total)


def _ranges(batch: pa.RecordBatch) -> Iterator[tuple[str, int, np.ndarray]]:
    """The ranges of which a batch holds pieces, with their text as bytes; the pieces of a range stand together."""
    if not batch.num_rows:
        return
    blocks, files = batch["_block"].to_numpy(zero_copy_only=False), batch["_file"].dictionary_encode()
    values = batch["value"].cast(pa.string())
    names = files.indices.to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(names) != 0)) + 1
    ends = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1]
    text = np.frombuffer(values.buffers()[2] or b"", np.uint8)
    for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)]):
        yield files.dictionary[names[begin]].as_py(), int(blocks[begin]), text[ends[begin] : ends[end]]


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range and start: whether it ends inside a string, and by how much the nesting has changed."""
    current, odd, depths = None, 0, [0, 0]

    def row():
        return [(*current, bool(odd), depths[0], not odd, depths[1])]

    for batch in batches:
        out = []
        for file, block, text in _ranges(batch):
            if (file, block) != current:
                out += row() if current else []
                current, odd, depths = (file, block), 0, [0, 0]
            _, signs, quotes = _signs(text)
            inside = ((quotes + odd) % 2).astype(bool)
            deeper = _DEPTH[signs]
            depths[0] += int(deeper[~inside[:-1]].sum())
            depths[1] += int(deeper[inside[:-1]].sum())
            odd = int(inside[-1])
        yield _batch(out, _FACTS)
    yield _batch(row() if current else [], _FACTS)


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where each range of a file stands at its beginning."""
    current, state, depth = None, False, 0
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["_file"] != current:
                current, state, depth = row["_file"], False, 0
            out.append((current, row["_block"], state, depth))
            taken = ("inEnds", "inDepth") if state else ("outEnds", "outDepth")
            state, depth = row[taken[0]], depth + row[taken[1]]
        yield _batch(out, _STARTS)


def _cut(batches: Iterator[pa.RecordBatch], edges: bool) -> Iterator[list[tuple]]:
    """The elements of each range (part -1); with ``edges`` instead what stands before its first border (0) and after its
    last (1)."""
    current, odd, depth, held, border = None, 0, 0, [], False
    for batch in batches:
        out, at_row = [], 0
        for file, block, text in _ranges(batch):
            if (file, block) != current:
                while batch["_file"][at_row].as_py() != file or batch["_block"][at_row].as_py() != block:
                    at_row += 1
                out += [(*current, 1 if border else 0, b"".join(held))] if current and edges else []
                current, held, border = (file, block), [], False
                odd, depth = int(batch["inString"][at_row].as_py()), batch["depth"][at_row].as_py()
            places, signs, quotes = _signs(text)
            inside = ((quotes + odd) % 2).astype(bool)
            places, signs, odd = places[~inside[:-1]], signs[~inside[:-1]], int(inside[-1])
            deeper = _DEPTH[signs]
            after = depth + np.cumsum(deeper)
            before = after - deeper
            depth = int(after[-1]) if len(after) else depth
            # the array opens, an element ends, the array closes
            opens = (signs == _OPEN) & (before == 0)
            borders = opens | ((signs == _COMMA) & (before == 1)) | ((signs == _CLOSE) & (before == 1))
            whole, begin = text.tobytes(), 0
            ends, opened = places[borders].tolist(), opens[borders].tolist()
            if edges and ends:
                if not border:
                    out.append((file, block, 0, b"" if opened[0] else b"".join(held) + whole[: ends[0]]))
                held, border, begin = [], True, ends[-1] + 1
            for at, opening in () if edges else zip(ends, opened):
                held.append(whole[begin:at])
                if border and not opening:
                    out.append((file, block, -1, b"".join(held).strip(_BLANKS)))
                held, border, begin = [], True, at + 1
            if border or edges:
                held.append(whole[begin:])
        yield out
    yield [(*current, 1 if border else 0, b"".join(held))] if current and edges else []


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _cut(batches, edges=False):
        yield _batch([(value,) for *_, value in rows], "value string")


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _cut(batches, edges=True):
        yield _batch(rows, _PARTS)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The elements that cross from one range into the next."""
    current, held = None, []
    for batch in batches:
        out = []
        for file, part, text in zip(*(batch[c].to_pylist() for c in ("_file", "part", "value"))):
            if file != current or part == 1:
                # what is left behind the end of an array is no element
                out += [("".join(held).strip(" \t\r\n"),)] if file == current else []
                current, held = file, []
            held.append(text)
        yield _batch(out, "value string")


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "int": pa.int32()}
    fields = [f.split(" ") for f in ddl.split(", ")]
    columns = list(zip(*rows)) or [[]] * len(fields)
    arrays = [
        pa.array(c, pa.binary()).cast(kinds[k]) if c and isinstance(c[0], bytes) else pa.array(c, kinds[k])
        for c, (_, k) in zip(columns, fields)
    ]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def array_elements(spark: SparkSession, path: str, files: DataFrame) -> DataFrame:
    """``value``: the elements of the array in each of ``files`` (``_file``) under ``path``, as they are written."""
    pieces = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.concat("value", F.lit("}")).alias("value"),
    )
    # a task reads its ranges one after another, so nothing is moved but a row per file and per range
    ranges = pieces.join(F.broadcast(files), "_file", "left_semi")
    facts = ranges.mapInArrow(_facts, _FACTS)
    starts = facts.repartition("_file").sortWithinPartitions("_file", "_block").mapInArrow(_followed, _STARTS)
    placed = ranges.join(F.broadcast(starts), ["_file", "_block"]).select("_file", "_block", "inString", "depth", "value")
    edges = placed.mapInArrow(_edges, _PARTS).repartition("_file").sortWithinPartitions("_file", "_block", "part")
    whole = placed.mapInArrow(_elements, "value string").unionByName(edges.mapInArrow(_joined, "value string"))
    element = F.col("value")
    texts = F.when(F.startswith(element, F.lit('"')), F.from_json(F.concat(F.lit("["), element, F.lit("]")), "array<string>")[0])
    return whole.where(element != "").select(F.coalesce(texts, element).alias("value")).where(F.col("value") != "")


def as_arrays(documents: DataFrame) -> DataFrame:
    """``value`` of each partition as the lines of one JSON array, for a text writer."""

    def bracketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = True
        for batch in batches:
            lines = []
            for text in batch["value"].to_pylist():
                lines.append(("[" if first else ",") + text)
                first = False
            yield _batch([(line,) for line in lines], "value string")
        yield _batch([("[]" if first else "]",)], "value string")

    return documents.select("value").mapInArrow(bracketed, "value string")
