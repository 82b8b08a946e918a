"""Web pages to WARC archives and back, with segmented records and chunked transfer framing.

Writing: of equal payloads one page is a response and the others revisit it. A response's HTTP message carries its
payload in chunks; a record block above a size is cut into segments, a first record and its continuations. Spark's text
writer puts the records down as bytes, the separator of its lines being the end of a record.

Reading: archives are split at the border of two records, so that a large one is read by several tasks. Spark's reader
overlooks a border where its buffer or its part of the file ends within line ends before it, so that a piece may hold
several records; their lengths tell them apart. A file in which a piece is still not as long as its headers say (the border
also stood inside a block) is walked from its start instead, piece by piece in their order, a record at a time. Segments are
grouped by the identifier of their origin, ordered by number and checked against the total length; then the chunks are
decoded and the payload is held against its digest. Rows go to Python in batches of a few MB.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burstguard.llm.common import shared_dir, written

# Fixed values of the format.
VERSION = "WARC/1.1"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
#: Bytes of a chunk and, at most, of a record block.
CHUNK, SEGMENT = 4096, 16384

#: What parts two records.
BORDER = f"{END}{VERSION}\r\n"
#: Bytes of a batch of rows for Python.
BATCH = 4 << 20

RECORD = "head string, body binary"
FIELDS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "page_id": "WARC-Page-ID",
    "payload_digest": "WARC-Payload-Digest",
    "segment_number": "WARC-Segment-Number",
    "origin_id": "WARC-Segment-Origin-ID",
    "total_length": "WARC-Segment-Total-Length",
}


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of bytes in upper-case base 32: four letters for each five hexadecimal digits."""
    digits = F.sha1(payload)

    def letter(i: Column) -> Column:
        bits = F.conv(F.substr(digits, F.floor(i / 4).cast("int") * 5 + 1, F.lit(5)), 16, 10).cast("int")
        place = F.call_function("shiftright", bits, (F.lit(15) - F.pmod(i, F.lit(4)) * 5).cast("int")).bitwiseAND(31)
        return F.substr(F.lit(BASE32), place + 1, F.lit(1))

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(31)), letter), "")


def _slices(value: Column, size: int) -> Column:
    """Bytes cut into pieces of ``size``, the last one shorter; none of no bytes."""
    pieces = F.transform(
        F.sequence(F.lit(0), F.floor((F.octet_length(value) - 1) / size).cast("int")),
        lambda i: F.substr(value, i * size + 1, F.lit(size)),
    )
    return F.when(F.octet_length(value) > 0, pieces).otherwise(F.array().cast("array<binary>"))


def _glued(parts: Column) -> Column:
    """An array of bytes as one. Strings are bytes to the engine here; no character is looked at."""
    return F.array_join(F.transform(parts, lambda p: p.cast("string")), "").cast("binary")


def _field(name: str, value: Column | str) -> Column:
    """A header line; none where the value is null."""
    value = F.lit(value) if isinstance(value, str) else value.cast("string")
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _uri(url: Column, page_id: Column) -> Column:
    """What stands for the address: without blanks and control characters, which would break the header."""
    named = F.coalesce(url, F.concat(F.lit("urn:page:"), F.coalesce(page_id.cast("string"), F.lit("unknown"))))
    return F.regexp_replace(named, r"[\x00-\x20\x7f]+", "%20")


def typed_pages(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, uri, payload, payload_digest, record_type, refers_uri``: which page is kept whole, which revisits it.

    Of pages with equal payloads of at least ``least_bytes`` the one with the largest page_id is the response; a null
    page_id is smaller than all others. Rows that repeat that page_id are responses as well.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        _uri(F.col("url"), F.col("page_id")).alias("uri"),
        F.coalesce("html", F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    # only payloads that occur again: their table is what the rows are joined with, broadcast by Spark while small
    shared = (
        rows.filter(F.octet_length("payload") >= least_bytes)
        .groupBy("digest")
        .agg(F.count("*").alias("copies"), F.max(F.struct("page_id", "uri")).alias("first"))
        .filter(F.col("copies") > 1)
    )
    first = F.col("first")
    again = F.col("copies").isNotNull() & ~F.col("page_id").eqNullSafe(first["page_id"])
    return rows.join(written(shared), "digest", "left").select(
        "page_id",
        "uri",
        "payload",
        base32_sha1(F.col("payload")).alias("payload_digest"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, first["uri"]).alias("refers_uri"),
    )


def records(typed: DataFrame, date: str, chunk: int = CHUNK, segment: int = SEGMENT) -> DataFrame:
    """``value``: the records of ``typed_pages``, without the four bytes that end them. Long blocks are segmented."""
    framed = F.transform(
        _slices(F.col("payload"), chunk),
        lambda c: F.concat(F.concat(F.hex(F.octet_length(c)), F.lit("\r\n")).cast("binary"), c, F.lit("\r\n").cast("binary")),
    )
    message = F.concat(F.lit(HTTP_HEAD).cast("binary"), _glued(framed), F.lit("0\r\n\r\n").cast("binary"))
    is_response = F.col("record_type") == "response"
    block = F.when(is_response, message).otherwise(F.lit(HTTP_HEAD).cast("binary"))
    name = F.concat(F.lit("<urn:uuid:"), F.expr("uuid()"), F.lit(">"))
    cut = (
        typed.withColumn("origin", name)
        .withColumn("block", block)
        .withColumn("whole", F.octet_length("block"))
        .withColumn("slices", _slices(F.col("block"), segment))
        .withColumn("n", F.size("slices"))
        .drop("payload", "block")
        .select("*", F.posexplode("slices").alias("at", "body"))
        .drop("slices")
    )
    starts, several, ends = F.col("at") == 0, F.col("n") > 1, F.col("at") == F.col("n") - 1
    head = F.concat(
        F.lit(f"{VERSION}\r\n"),
        _field("WARC-Type", F.when(starts, F.col("record_type")).otherwise("continuation")),
        _field("WARC-Record-ID", F.when(starts, F.col("origin")).otherwise(name)),
        _field("WARC-Date", date),
        _field("WARC-Target-URI", F.col("uri")),
        _field("WARC-Page-ID", F.when(starts, F.col("page_id"))),
        _field("WARC-Payload-Digest", F.when(starts, F.concat(F.lit("sha1:"), F.col("payload_digest")))),
        _field("WARC-Profile", F.when(~is_response, F.lit(PROFILE))),
        _field("WARC-Refers-To-Target-URI", F.col("refers_uri")),
        _field("WARC-Refers-To-Date", F.when(~is_response, F.lit(date))),
        _field("WARC-Segment-Number", F.when(several, F.col("at") + 1)),
        _field("WARC-Segment-Origin-ID", F.when(~starts, F.col("origin"))),
        _field("WARC-Segment-Total-Length", F.when(several & ends, F.col("whole"))),
        _field("Content-Type", F.when(starts, F.lit("application/http;msgtype=response"))),
        _field("Content-Length", F.octet_length("body")),
        F.lit("\r\n"),
    )
    return cut.select(F.concat(head.cast("binary"), F.col("body")).cast("string").alias("value"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, chunk: int = CHUNK, segment: int = SEGMENT) -> None:
    """One archive per task in the folder ``path``."""
    now = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    records(typed_pages(pages, least_bytes), now, chunk, segment).write.option("lineSep", END).text(path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs inside hands rows to Python in batches of BATCH bytes: ten thousand blocks, the default, are many MB."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(BATCH))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _length(head: bytes) -> int | None:
    """What a header says of its body's length; None if that can't be read."""
    lengths = [x.split(b":", 1)[1].strip() for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    return int(lengths[0]) if lengths and lengths[0].isdigit() else None


def _parted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The records of pieces that are not as long as their first header says. One without header and body for a piece that
    is not made of whole records with the border between them."""
    end, border = END.encode(), BORDER.encode()
    for frame in batches:
        out = []
        for file, piece in zip(frame["file"], frame["piece"]):
            at, found = 0, []
            while at is not None:
                stop = piece.find(end, at)
                length = _length(piece[at:stop]) if stop >= 0 else None
                after = None if length is None else stop + len(end) + length
                if after is None or piece[after : after + len(border)] not in (border, b"", end) or after > len(piece):
                    found, at = [(file, None, None)], None
                else:
                    found.append((file, piece[at:stop].decode("utf-8", "replace"), piece[stop + len(end) : after]))
                    at = after + len(border) if piece.startswith(border, after) else None
            out += found
        yield pd.DataFrame(out, columns=["file", "head", "body"])


def _walked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Archives given as pieces in their order, from record to record by their lengths, of which only the one at hand is
    held. What follows a broken header comes back without one."""
    end, border = END.encode(), BORDER.encode()
    file, size, read, content, at = None, 0, 0, bytearray(), 0

    def records(over: bool) -> list[tuple[str | None, bytes]]:
        nonlocal at
        out = []
        while at < len(content):
            stop = content.find(end, at)
            length = _length(bytes(content[at:stop])) if stop >= 0 else None
            after = None if length is None else stop + len(end) + length
            if after is None or after > len(content):
                if over:
                    out.append((None, bytes(content[at:])))
                    at = len(content)
                break
            out.append((bytes(content[at:stop]).decode("utf-8", "replace"), bytes(content[stop + len(end) : after])))
            at = after + len(end)
        gone = min(at, len(content))
        del content[:gone]
        at -= gone
        return out

    def closed() -> list[tuple[str | None, bytes]]:
        if read + len(border) == size:  # a border at the very end leaves no piece behind
            content.extend(border)
        return records(over=True)

    for frame in batches:
        out = []
        for name, length, piece in zip(frame["file"], frame["size"], frame["piece"]):
            if name != file:
                out += closed()
                file, size, read, at = name, length, 0, 0
                content.clear()
            more = border + piece if read else piece
            read += len(more)
            content.extend(more)
            out += records(over=False)
        yield pd.DataFrame(out, columns=["head", "body"])
    yield pd.DataFrame(closed(), columns=["head", "body"])


def split_records(spark: SparkSession, path: str) -> DataFrame:
    """``head, body`` of every record in the archives of a folder."""
    text = spark.read.option("lineSep", BORDER).text(path)
    meta = F.col("_metadata")
    raw = text.select(
        meta["file_path"].alias("file"), meta["file_size"].alias("size"), meta["file_block_start"].alias("part"),
        F.monotonically_increasing_id().alias("at"), F.col("value").cast("binary").alias("piece"),
    )
    first = f"{VERSION}\r\n"
    piece = F.when(F.startswith("piece", F.lit(first.encode())), F.substr("piece", F.lit(len(first) + 1))).otherwise(F.col("piece"))
    pieces = (
        raw.select("file", piece.alias("piece"))
        .withColumn("head", F.substring_index(F.col("piece").cast("string"), END, 1))
        .withColumn("from", F.octet_length("head") + 4)
        .withColumn("length", F.regexp_extract("head", r"(?im)^Content-Length:[ \t]*(\d+)", 1).try_cast("long"))
        .withColumn("over", F.octet_length("piece") - F.col("from") - F.col("length"))
    )
    # the last record of a file still has its end
    last = (F.col("over") == 4) & F.endswith(F.col("piece").cast("string"), F.lit(END))
    sound = F.coalesce((F.col("over") == 0) | last, F.lit(False))
    body = F.substr("piece", (F.col("from") + 1).cast("int"), F.col("length").cast("int"))
    split = pieces.filter(sound).select("file", "head", body.alias("body"))
    with small_batches(spark):
        parted = written(pieces.filter(~sound).select("file", "piece").mapInPandas(_parted, f"file string, {RECORD}"))
    odd = written(parted.filter("head is null").select("file").distinct())
    found = split.unionByName(parted)
    if odd.isEmpty():
        return found.drop("file")
    whole = raw.join(odd, "file", "left_semi").repartition("file").sortWithinPartitions("file", "part", "at")
    with small_batches(spark):
        walked = written(whole.select("file", "size", "piece").mapInPandas(_walked, RECORD))
    return found.join(odd, "file", "left_anti").drop("file").unionByName(walked)


def _with_fields(split: DataFrame) -> DataFrame:
    def field(name: str) -> Column:
        return F.nullif(F.trim(F.regexp_extract("head", rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1)), F.lit(""))

    found = split.select("body", *[field(n).alias(c) for c, n in FIELDS.items()])
    return found.withColumns(
        {
            "page_id": F.col("page_id").try_cast("long"),
            "segment_number": F.col("segment_number").try_cast("int"),
            "total_length": F.col("total_length").try_cast("long"),
            "payload_digest": F.regexp_replace("payload_digest", "^sha1:", ""),
        }
    )


ORIGIN = ["record_type", "record_id", "target_uri", "page_id", "payload_digest"]


def reassembled(found: DataFrame) -> DataFrame:
    """One row per record that is no continuation: ``record_type, record_id, target_uri, page_id, payload_digest,
    n_segments, block, problem``. Segments come together by origin; a record in one piece is not moved."""
    single = F.col("segment_number").isNull()
    alone = found.filter(single).select(
        *ORIGIN, F.lit(1).alias("n_segments"), F.col("body").alias("block"),
        F.when(F.col("record_type").isNull(), "no header").alias("problem"),
    )
    part = F.struct(F.col("segment_number").alias("number"), "body")
    grouped = (
        found.filter(~single)
        .groupBy(F.coalesce("origin_id", "record_id").alias("origin"))
        .agg(
            F.sort_array(F.collect_list(part)).alias("parts"),
            F.max("total_length").alias("total"),
            F.max(F.when(F.col("segment_number") == 1, F.struct(*ORIGIN))).alias("first"),
        )
    )
    numbers = F.col("parts.number")
    complete = numbers == F.sequence(F.lit(1), F.size("parts"))
    length = F.aggregate("parts.body", F.lit(0).cast("long"), lambda n, b: n + F.octet_length(b))
    problem = (
        F.when(~complete, "segments missing or doubled")
        .when(F.col("total").isNull(), "no total length")
        .when(length != F.col("total"), "total length differs")
    )
    joined = grouped.select(
        *[F.col("first")[c].alias(c) for c in ORIGIN], F.size("parts").alias("n_segments"),
        _glued(F.col("parts.body")).alias("block"), problem.alias("problem"),
    )
    return alone.unionByName(joined)


def unchunked(block: bytes) -> tuple[bytes, str | None]:
    """The payload of an HTTP message and, if its framing is broken, what is wrong."""
    head, _, body = block.partition(END.encode())
    if b"\r\ntransfer-encoding: chunked" not in head.lower():
        return body, None
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        try:
            size = int(body[at:end].split(b";", 1)[0], 16) if end >= 0 else -1
        except ValueError:
            size = -1
        if size < 0:
            return b"".join(out), "chunk size unreadable"
        if size == 0:
            return b"".join(out), None
        out.append(body[end + 2 : end + 2 + size])
        at = end + 2 + size + 2
        if body[at - 2 : at] != b"\r\n":
            return b"".join(out), "chunk cut short"


@F.pandas_udf(T.StructType([T.StructField("payload", T.BinaryType()), T.StructField("problem", T.StringType())]))
def _decoded(blocks: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([unchunked(b or b"") for b in blocks], columns=["payload", "problem"])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``record_type, record_id, target_uri, page_id, payload_digest, n_segments, payload, problem`` of the records in a
    folder of archives.

    ``payload`` is null for revisits, whose digest is that of the response they stand for. ``problem`` is null for a
    sound record; else it names what is wrong (header, segments, total length, chunks, digest), and the payload is as far
    as it could be read.
    """
    found = reassembled(_with_fields(split_records(spark, path)))
    has_payload = ~F.coalesce(F.col("record_type") == "revisit", F.lit(False))
    decoded = found.filter(has_payload).withColumn("decoded", _decoded("block"))
    differs = F.when(F.col("payload_digest") != base32_sha1(F.col("decoded.payload")), "digest differs")
    columns = [*ORIGIN, "n_segments"]
    full = decoded.select(
        *columns, F.col("decoded.payload").alias("payload"),
        F.coalesce("problem", F.col("decoded.problem"), differs).alias("problem"),
    )
    return full.unionByName(found.filter(~has_payload).select(*columns, F.lit(None).cast("binary").alias("payload"), "problem"))


def archived_pages(pages: DataFrame, least_bytes: int = 0, chunk: int = CHUNK, segment: int = SEGMENT) -> DataFrame:
    """Writes ``page_id, url, html`` into archives in the shared folder and reads them back: one row per page with
    ``page_id, payload_bytes, payload_digest, record_type, refers_to, n_segments, problem``.

    A null html is an empty payload, and payloads may be empty or of any length: records are segmented, and only the
    segments of one page come together. A null page_id is smaller than all others and comes back null; a null url is
    named after the page, blanks and control characters in one are written as ``%20``. Of equal payloads the largest
    page_id is the response, also in every row that repeats it. A revisit is resolved by its digest: its length and
    ``refers_to`` come from the response that was read. An empty table gives no rows; other columns are not read.
    """
    spark = pages.sparkSession
    path = f"{shared_dir(spark)}/archives-{uuid.uuid4().hex}"
    write_archives(pages, path, least_bytes, chunk, segment)
    read = read_archives(spark, path).select(
        "page_id", "record_type", "n_segments", "problem",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(F.col("record_type") == "revisit", F.col("payload_digest")).otherwise(base32_sha1(F.col("payload"))).alias("payload_digest"),
    )
    with small_batches(spark):
        facts = written(read)
    revisit = F.col("record_type") == "revisit"
    again = facts.filter(revisit)
    wanted = again.select("payload_digest").distinct()
    known = (
        facts.filter(~revisit).join(wanted, "payload_digest", "left_semi").groupBy("payload_digest")
        .agg(F.max("page_id").alias("refers_to"), F.max("payload_bytes").alias("bytes"))
    )
    resolved = again.join(known, "payload_digest", "left").withColumn("payload_bytes", F.col("bytes")).drop("bytes")
    return facts.filter(~revisit).withColumn("refers_to", F.lit(None).cast("long")).unionByName(resolved).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "n_segments", "problem"
    )
