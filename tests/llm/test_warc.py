import base64
import hashlib
import random
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from burstguard.llm import warc

SCHEMA = "page_id long, url string, html string"


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def plain(rows, least=0):
    """The contract, by looking at all pages at once."""
    bodies = [(i, (h or "").encode()) for i, _, h in rows]
    last = {}
    for i, b in bodies:
        last[b] = max([x for x in (i, last.get(b)) if x is not None], default=None)
    out = []
    for i, b in bodies:
        again = len(b) >= least and i != last[b]
        out.append((i, len(b), digest(b), "revisit" if again else "response", last[b] if again else None))
    return sorted(out, key=str)


def got(df):
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert df.filter("problem is not null").count() == 0
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def pages(spark, rows):
    extra = {c: F.lit(1) for c in ("value", "digest", "uri", "body", "n", "head", "first")}
    return spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns(extra)


def hard_rows():
    rng = random.Random(7)
    long_text = "".join(rng.choice("aé漢\U0001f600 <p>\r\n") for _ in range(30_000))
    border = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n"
    texts = [
        None, "", "one", "\r\n", "\r\n\r\n", "WARC/1.1\r\n", border, border * 40, "x" * 63, "x" * 64, "x" * 65, "x" * 128, "0\r\n\r\n",
        "é" * 100, long_text, long_text, "one", "one", "tail\r", "zero\x00byte",
    ]
    rows = [(i, f"http://a.example/{i % 5}", t) for i, t in enumerate(texts)]
    rows += [(2, "http://a.example/2", "one"), (17, None, "one"), (17, None, "one"), (None, None, "one"), (None, "u", "only here")]
    return rows + [(None, "u", "only here"), (30, "http://a b/\r\nContent-Length: 9", "odd address"), (31, "", "no address")]


@pytest.mark.parametrize("chunk, segment", [(64, 100), (4096, 16384), (7, 1)])
def test_equals_plain_version(corpus_spark, chunk, segment):
    rows = [r for r in hard_rows() if segment > 1 or len(r[2] or "") < 200]
    assert got(warc.archived_pages(pages(corpus_spark, rows), chunk=chunk, segment=segment)) == plain(rows)


def test_least_size_of_a_revisit(corpus_spark):
    assert got(warc.archived_pages(pages(corpus_spark, hard_rows()), least_bytes=10)) == plain(hard_rows(), 10)


def test_no_pages(corpus_spark):
    found = warc.archived_pages(corpus_spark.createDataFrame([], SCHEMA))
    assert found.count() == 0


def test_large_archive_is_read_by_several_tasks(corpus_spark, tmp_path):
    rows = [(i, f"http://a.example/{i}", f"page {i} " * 200) for i in range(300)]
    path = str(tmp_path / "archives")
    warc.write_archives(corpus_spark.createDataFrame(rows, SCHEMA).coalesce(1), path, segment=700)
    before = corpus_spark.conf.get("spark.sql.files.maxPartitionBytes")
    corpus_spark.conf.set("spark.sql.files.maxPartitionBytes", "5003")
    try:
        split = warc.split_records(corpus_spark, path)
        assert split.rdd.getNumPartitions() > 50
        read = {r["page_id"]: r for r in warc.read_archives(corpus_spark, path).collect()}
    finally:
        corpus_spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {i: bytes(r["payload"]).decode() for i, r in read.items()} == {i: h for i, _, h in rows}
    assert {r["problem"] for r in read.values()} == {None} and min(r["n_segments"] for r in read.values()) > 1


def archive(spark, folder, records):
    """Records given as (headers, body) in one archive, byte by byte."""
    data = b""
    for headers, body in records:
        lines = "".join(f"{k}: {v}\r\n" for k, v in headers.items())
        data += b"WARC/1.1\r\n" + lines.encode() + f"content-length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"
    folder.mkdir()
    (folder / "crawl.warc").write_bytes(data)
    return {r["record_id"]: r for r in warc.read_archives(spark, str(folder)).collect()}


def message(payload, size=5):
    pieces = [payload[i : i + size] for i in range(0, len(payload), size)]
    body = b"".join(b"%x;ext=1\r\n%b\r\n" % (len(p), p) for p in pieces)
    return b"HTTP/1.1 200 OK\r\nTransfer-Encoding: Chunked\r\n\r\n" + body + b"0\r\n\r\n"


def segments(name, block, cuts, total=True):
    parts = [block[a:b] for a, b in zip([0, *cuts], [*cuts, len(block)])]
    first = {"WARC-Type": "response", "WARC-Record-ID": name, "WARC-Segment-Number": 1}
    out = [(first, parts[0])]
    for i, part in enumerate(parts[1:], 2):
        head = {"warc-type": "continuation", "WARC-Record-ID": f"{name}-{i}", "WARC-Segment-Origin-ID": name, "WARC-Segment-Number": i}
        if total and i == len(parts):
            head["WARC-Segment-Total-Length"] = len(block)
        out.append((head, part))
    return out


def test_foreign_archive(corpus_spark, tmp_path):
    """Segments out of order and between other records, other letter case, plain payloads, every kind of damage."""
    block = message(b"a payload in several segments")
    good = segments("good", block, [10, 11, 60])
    lost = segments("lost", block, [10, 40])
    twice = segments("twice", block, [10, 40])
    short = segments("short", block, [10, 40])
    short[1] = (short[1][0], short[1][1][:-1])
    untold = segments("untold", block, [10], total=False)
    broken = {"WARC-Type": "response", "WARC-Record-ID": "broken"}
    cut = {"WARC-Type": "response", "WARC-Record-ID": "cut"}
    lied = {"WARC-Type": "response", "WARC-Record-ID": "lied", "WARC-Payload-Digest": "sha1:" + digest(b"other")}
    plain_body = {"WARC-Type": "resource", "WARC-Record-ID": "plain"}
    border = {"WARC-Type": "resource", "WARC-Record-ID": "border"}
    inner = b"HTTP/1.1 200 OK\r\n\r\nbefore\r\n\r\nWARC/1.1\r\nafter"
    records = [
        good[2], *untold, good[0], (plain_body, b"H: 1\r\n\r\nbody"), *twice, twice[1], good[3], lost[0], lost[2], good[1], *short,
        (broken, block.replace(b"5;ext", b"zz;ext", 1)), (cut, block.replace(b"\r\n0\r\n\r\n", b"\r\n9\r\nabc")),
        (lied, message(b"payload")),
    ]
    for folder, more in (("split", []), ("walked", [(border, inner)])):
        read = archive(corpus_spark, tmp_path / folder, records + more)
        assert bytes(read["good"]["payload"]) == b"a payload in several segments"
        assert bytes(read["plain"]["payload"]) == b"body" and read["good"]["n_segments"] == 4
        assert {n: r["problem"] for n, r in read.items() if n != "border"} == {
            "good": None, "plain": None, "lost": "segments missing or doubled", "twice": "segments missing or doubled",
            "short": "total length differs", "untold": "no total length", "broken": "chunk size unreadable",
            "cut": "chunk cut short", "lied": "digest differs",
        }
    assert bytes(read["border"]["payload"]) == b"before\r\n\r\nWARC/1.1\r\nafter"


def test_truncated_archive(corpus_spark, tmp_path):
    (tmp_path / "a").mkdir()
    whole = b"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: one\r\nContent-Length: 6\r\n\r\nH\r\n\r\nb\r\n\r\n"
    (tmp_path / "a" / "x.warc").write_bytes(whole + whole.replace(b"one", b"two")[:-6])
    read = warc.read_archives(corpus_spark, str(tmp_path / "a")).collect()
    assert sorted((r["record_id"] or "", r["problem"]) for r in read) == [("", "no header"), ("one", None)]


def test_overlooked_border_is_found_by_lengths(corpus_spark, tmp_path):
    """The reader misses a border if its buffer ends within it and the line ends that end the block before it."""
    bodies, at = {}, 0
    for i in range(60):
        head = f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: r{i:02d}\r\nContent-Length: 8000\r\n\r\n".encode()
        left = 65536 - at % 65536  # the next end of a buffer
        size = left - len(head) - 1 if 1000 <= left - len(head) - 1 < 9500 else 8000
        bodies[f"r{i:02d}"] = head.replace(b"8000", str(size).encode()), b"x" * (size - 4) + b"\r\n\r\n"
        at += len(head) + size + 4
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.warc").write_bytes(b"".join(h + b + b"\r\n\r\n" for h, b in bodies.values()))
    text = corpus_spark.read.option("lineSep", "\r\n\r\nWARC/1.1\r\n").text(str(tmp_path / "a"))
    assert text.count() < len(bodies)
    split = warc.split_records(corpus_spark, str(tmp_path / "a"))
    assert "binaryfile" not in split._jdf.queryExecution().toString().lower()  # a file that is read whole is held whole
    assert Counter(bytes(r["body"]) for r in split.collect()) == Counter(b for _, b in bodies.values())


def test_walk_holds_one_record_at_a_time():
    def given():
        for i in range(1000):
            inner = b"HTTP\r\n\r\nWARC/1.1\r\nWARC-Type: x\r\nContent-Length: 1\r\n\r\na"
            whole = b"Content-Length: %d\r\n\r\n" % len(inner) + inner
            pieces = whole.split(warc.BORDER.encode())
            pieces[0] = (b"" if i else b"WARC/1.1\r\n") + pieces[0]
            seen.append(i - out[0])
            yield pd.DataFrame({"file": "f", "size": 0, "piece": pieces})

    out, seen = [0], []
    for frame in warc._walked(given()):
        assert all(len(b) == 54 and h.endswith("Content-Length: 54") for h, b in zip(frame["head"], frame["body"])), frame
        out[0] += len(frame)
    assert out[0] == 1000 and max(seen) <= 1
