"""Plain one-process versions of the corpus operators, and small tables with hard cases."""

import hashlib
import re
import zlib
from collections import Counter

import xxhash
from pyspark.sql import types as T

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def hard_rows():
    """Nulls, empty and blank texts, repeated rows and ids, odd white space, other scripts, one long text."""
    passage = " ".join(f"shared{i % 61} passage{i % 53} word{i}" for i in range(40))
    long_text = "\n".join(f"Line {i} of a long text with number {i * i} and " + "more " * (i % 7) for i in range(600))
    texts = [
        None, "", "   \n\t ", "one", "two words", "Three little Words",
        "CC BY and cc-by, the General Public License. All rights reserved!",
        "SPDX-License-Identifier: (MIT OR GPL-2.0-only WITH Classpath-exception-2.0) AND CC-BY-4.0\ncode",
        "a  b   c   d　e\tf\n\n g", "don't WE'LL they're I'm 12345 ...!!! <|endoftext|> x <|startoftext|>y",
        "ναι όχι Σίσυφος 漢字かな交じり文 é ff \U0001f600\U0001f468‍\U0001f469", "x" * 900, "ab" * 700,
        passage, "Before. " + passage, passage + " after", passage.upper(), long_text, long_text + " end",
        "\x1c\x1d sep \x85 nel", "zero\x00byte", "tail blank ", " head blank", "%$#@ " * 30,
    ]
    rows = [(i, t, "en", ["a", "b", None, "a", "a"][i % 5], len(t) if t else None) for i, t in enumerate(texts)]
    rows += [(3, "one", "en", "a", 3), (3, "one", "en", "a", 3), (None, passage, None, "b", None), (None, None, None, None, None)]
    rows += [(100 + i, passage + f" {i % 3}", "en", "a", 1) for i in range(12)]
    return rows


def spark_docs(spark, rows=None):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(hard_rows() if rows is None else rows, SCHEMA)
    # columns whose names clash with those that operators use inside
    return frame.withColumns({c: F.lit(1) for c in ("rank", "fp", "bits", "ids", "key", "n", "found", "uid", "kept")})


def rule_counts(text):
    text = text or ""
    words = SPACE.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count, seen, dup, cover = Counter(windows), set(), 0, set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            cover |= set(range(i, i + 5))
    for line in text.split("\n"):
        if SPACE.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(cover)


def base_places(text, phrases):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(text)
    found = [
        (i, label)
        for phrase, label in phrases.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in found]
    return len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found}))


def simhash(text):
    words = SPACE.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) << b for b in range(64))


def groups(n, links):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(x) for x in range(n)]


def crc(text):
    return zlib.crc32((text or "").encode())


def sha(data):
    return hashlib.sha256(data).hexdigest()


def without_repeats(texts, length):
    """Per text: bytes removed, runs, what is left, when every byte of a repeated string goes."""
    raw = [(t or "").encode() for t in texts]
    count = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = len([r for r in bytes(gone).split(b"\0") if r])
        out.append((sum(gone), runs, bytes(x for x, g in zip(b, gone) if not g)))
    return out
