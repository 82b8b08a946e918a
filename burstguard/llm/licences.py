"""Licence scan: an Aho-Corasick automaton finds tags and notice phrases, tagged expressions are parsed and weighed.

A text is lower-cased (A-Z) and cut into words; all phrases of a catalogue are searched in one pass over the words.
Where the phrase of an identifier tag occurs, the expressions behind such tags are read from the text itself, brought
into postfix order by the shunting-yard method (WITH binds closer than AND, AND closer than OR) and evaluated to one
restriction between 0 (free) and 1 (all rights kept): AND asks for the stricter side, OR leaves the freer one, WITH an
exception halves the distance to the freest copyleft.
"""

from __future__ import annotations

import re

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Phrases (words with one space) and labels of the base contract.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Further notices.
NOTICE_PHRASES = {
    "mit license": "mit",
    "permission is hereby granted free of charge": "mit",
    "apache license": "apache",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "creative commons attribution": "cc-by-notice",
    "public domain": "public-domain",
    "spdx license identifier": "spdx",
}
#: How much a label or an SPDX identifier (without version) restricts.
RESTRICTION = {
    "0bsd": 0.0, "cc0": 0.0, "public-domain": 0.0, "unlicense": 0.0, "wtfpl": 0.0, "zlib": 0.1,
    "apache": 0.1, "bsd": 0.1, "isc": 0.1, "mit": 0.1, "cc-by": 0.2, "cc-by-notice": 0.2, "cc-by-sa": 0.4,
    "epl": 0.5, "mpl": 0.4, "lgpl": 0.5, "gpl": 0.7, "agpl": 0.9, "cc-by-nd": 0.9, "cc-by-nc": 0.8,
    "cc-by-nc-sa": 0.85, "cc-by-nc-nd": 0.95, "reserved": 1.0,
}
UNKNOWN = 0.5
EXCEPTION_FLOOR = 0.1
TAG = re.compile(r"spdx-license-identifier[ \t]*:[ \t]*([^\r\n]*)", re.I)
TOKEN = re.compile(r"\s*([()]|[A-Za-z0-9][A-Za-z0-9.+:-]*)")
BINDING = {"or": 1, "and": 2, "with": 3}
#: A-Z in lower case; every byte that belongs to no word becomes a blank.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "expressions string, score double"
)


def postfix(text: str) -> list[str] | None:
    """Tokens of the longest licence expression at the start of ``text`` in postfix order; None if there is none."""
    out: list[str] = []
    stack: list[str] = []
    at, operand_next = 0, True
    while m := TOKEN.match(text, at):
        word, low = m[1], m[1].lower()
        if low in BINDING:
            if operand_next:
                return None
            while stack and stack[-1] != "(" and BINDING[stack[-1]] >= BINDING[low]:
                out.append(stack.pop())
            stack.append(low)
            operand_next = True
        elif word == "(":
            if not operand_next:
                break
            stack.append(word)
        elif word == ")":
            if operand_next or "(" not in stack:
                return None
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
        else:
            if not operand_next:
                break
            out.append(low)
            operand_next = False
        at = m.end()
    if operand_next or "(" in stack:
        return None
    return out + stack[::-1]


def restriction(identifier: str) -> float:
    """Weight of one identifier: its longest known beginning at a hyphen, so that versions need no table."""
    name = identifier.removesuffix("+")
    while name:
        if name in RESTRICTION:
            return RESTRICTION[name]
        name = name.rpartition("-")[0]
    return UNKNOWN


def evaluate(tokens: list[str]) -> float:
    values: list[float] = []
    for token in tokens:
        if token in BINDING:
            right, left = values.pop(), values.pop()
            if token == "with":
                values.append(left if left <= EXCEPTION_FLOOR else (left + EXCEPTION_FLOOR) / 2)
            else:
                values.append(max(left, right) if token == "and" else min(left, right))
        else:
            values.append(restriction(token))
    return values[0]


def automaton(phrases: dict[str, tuple[str, bool]]) -> ahocorasick.Automaton:
    """Of phrases between blanks: neighbouring phrases may share a blank, as the search reports overlaps."""
    machine = ahocorasick.Automaton()
    for phrase, (label, base) in phrases.items():
        machine.add_word(f" {phrase} ", (phrase.count(" ") + 1, label, base))
    machine.make_automaton()
    return machine


_MACHINE: list[ahocorasick.Automaton] = []


def scan_text(text: str) -> tuple:
    if not _MACHINE:
        _MACHINE.append(
            automaton({p: (x, False) for p, x in NOTICE_PHRASES.items()} | {p: (x, True) for p, x in BASE_PHRASES.items()})
        )
    words = text.encode("utf-8", "replace").translate(WORD_BYTES).split()
    line = f" {b' '.join(words).decode('utf-8', 'replace')} "
    n_base, first, last = 0, None, None
    base_labels, labels = set(), set()
    upto = index = 0  # words that end before ``upto``
    for end, (length, label, base) in _MACHINE[0].iter(line):
        index += line.count(" ", upto, end)
        upto = end
        labels.add(label)
        if base:
            start = index - length
            n_base += 1
            first = start if first is None else min(first, start)
            last = start if last is None else max(last, start)
            base_labels.add(label)
    scores = [RESTRICTION[x] for x in labels if x != "spdx"]
    expressions = []
    if "spdx" in labels:
        for m in TAG.finditer(text):
            tokens = postfix(m[1])
            if tokens is None:
                labels.add("spdx-invalid")
                scores.append(UNKNOWN)
            else:
                expressions.append(" ".join(tokens))
                labels |= {t for t in tokens if t not in BINDING}
                scores.append(evaluate(tokens))
    return (
        len(words), n_base, first, last, ",".join(sorted(base_labels)), ",".join(sorted(labels)),
        "; ".join(sorted(set(expressions))), max(scores, default=0.0),
    )


def _scan(texts: pd.Series) -> pd.DataFrame:
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    frame = pd.DataFrame([scan_text(t or "") for t in texts], columns=names)
    return frame.astype({"first_word": "Int64", "last_word": "Int64"})


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input's columns other than ``text``, and ``found``: a struct of counts, labels, expressions and score.

    Null and empty texts have no words, no labels and score 0. Rows are judged one by one, so repeated rows and null
    ids give a row each, an empty table none. A label that several phrases give counts each place but is listed once.
    Tags with a malformed expression give the label ``spdx-invalid``. A column named ``found`` is replaced.
    """
    return docs.withColumn("found", F.pandas_udf(_scan, SCHEMA)(F.col(text))).drop(text)
