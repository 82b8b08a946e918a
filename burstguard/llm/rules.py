"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per failed rule; policies are
versioned masks over those bits, so that changing a policy, comparing two or counting what a rule alone removes
(ablation) never touches a text again. Everything is a column expression.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burstguard.llm.common import SPACES, let

WINDOW = 5


def _n(name: str) -> Column:
    return F.col(name)


#: Rules in bit order; a rule is true where a document fails it. Never reorder: bits are stored.
RULES: list[tuple[str, Callable[[], Column]]] = [
    ("few_words", lambda: _n("n_words") < 10),
    ("repeated_windows", lambda: 100 * _n("n_repeat_words") > 20 * _n("n_words")),
    ("many_symbols", lambda: 10 * _n("n_symbols") > 3 * _n("n_words")),
    ("short_words", lambda: _n("word_chars") < 2 * _n("n_words")),
    ("long_words", lambda: _n("word_chars") > 14 * _n("n_words")),
    ("repeated_lines", lambda: 10 * _n("n_dup_lines") > 3 * _n("n_lines")),
    ("shouting", lambda: 2 * _n("n_capitals") > _n("word_chars")),
    ("exclaiming", lambda: 4 * _n("n_bangs") > _n("n_words")),
]
BIT = {name: i for i, (name, _) in enumerate(RULES)}


def mask(*names: str) -> int:
    return sum(1 << BIT[n] for n in names)


#: Policies by version: a document is kept if it fails no rule of the mask.
POLICIES = {
    "base-1": mask("few_words", "repeated_windows"),
    "strict-1": mask(*BIT),
}
DEFAULT_POLICY = "strict-1"


def repeated_words(words: Column) -> Column:
    """How many words lie in windows of five words that the array holds twice or more, the first included.

    Windows are compared by the chained 64-bit hash of their words. The positions are only sorted where some hash
    repeats; the cover of the flagged windows is then one pass in order.
    """

    def cover(starts: Column) -> Column:
        step = lambda acc, p: F.struct(
            (acc["words"] + p + F.lit(WINDOW) - F.greatest(acc["upto"], p)).alias("words"),
            (p + F.lit(WINDOW)).alias("upto"),
        )
        return F.aggregate(
            starts, F.struct(F.lit(0).alias("words"), F.lit(0).alias("upto")), step, lambda acc: acc["words"]
        )

    def flagged(ordered: Column) -> Column:
        same = lambda x, j: F.coalesce(F.get(ordered, j - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(
            F.get(ordered, j + 1)["h"] == x["h"], F.lit(False)
        )
        return F.sort_array(F.transform(F.filter(ordered, same), lambda x: x["i"]))

    def count(hashes: Column) -> Column:
        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            cover(let(F.sort_array(pairs), flagged))
        )

    def windows(h: Column) -> Column:
        at = lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, WINDOW)])
        return F.slice(F.transform(h, at), F.lit(1), F.size(h) - F.lit(WINDOW - 1))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(let(let(hashed, windows), count))


def only(text: Column, characters: str) -> Column:
    """How many code points of ``text`` are of a regular expression's character class."""
    return F.char_length(text) - F.char_length(F.regexp_replace(text, characters, ""))


def words_of(text: Column) -> Column:
    """The words between white space: every kind of space becomes a blank, then a split at a plain character."""
    for c in SPACES[1:]:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " ", -1), "")


def measures(text: Column) -> Column:
    """One struct of all measurements of a text."""
    clean = F.coalesce(text, F.lit(""))

    def of(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
        return let(
            words_of(t),
            lambda w: let(
                lines,
                lambda ls: F.struct(
                    F.size(w).cast("long").alias("n_words"),
                    F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
                    only(t, "[#*$%&|<>]+").cast("long").alias("n_symbols"),
                    (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
                    repeated_words(w).cast("long").alias("n_repeat_words"),
                    F.size(ls).cast("long").alias("n_lines"),
                    only(t, "[A-Z]+").cast("long").alias("n_capitals"),
                    (F.char_length(t) - F.char_length(F.replace(t, F.lit("!"), F.lit("")))).cast("long").alias("n_bangs"),
                ),
            ),
        )

    return let(clean, of)


def ledger(docs: DataFrame) -> DataFrame:
    """``doc_id``, the measurements and ``fail_bits`` (long) for every row of ``doc_id, text``.

    Null and blank texts have no words: all measurements are 0 and only ``few_words`` fails. Repeated rows and null
    ids each keep a row of their own; an empty table gives an empty ledger; other columns are not read.
    """
    judged = _judged(docs.select("doc_id", "text"))
    return judged.select("row.doc_id", *judged.columns[1:])


def _judged(docs: DataFrame) -> DataFrame:
    """The whole input row as a struct, beside its measurements and bits: names of extra columns cannot clash."""
    measured = docs.select(F.struct("*").alias("row"), F.explode(F.array(measures(F.col("text")))).alias("m"))
    measured = measured.select("row", "m.*")
    bits = F.lit(0).cast("long")
    for i, (_, rule) in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(rule(), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    return measured.withColumn("fail_bits", bits)


def keep(docs: DataFrame, version: str = DEFAULT_POLICY) -> DataFrame:
    """The rows of ``docs`` that a policy version keeps, with all their columns."""
    return apply_policy(_judged(docs), version).filter("kept").select("row.*")


def apply_policy(frame: DataFrame, version: str = DEFAULT_POLICY, into: str = "kept") -> DataFrame:
    """Add the verdict of one policy version to a ledger."""
    return frame.withColumn(into, F.col("fail_bits").bitwiseAND(F.lit(POLICIES[version]).cast("long")) == 0)


def ablation(frame: DataFrame, version: str = DEFAULT_POLICY) -> DataFrame:
    """Per rule of a policy: how many documents fail it, and how many fail it alone and would stay without it.

    Documents are first counted by their bits; everything else works on those at most ``2 ** rules`` counts.
    """
    chosen = POLICIES[version]
    by_bits = frame.groupBy(F.col("fail_bits").bitwiseAND(F.lit(chosen).cast("long")).alias("bits")).agg(
        F.count(F.lit(1)).alias("n")
    )
    names = F.array(
        *[F.struct(F.lit(k).alias("rule"), F.lit(1 << i).cast("long").alias("bit")) for k, i in BIT.items() if chosen >> i & 1]
    )
    one = by_bits.select("bits", "n", F.explode(names).alias("r")).select("bits", "n", "r.rule", "r.bit")
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    return one.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("failed"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("failed_alone"),
    )
