"""BPE encoding by forced boundaries, and decoding.

Two neighbouring bytes that stand inside no token of the vocabulary can never be merged, so a text may be cut between
them and the parts encoded on their own. A table of all 65,536 byte pairs says where. White space stands inside no
token and always ends a word, so texts are first cut there; a part seen before is looked up. A new part goes through
the file's own normaliser and word splitter, its words are cut at the forced boundaries, and each fragment is merged by
rank; only a word's last fragment carries the end-of-word mark. The results are concatenated.

Works for tokenizer files of the ``BPE`` type with byte-level words, an end-of-word suffix and white space dropped.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Tokenizer
from tokenizers.models import BPE

#: Parts and words that a worker remembers at most; then it forgets all and goes on.
REMEMBERED = 200_000
#: Texts of a batch are handled in portions of about so many characters.
PORTION = 2_000_000
#: The first character beyond the Latin blocks; all before it are stable under NFC.
LATIN_END = "\u0250"
#: The form of file that the Latin shortcut knows: fixed values of the format.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_letters() -> list[str]:
    """The letter by which byte-level vocabularies write each byte: itself if printable, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(other)) for b in range(256)]


class ForcedBoundaryEncoder:
    """Fragments are merged by the library's own BPE model: as the file has it for a word's last fragment, and without
    the end-of-word suffix for the others. Latin texts are lowered and cut into words by an equal regular expression of
    Python's, which saves the normaliser and splitter objects; all others go through those of the file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter, self.last = library.normalizer, library.pre_tokenizer, library.model
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.inner = BPE(vocab=model["vocab"], merges=merges)
        self.vocabulary = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_at = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.letter = byte_letters()
        self.never = self.forced_pairs()
        self.cuts = {
            self.letter[x]: "".join(self.letter[y] for y in np.flatnonzero(self.never[x])) for x in range(256)
        }
        self.latin = self.latin_words(spec)
        self.parts: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {}

    def forced_pairs(self) -> np.ndarray:
        """``never[a, b]``: no token holds byte ``b`` right after byte ``a``."""
        byte = {c: b for b, c in enumerate(self.letter)}
        never = np.ones((256, 256), bool)
        for token in self.vocabulary:
            held = [byte[c] for c in token.removesuffix(self.suffix)]
            never[held[:-1], held[1:]] = False
        return never

    @staticmethod
    def latin_words(spec: dict) -> re.Pattern | None:
        """The file's word pattern for code points below LATIN_END; None if the file is not of the known form."""
        if spec["normalizer"] != NORMALIZER or spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] != WORDS:
            return None
        latin = list(map(chr, range(ord(LATIN_END))))
        letters, numbers = ("".join(c for c in latin if unicodedata.category(c)[0] == x) for x in "LN")
        spaces = "\t-\r \x85\xa0"
        return re.compile(WORDS.replace(r"\s", spaces).replace(r"\p{L}", letters).replace(r"\p{N}", numbers))

    def word(self, letters: str) -> bytes:
        """Ids of a word: fragments between the forced boundaries, each merged on its own."""
        cuts, start, out = self.cuts, 0, []
        for i in range(1, len(letters)):
            if letters[i] in cuts[letters[i - 1]]:
                out += [t.id for t in self.inner.tokenize(letters[start:i])]
                start = i
        out += [t.id for t in self.last.tokenize(letters[start:])]
        return np.asarray(out, "<i4").tobytes()

    def plain(self, text: str) -> bytes:
        """Ids of a text without special tokens and ASCII white space."""
        if self.latin and (text.isascii() or max(text) < LATIN_END):
            words = self.latin.findall(text.lower())
            if not (text.isascii() and text.isprintable()):
                words = ["".join(map(self.letter.__getitem__, w.encode())) for w in words]
        else:
            words = [w for w, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text))]
        known, out = self.words, []
        for w in words:
            ids = known.get(w)
            if ids is None:
                ids = known[w] = self.word(w)
            out.append(ids)
        return b"".join(out)

    def part(self, raw: bytes) -> bytes:
        """Ids of a part of a text, as little-endian 32-bit integers."""
        text = raw.decode("utf-8", "replace")
        if not self.special_at or b"<|" not in raw:
            return self.plain(text)
        return b"".join(
            np.asarray([self.special[x]], "<i4").tobytes() if x in self.special else self.plain(x)
            for x in self.special_at.split(text)
            if x
        )

    def encode(self, text: str) -> bytes:
        parts = text.encode("utf-8", "replace").split()
        known = self.parts
        found = list(map(known.get, parts))
        if None in found:
            if len(known) > REMEMBERED or len(self.words) > REMEMBERED:
                known.clear()
                self.words.clear()
            for i, ids in enumerate(found):
                if ids is None:
                    ids = known.get(parts[i])
                    if ids is None:
                        ids = known[parts[i]] = self.part(parts[i])
                    found[i] = ids
        return b"".join(found)


_ENCODERS: dict[str, ForcedBoundaryEncoder] = {}


def encoder(path: str) -> ForcedBoundaryEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = ForcedBoundaryEncoder(path)
    return _ENCODERS[path]


def _portions(batch: pa.RecordBatch, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about PORTION each: one long text never drags thousands of others along."""
    start = total = 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and total + size > PORTION:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < batch.num_rows:
        yield batch.slice(start)


def _replaced(batch: pa.RecordBatch, name: str, values: pa.Array, into: str) -> pa.RecordBatch:
    kept = [n for n in batch.schema.names if n not in (name, into)]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), values], names=[*kept, into])


def _output(df: DataFrame, name: str, into: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name not in (name, into)] + [T.StructField(into, kind)])


def encode(docs: DataFrame, path: str, text: str = "text", into: str = "ids") -> DataFrame:
    """Replace column ``text`` by ``into``, an array of token ids; other columns pass through.

    A null or empty text, or one of white space only, has no tokens. Special tokens written in a text are found as the
    tokenizers library finds them. Rows are independent: repeated rows, null ids and empty tables need no care. A text
    is never cut other than at forced boundaries, whatever its length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = encoder(path)
        for whole in batches:
            sizes = np.diff(_offsets(whole.column(text)))
            for batch in _portions(whole, sizes):
                ids = [machine.encode(t or "") for t in batch.column(text).to_pylist()]
                ends = np.cumsum([0, *(len(x) // 4 for x in ids)], dtype=np.int64)
                values = pa.array(np.frombuffer(b"".join(ids), "<i4"))
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)
                yield _replaced(batch, text, lists, into)

    return docs.mapInArrow(run, _output(docs, text, into, T.ArrayType(T.IntegerType())))


def _offsets(column: pa.Array) -> np.ndarray:
    lengths = pa.compute.fill_null(
        pa.compute.binary_length(column) if pa.types.is_string(column.type) or pa.types.is_large_string(column.type)
        else pa.compute.list_value_length(column), 0,
    )
    return np.concatenate([[0], np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))])


def decode(encoded: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Add ``into``: the tokens of ``ids``, special ones included, as the library's decode gives them.

    The file names no decoder, so the library joins the vocabulary's own spellings by one blank. No ids give an empty
    text, null ids too.
    """
    fields = [f for f in encoded.schema.fields if f.name != into] + [T.StructField(into, T.StringType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = Tokenizer.from_file(path)
        if library.decoder is not None:
            raise ValueError("this file decodes in another way")
        spelled = [library.id_to_token(i) or "" for i in range(library.get_vocab_size())]
        for whole in batches:
            sizes = np.diff(_offsets(whole.column(ids))) * 4
            for batch in _portions(whole, sizes):
                column = batch.column(ids)
                flat, ends = column.flatten().to_numpy(), _offsets(column)
                texts = [" ".join(map(spelled.__getitem__, flat[a:b].tolist())) for a, b in zip(ends, ends[1:])]
                kept = [n for n in batch.schema.names if n != into]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(n) for n in kept), pa.array(texts, pa.string())], names=[*kept, into]
                )

    return encoded.mapInArrow(run, T.StructType(fields))
