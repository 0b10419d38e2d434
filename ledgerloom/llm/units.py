"""Texts cut into units that tokenize independently of each other, and a memo of bounded bytes over them.

Under the byte-level split patterns no match reaches from a non-space character into the white space
after it. A unit is a run of white space with the run of other characters behind it (or trailing
white space), so the ids of a text are the ids of its units in order. The library's patterns never reach
from a letter or digit into punctuation either, so there its units end too: a word is learnt once,
whatever mark comes after it. Most units of a corpus repeat,
so each task remembers the ids of as many as fit
a number of bytes; what one chunk of texts adds comes on top.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
import string
import sys
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The characters with the Unicode property White_Space.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
UNITS = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
WORDS = re.compile(f"[^{SPACE}]+")
#: Letters and digits that all versions of Unicode know as such, and the punctuation that ends a unit
#: behind them; an apostrophe may belong to the word before it.
LETTERS = "0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
MARKS = string.punctuation.replace("'", "")
_MARKS = re.escape(MARKS)
#: A plain word with the marks before it, else whatever ends at white space or where punctuation begins.
_BODY = f"[{_MARKS}]*+[{LETTERS}]++(?![^{_MARKS}{SPACE}])|[^{SPACE}]+?(?:(?<=[{LETTERS}])(?=[{_MARKS}])|(?![^{SPACE}]))"
FINE_UNITS = re.compile(f"[{SPACE}]*+(?:{_BODY})|[{SPACE}]+")
FINE_WORDS = re.compile(_BODY)

#: Bytes that each of the two generations of a task's memo may take, what one unit takes besides its
#: characters and ids, and characters that are looked up at once.
MEMO_BYTES = 120_000_000
ENTRY_BYTES = 180
CHUNK_CHARS = 500_000
#: The bytes of a generation with the library's finer units, of which fewer are distinct.
LIBRARY_BYTES = 80_000_000
#: Whether the machine's own integers are what is packed.
NATIVE = sys.byteorder == "little" and array("I").itemsize == 4
#: Units in one call of the library.
CALL_UNITS = 20_000
#: Units in one text of a call.
TEXT_UNITS = 200


def chunks(texts: list[str], chars: int = CHUNK_CHARS) -> Iterator[list[str]]:
    """``texts`` in order, in lists of about ``chars`` characters; a text is never cut."""
    part: list[str] = []
    size = 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= chars:
            yield part
            part, size = [], 0
    if part:
        yield part


class UnitMemo:
    """Packs texts by ``encode_units``, which gives the bytes of each of a list of distinct units."""

    def __init__(self, cut: Callable[[str], list[str]], encode_units: Callable[[list[str]], list[bytes]], limit: int = MEMO_BYTES):
        self.cut, self.encode_units, self.limit = cut, encode_units, limit
        self.bytes = 0
        # Units used since the last change of generations, and those of the generation before.
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _learn(self, wanted: set[str]) -> None:
        if self.bytes > self.limit:
            self.young, self.old, self.bytes = {}, self.young, 0
        new = wanted.difference(self.young)
        kept = self.old.get
        missing = [unit for unit in new if kept(unit) is None]
        added = {unit: kept(unit) for unit in new.difference(missing)}
        added.update(zip(missing, self.encode_units(missing), strict=True))
        self.young.update(added)
        # Four bytes are the most that a character of a text takes.
        self.bytes += ENTRY_BYTES * len(added) + 4 * sum(map(len, added)) + sum(map(len, added.values()))

    def pack(self, texts: list[str | None]) -> Iterator[bytes]:
        """The packed ids of every text, in order; a null text is an empty one."""
        for part in chunks([text or "" for text in texts]):
            cut = [self.cut(text) for text in part]
            self._learn(set(itertools.chain.from_iterable(cut)))
            look = self.young.__getitem__
            for units in cut:
                yield b"".join(map(look, units))


def packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers; from a list, an array is cheaper than numpy's."""
    return array("I", ids).tobytes() if NATIVE else np.array(ids, "<u4").tobytes()


class LibraryEncoder:
    """Units encoded by the ``tokenizers`` library, many in one call, each as a word of its own.

    Units go in as the words of texts that are split already, which spares the library a good part of
    what it does for a whole text; the number of the word that each id comes from tells them apart.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        # Spark gives each task its core; the library's own threads would come on top.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # White space that leaves no id means that words stand alone.
        self.spaced = bool(self._ids(" "))
        # A vocabulary that joins letters and punctuation after all keeps whole words.
        apart = all(self._ids(f"{x}{mark}a") == self._ids(x) + self._ids(f"{mark}a") for mark in MARKS for x in ("a", "e1", "\u00e9"))
        self.cut = ((FINE_UNITS if apart else UNITS) if self.spaced else (FINE_WORDS if apart else WORDS)).findall

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode_units(self, units: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for start in range(0, len(units), CALL_UNITS):
            call = units[start : start + CALL_UNITS]
            texts = [call[at : at + TEXT_UNITS] for at in range(0, len(call), TEXT_UNITS)]
            got = self.tokenizer.encode_batch(texts, is_pretokenized=True, add_special_tokens=False)
            for words, coded in zip(texts, got, strict=True):
                ids = packed(coded.ids)
                # Word numbers ascend, so those up to a unit's number end where its ids end.
                ends = 4 * np.searchsorted(np.array(coded.word_ids, np.int64), np.arange(len(words)), side="right")
                first = 0
                for end in ends.tolist():
                    out.append(ids[first:end])
                    first = end
        return out


@functools.lru_cache(maxsize=2)
def library_memo(path: str) -> UnitMemo:
    """One memo for each worker process and vocabulary file."""
    encoder = LibraryEncoder(path)
    return UnitMemo(encoder.cut, encoder.encode_units, LIBRARY_BYTES)


def library_ids(path: str):
    """Column function: text to its ids by the library, as little-endian unsigned 32-bit integers.

    A null text has no ids.
    """
    @F.pandas_udf("binary")
    def encode(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memo = library_memo(path)
        for part in texts:
            yield pd.Series(list(memo.pack(part.tolist())), dtype=object)

    return encode


def slices(part: pa.RecordBatch, rows: int = 500) -> Iterator[pa.RecordBatch]:
    """A batch in pieces, so that only few of its texts are Python objects at a time."""
    for start in range(0, part.num_rows, rows):
        yield part.slice(start, rows)


def library_counts(df: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """``df`` with the number of ids of its text in place of the text; a null text has none.

    Only counts leave the workers, and few texts at a time are Python objects there.
    """
    kept = [c for c in df.columns if c != text]

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = library_memo(path)
        for rows in (piece for part in parts for piece in slices(part)):
            lengths = pa.array([len(ids) // 4 for ids in memo.pack(rows.column(0).to_pylist())], pa.int64())
            yield pa.RecordBatch.from_arrays([*rows.columns[1:], lengths], [*kept, out])

    schema = T.StructType([*df.select(*kept).schema.fields, T.StructField(out, T.LongType())])
    return df.select(text, *kept).mapInArrow(count, schema)
