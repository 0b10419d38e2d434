"""Byte-level BPE by ranks: text to ids and back.

A match of the split pattern is merged over its byte positions: a segment tree holds, for each
position, the rank of the pair that begins there, and its root names the leftmost pair of the least
rank. A merge changes the pairs of the live neighbours only, each by one walk to the root, so a match
of n bytes costs O(n log n) however long it is.

Defined results: a null or empty text has no ids and decodes to nothing; ids outside the vocabulary
raise an error. Rows are independent, so repeated rows and ties need no rule, and other columns pass
through. An output column of the same name as an input column replaces it.
"""

from __future__ import annotations

import base64
import functools
import struct
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.units import UNITS, UnitMemo, slices


class PairTree:
    """The pair ranks of one match: least rank first, leftmost among equals."""

    def __init__(self, ranks: dict[bytes, int], piece: bytes):
        self.ranks, self.piece = ranks, piece
        n = len(piece)
        size = 1 << max(1, (n - 1).bit_length())
        self.size, self.none = size, len(ranks) * size * 4
        # A leaf holds rank * size + position, so one comparison orders by rank, then by place.
        tree = [self.none] * (2 * size)
        get = ranks.get
        for i in range(n - 1):
            rank = get(piece[i : i + 2])
            if rank is not None:
                tree[size + i] = rank * size + i
        for node in range(size - 1, 0, -1):
            a, b = tree[2 * node], tree[2 * node + 1]
            tree[node] = a if a < b else b
        self.tree = tree
        self.after = list(range(1, n + 1)) + [n]
        self.before = list(range(-1, n))

    def _put(self, i: int, key: int) -> None:
        tree = self.tree
        node = self.size + i
        tree[node] = key
        node >>= 1
        while node:
            a, b = tree[2 * node], tree[2 * node + 1]
            least = a if a < b else b
            if tree[node] == least:
                return
            tree[node] = least
            node >>= 1

    def _pair(self, i: int) -> int:
        """The key of the live pair that begins at ``i``."""
        middle = self.after[i]
        if middle >= len(self.piece):
            return self.none
        rank = self.ranks.get(self.piece[i : self.after[middle]])
        return self.none if rank is None else rank * self.size + i

    def merge(self) -> list[int]:
        tree, after, before, n = self.tree, self.after, self.before, len(self.piece)
        while tree[1] < self.none:
            i = tree[1] & (self.size - 1)
            gone = after[i]
            after[i] = after[gone]
            before[after[gone]] = i
            self._put(gone, self.none)
            self._put(i, self._pair(i))
            if before[i] >= 0:
                self._put(before[i], self._pair(before[i]))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[self.piece[i : after[i]]])
            i = after[i]
        return out


class RankVocabulary:
    """A rank file (base64 token and rank in each line) with its split pattern."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.split = regex.compile(pattern)

    def piece_ids(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        return [whole] if whole is not None else PairTree(self.ranks, piece).merge()

    def unit_bytes(self, unit: str) -> bytes:
        ids = [i for piece in self.split.findall(unit) for i in self.piece_ids(piece.encode())]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode_units(self, units: list[str]) -> list[bytes]:
        return [self.unit_bytes(unit) for unit in units]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, struct.unpack(f"<{len(ids) // 4}I", ids)))


@functools.lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str) -> tuple[RankVocabulary, UnitMemo]:
    """One vocabulary and memo for each worker process."""
    ranks = RankVocabulary(path, pattern)
    return ranks, UnitMemo(UNITS.findall, ranks.encode_units)


def bpe_ids(text: str | Column, path: str, pattern: str) -> Column:
    """The ids of a text, packed as little-endian unsigned 32-bit integers."""

    @F.pandas_udf("binary")
    def encode(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        _, memo = vocabulary(path, pattern)
        for part in texts:
            yield pd.Series(list(memo.pack(part.tolist())), dtype=object)

    return encode(text)


def bpe_bytes(ids: str | Column, path: str, pattern: str) -> Column:
    """The bytes that packed ids stand for."""

    @F.pandas_udf("binary")
    def decode(packed: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ranks, _ = vocabulary(path, pattern)
        for part in packed:
            yield pd.Series([ranks.decode(ids or b"") for ids in part], dtype=object)

    return decode(ids)


def encode_documents(df: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with the packed ids of its text."""
    return df.withColumn(out, bpe_ids(df[text], path, pattern))


def decode_documents(df: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the bytes of its packed ids."""
    return df.withColumn(out, bpe_bytes(df[ids], path, pattern))


def code_documents(df: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) of every row, encoded and decoded by the same worker."""

    def code(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, memo = vocabulary(path, pattern)
        for part in parts:
            for rows in slices(part):
                ids = list(memo.pack(rows.column(1).to_pylist()))
                decoded = pa.array([ranks.decode(x) for x in ids], pa.binary())
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(ids, pa.binary()), decoded], ["doc_id", "ids", "decoded"])

    return df.select(df[doc_id].cast("long"), df[text]).mapInArrow(code, "doc_id long, ids binary, decoded binary")
