"""Best-fit packing of documents into sequences of a fixed capacity, by exact complements.

Only the number of pieces of each length decides a packing, and there are at most ``capacity``
lengths. Spark counts them; the plan is made on that bounded table and joined back to the pieces by
their rank within their length.

The plan indexes which lengths are available as single, pair and triple sums. From the longest piece
on, it looks up the combination whose sum is exactly the gap, and consumes it as often as the counts
allow; each step uses up a length or leaves one copy, so the plan doesn't grow with the corpus. What
no combination fills goes best-fit decreasing into the tightest open sequence, in bulk.

Defined results: a null or empty text is a document of the end id alone; an empty table gives no
rows. A document above the capacity is cut so that all its pieces but the first are full. Rows that
repeat a doc_id are packed as separate documents; rows without a doc_id are packed too.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.units import library_memo, slices
from ledgerloom.session import cut_lineage


@dataclass(frozen=True)
class Pattern:
    """``times`` sequences that each hold pieces of these lengths, in this order."""

    lengths: tuple[int, ...]
    times: int


class Complements:
    """Which lengths, pairs and triples of available pieces have a given sum."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts

    def single(self, gap: int) -> tuple[int, ...] | None:
        return (gap,) if gap < len(self.counts) and self.counts[gap] > 0 else None

    def pair(self, gap: int, most: int | None = None) -> tuple[int, ...] | None:
        """The pair with the longest first piece, which is at most ``most`` long."""
        top = min(gap - 1, len(self.counts) - 1, gap if most is None else most)
        low = (gap + 1) // 2
        if top < low:
            return None
        first = np.arange(top, low - 1, -1)
        fits = (self.counts[first] > 0) & (self.counts[gap - first] > (first == gap - first))
        at = int(fits.argmax())
        return (int(first[at]), gap - int(first[at])) if fits[at] else None

    def triple(self, gap: int) -> tuple[int, ...] | None:
        for first in range(min(gap - 2, len(self.counts) - 1), (gap + 2) // 3 - 1, -1):
            if self.counts[first] > 0:
                self.counts[first] -= 1
                rest = self.pair(gap - first, most=first)
                self.counts[first] += 1
                if rest:
                    return (first, *rest)
        return None

    def find(self, gap: int) -> tuple[int, ...] | None:
        return self.single(gap) or self.pair(gap) or self.triple(gap)


def _times(counts: np.ndarray, lengths: tuple[int, ...]) -> int:
    return min(int(counts[length]) // n for length, n in Counter(lengths).items())


def exact_fills(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Consume from ``counts`` what fills sequences without a rest."""
    plan: list[Pattern] = []
    index = Complements(counts)
    if counts[capacity]:
        plan.append(Pattern((capacity,), int(counts[capacity])))
        counts[capacity] = 0
    for length in range(capacity - 1, 0, -1):
        while counts[length] > 0:
            counts[length] -= 1
            rest = index.find(capacity - length)
            counts[length] += 1
            if rest is None:
                break
            lengths = (length, *rest)
            times = _times(counts, lengths)
            for used in lengths:
                counts[used] -= times
            plan.append(Pattern(lengths, times))
    return plan


def best_fit(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Best-fit decreasing of what is left; equal pieces and equal sequences are handled together."""
    open_: dict[int, list[Pattern]] = {}  # by gap

    def keep(pattern: Pattern) -> None:
        open_.setdefault(capacity - sum(pattern.lengths), []).append(pattern)

    for length in range(capacity, 0, -1):
        left = int(counts[length])
        counts[length] = 0
        while left:
            gap = min((g for g in open_ if g >= length), default=None)
            if gap is None:
                each = capacity // length
                full, rest = divmod(left, each)
                if full:
                    keep(Pattern((length,) * each, full))
                if rest:
                    keep(Pattern((length,) * rest, 1))
                break
            pattern = open_[gap].pop()
            if not open_[gap]:
                del open_[gap]
            each = gap // length
            full = min(pattern.times, left // each)
            if full:
                keep(Pattern(pattern.lengths + (length,) * each, full))
                left -= full * each
            if full < pattern.times:
                rest = min(left, each)
                if rest:
                    keep(Pattern(pattern.lengths + (length,) * rest, 1))
                    left -= rest
                if pattern.times - full - (rest > 0):
                    keep(Pattern(pattern.lengths, pattern.times - full - (rest > 0)))
    return [p for patterns in open_.values() for p in patterns]


def packing_plan(histogram: dict[int, int], capacity: int) -> list[Pattern]:
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens can't be packed into {capacity}")
        counts[length] = n
    return exact_fills(counts, capacity) + best_fit(counts, capacity)


def plan_rows(plan: list[Pattern]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset): which ranks of a length go where."""
    used: Counter[int] = Counter()
    rows, sequence = [], 0
    for pattern in plan:
        offset = 0
        for length in pattern.lengths:
            rows.append((length, used[length], used[length] + pattern.times, sequence, offset))
            used[length] += pattern.times
            offset += length
        sequence += pattern.times
    return rows


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, path: str, end_id: int, capacity: int, doc_id: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """The pieces of every document, one row each; ``keep_ids`` adds their packed ids."""

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = library_memo(path)
        end = np.array([end_id], "<u4").tobytes()
        for part in (rows for batch in parts for rows in slices(batch)):
            columns: tuple[list, ...] = ([], [], [], [], [], [])
            for row, packed in enumerate(memo.pack(part.column(1).to_pylist())):
                ids = packed + end
                n = len(ids) // 4
                start, piece = 0, 0
                while start < n:
                    length = (n % capacity or capacity) if piece == 0 else capacity
                    body = ids[4 * start : 4 * (start + length)]
                    for column, value in zip(columns, (row, piece, start, length, zlib.crc32(body), body), strict=True):
                        column.append(value)
                    start, piece = start + length, piece + 1
            arrays = [part.column(0).take(pa.array(columns[0], pa.int64())), pa.array(columns[1], pa.int32())]
            arrays += [pa.array(c, pa.int64()) for c in columns[2:5]] + ([pa.array(columns[5], pa.binary())] if keep_ids else [])
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids)

    rows = docs.select(docs[doc_id].cast("long"), docs[text])
    return rows.mapInArrow(cut, PIECES + (", ids binary" if keep_ids else ""))


def pack_pieces(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``. ``pieces`` is read three times: write it first.

    Ranks within a length come from salted windows: the number of salts is the square root of the
    number of pieces, so neither a window of pieces nor the table of counts for one length grows
    with more than that root.
    """
    spark = pieces.sparkSession
    # At most ``capacity`` rows.
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = plan_rows(packing_plan(histogram, capacity))
    if len(plan) > 64 * capacity:
        raise ValueError("the packing plan is larger than its bound")
    salts = int(max(1, sum(histogram.values())) ** 0.5) + 1
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    cells = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("_within", F.row_number().over(within) - 1).join(cells, ["length", "_salt"])
    ranked = ranked.withColumn("_rank", F.col("_base") + F.col("_within"))
    places = spark.createDataFrame(plan or [(0, 0, 0, 0, 0)], "_length long, _lo long, _hi long, _sequence long, _offset long")
    fits = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_lo")) & (F.col("_rank") < F.col("_hi"))
    return ranked.join(F.broadcast(places), fits).select(
        *pieces.columns, (F.col("_sequence") + F.col("_rank") - F.col("_lo")).alias("sequence_id"), F.col("_offset").alias("offset"))


def pack_documents(docs: DataFrame, path: str, end_id: int = 2, capacity: int = 1024, doc_id: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per piece of every document with its sequence and place there."""
    return pack_pieces(cut_lineage(token_pieces(docs, path, end_id, capacity, doc_id, text, keep_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: the ids of each one's pieces in order (needs ``keep_ids``).

    A group holds at most ``capacity`` ids.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.aggregate(parts, F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"])).alias("ids"))
