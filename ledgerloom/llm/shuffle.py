"""A uniform shuffle of a table into shards of exact sizes: a hypergeometric communication matrix.

The rows lie in local partitions of known sizes, and every shard is to get an exact number of rows,
at most one more than any other. How many rows of each partition go to each shard, in a uniform
shuffle, is a matrix with these row and column sums; its rows are multivariate hypergeometric. Given
the matrix, each partition deals its rows by a permutation of its own labels, the rows are exchanged,
and each shard permutes what it received.

Nobody holds the matrix. The partitions are the leaves of a binary tree, in which a node splits its
column counts between its children by hypergeometric draws from a generator keyed by the node. A
task walks down to the partitions that it reads, so all it needs is the size of each partition: one
number a partition goes through the driver. Below a partition the tree goes on to blocks of a
bounded number of rows, so a task never holds the labels of more than a block at a time.

Retries agree: the rows are saved once with a number of their own (partition and place), and all
draws are functions of the seed and of that number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import cut_lineage

#: ``monotonically_increasing_id`` keeps the partition above these bits and the place below them.
PLACE_BITS = 33


@dataclass(frozen=True)
class Shuffle:
    shards: int = 40
    seed: int = 2029
    #: Rows whose labels are drawn and permuted together.
    block_rows: int = 4096
    #: Rows of a shard that one task sorts, about.
    part_rows: int = 50_000


def generator(seed: int, kind: int, low: int, high: int) -> np.random.Generator:
    """The generator of one node: the counter sets its stream apart from all others."""
    return np.random.Generator(np.random.Philox(key=seed, counter=[0, kind, low, high]))


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` from ``good + bad`` items are good, for numbers of any size.

    Inversion over the ratios of neighbouring probabilities, outward from the mode. What lies
    beyond the range looked at has less probability than a double can tell from nothing.
    """
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    total = good + bad
    mode = min(max((draws + 1) * (good + 1) // (total + 2), low), high)
    spread = math.sqrt(draws * (good / total) * (bad / total) * ((total - draws) / max(total - 1, 1)))
    reach = int(12 * spread) + 60
    first, last = max(low, mode - reach), min(high, mode + reach)
    x = np.arange(first, last, dtype=np.float64)
    logs = np.concatenate(([0.0], np.cumsum(np.log((good - x) * (draws - x) / ((x + 1) * (bad - draws + x + 1))))))
    weights = np.cumsum(np.exp(logs - logs.max()))
    return first + min(int(np.searchsorted(weights, rng.random() * weights[-1], side="right")), last - first)


def split_counts(rng: np.random.Generator, counts: np.ndarray, rows: int) -> np.ndarray:
    """How ``rows`` drawn from items of several kinds, ``counts`` of each, are spread over the kinds."""
    out = np.zeros_like(counts)
    rest = int(counts.sum())
    for kind, here in enumerate(counts.tolist()):
        if not rows:
            break
        rest -= here
        out[kind] = hypergeometric(rng, here, rest, rows)
        rows -= int(out[kind])
    return out


class Dealer:
    """Rows of the communication matrix, and labels of blocks, as they are asked for."""

    def __init__(self, sizes: np.ndarray, config: Shuffle):
        self.config = config
        self.starts = np.concatenate(([0], np.cumsum(sizes)))
        whole, extra = divmod(int(self.starts[-1]), config.shards)
        self.shard_sizes = np.full(config.shards, whole, np.int64)
        self.shard_sizes[:extra] += 1
        # The way down to the last leaf of each tree; neighbours share most of it.
        self._cells: list[tuple[int, int, np.ndarray]] = []
        self._blocks: tuple[int, list[tuple[int, int, np.ndarray]]] = (-1, [])

    def _walk(self, way: list, leaf: int, top: tuple[int, int, np.ndarray], kind: int, rows_of) -> np.ndarray:
        while way and not way[-1][0] <= leaf < way[-1][1]:
            way.pop()
        if not way:
            way.append(top)
        low, high, counts = way[-1]
        while high - low > 1:
            middle = (low + high) // 2
            left = split_counts(generator(self.config.seed, kind, low, high), counts, rows_of(low, middle))
            low, high, counts = (low, middle, left) if leaf < middle else (middle, high, counts - left)
            way.append((low, high, counts))
        return counts

    def matrix_row(self, cell: int) -> np.ndarray:
        """The rows that partition ``cell`` sends to each shard."""
        rows_of = lambda low, high: int(self.starts[high] - self.starts[low])
        return self._walk(self._cells, cell, (0, len(self.starts) - 1, self.shard_sizes), 1, rows_of)

    def labels(self, cell: int, block: int) -> np.ndarray:
        """The shard of each row of a block, in the order of the rows."""
        size, step = int(self.starts[cell + 1] - self.starts[cell]), self.config.block_rows
        if self._blocks[0] != cell:
            self._blocks = (cell, [(0, -(-size // step), self.matrix_row(cell))])
        rows_of = lambda low, high: min(high * step, size) - low * step
        counts = self._walk(self._blocks[1], block, (0, -(-size // step), self.matrix_row(cell)), 2 + 2 * cell, rows_of)
        return generator(self.config.seed, 3 + 2 * cell, block, 0).permutation(np.repeat(np.arange(self.config.shards, dtype=np.int32), counts))


def dealt(sizes: np.ndarray, config: Shuffle):
    """Column function: the number of a row to its shard."""
    @F.pandas_udf("int")
    def shard(numbers: Iterator[pd.Series]) -> Iterator[pd.Series]:
        dealer = Dealer(sizes, config)
        for part in numbers:
            number = part.to_numpy(np.int64)
            cell, place = number >> PLACE_BITS, number & ((1 << PLACE_BITS) - 1)
            out = np.empty(len(number), np.int32)
            block = place // config.block_rows
            heads = np.flatnonzero(np.concatenate(([True], (np.diff(cell) != 0) | (np.diff(block) != 0)))) if len(number) else []
            for start, end in zip(heads, [*heads[1:], len(number)], strict=True):
                out[start:end] = dealer.labels(int(cell[start]), int(block[start]))[place[start:end] - block[start] * config.block_rows]
            yield pd.Series(out)

    return shard


def shuffle_rows(rows: DataFrame, config: Shuffle = Shuffle()) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``: shards of exact sizes, in a uniform order.

    Slots run from 0 without a gap in each shard. Shard sizes differ by one at most, the first
    shards having the extra rows.

    Defined results: every row gets a place, whatever its columns hold (nulls, empty or very long
    texts); repeated rows are rows of their own; with fewer rows than shards the last shards are
    empty; an empty table gives no rows; columns named shard or slot give way to the result's.
    """
    kept = [c for c in rows.columns if c.lower() not in ("shard", "slot")]
    mark = "_".join(["row", *sorted(kept, key=len)[-1:]])
    saved = cut_lineage(rows.select(*[F.col(f"`{c}`") for c in kept], F.monotonically_increasing_id().alias(mark)), "shuffle-rows")
    counted = saved.groupBy(F.shiftright(mark, PLACE_BITS).cast("int").alias("cell")).count().collect()
    sizes = np.zeros(max([1 + r["cell"] for r in counted], default=1), np.int64)
    for r in counted:
        sizes[r["cell"]] = r["count"]
    parts = max(1, -(-int(sizes.sum()) // (config.shards * config.part_rows)))
    shard = dealt(sizes, config)
    order = F.xxhash64(F.lit(config.seed), mark)

    def place(df: DataFrame) -> DataFrame:
        placed = df.withColumn("shard", shard(mark))
        # The high bits pick the part of a shard, so the parts in order are the shard in order.
        part = F.floor(F.shiftrightunsigned(order, 32) * F.lit(parts) / F.lit(float(1 << 32))).cast("int")
        return placed.withColumn(f"{mark}_part", part).withColumn(f"{mark}_order", F.shiftrightunsigned(order, 1))

    part, key = f"{mark}_part", f"{mark}_order"
    sums = place(saved.select(mark)).groupBy("shard", part).count()
    before = Window.partitionBy("shard").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("shard", part, F.coalesce(F.sum("count").over(before), F.lit(0)).alias(f"{mark}_start"))
    within = Window.partitionBy("shard", part).orderBy(key, mark)
    ranked = place(saved).withColumn(f"{mark}_rank", F.row_number().over(within) - 1)
    slots = ranked.join(starts, ["shard", part])
    return slots.select(*[F.col(f"`{c}`") for c in kept], "shard", (F.col(f"{mark}_start") + F.col(f"{mark}_rank")).cast("long").alias("slot"))


def write_shards(shuffled: DataFrame, folder: str) -> None:
    """Each shard as Parquet files in ``folder``/shard=N, a file's rows in the order of their slots."""
    shuffled.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)


def shard_documents(docs: DataFrame, config: Shuffle = Shuffle()) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text plus 16), text_crc32, law, shard, slot and grown_shard of every document.

    A null text has no bytes. The law is ``rows``; a shard more would deal all rows anew, so
    grown_shard is null.
    """
    bytes_ = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return shuffle_rows(docs.select("doc_id", "text"), config).select(
        "doc_id", (F.octet_length(bytes_) + 16).cast("long").alias("size"), F.crc32(bytes_).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
