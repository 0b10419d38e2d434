"""The prefix trie of all conversations: what they share, turn by turn, without building the trie.

Conversations lie sorted by their turns. A prefix is a range of that order, and its members are those
around any of them between which the common prefixes of neighbours (LCPs) are nowhere shorter. A
sparse table answers the least LCP of a range, so each candidate prefix finds the two ends of its
range by itself, by binary search to the left and to the right; no stack runs over the order.

The order is cut into blocks by range partitioning, each a bounded number of turns; a text travels as
a digest of 128 bits and its length. Prefixes whose range lies within a block are done there. Those
that reach over an edge of a block (at most as many an edge as the neighbours there share turns) leave
a piece in each block: all their figures but the digest of member numbers are sums and minima over
pieces. A subtree's figures are sums over its range: leaves are counted at their last member, texts at
their first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import cut_lineage

#: Hex digits of a turn's digest.
WIDE = 32
NO_ENDS = hashlib.sha256(b"").hexdigest()
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
PIECE = f"kind int, block int, {NODE}, side int, parent_side int, node string, parent_node string, chunk_no int, chunk string"
INNER, EDGE, ENDS = 0, 1, 2


@dataclass(frozen=True)
class Trie:
    #: Every ``family``-th conversation lends the first turns to those up to the next.
    family: int = 100
    #: Turns lent: crc32 of the conversation's number, modulo this.
    lent: int = 6
    #: Turns in a block, about.
    block_turns: int = 250_000
    #: Numbers of end members in a row on their way to a digest.
    chunk_ids: int = 1000


def sequences(conversations: DataFrame) -> DataFrame:
    """conv_id and turns (digest and chars, in order) of every conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    named = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct("turn", F.substring(F.sha2(named, 256), 1, WIDE).alias("digest"), F.char_length(text).alias("chars"))
    rows = conversations.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long"), turn.alias("t"))
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    return ordered.select("conv_id", F.transform("ts", lambda t: F.struct(t.digest.alias("digest"), t.chars.alias("chars"))).alias("turns"))


def rebuilt(own: DataFrame, config: Trie) -> DataFrame:
    """conv_id, key (all digests in a row) and chars of every conversation with its lent turns."""
    lenders = own.filter(F.pmod("conv_id", F.lit(config.family)) == 0).select(F.col("conv_id").alias("lender"), F.slice("turns", 1, config.lent).alias("lends"))
    joined = own.withColumn("lender", F.col("conv_id") - F.pmod("conv_id", F.lit(config.family))).join(lenders, "lender", "left")
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(config.lent)).cast("int")
    none = F.expr("CAST(array() AS array<struct<digest string, chars int>>)")
    turns = F.concat(F.coalesce(F.slice("lends", F.lit(1), h), none), F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1))))
    return joined.select("conv_id", turns.alias("t")).select("conv_id", F.array_join("t.digest", "").alias("key"), F.col("t.chars").alias("chars"))


def common(a: str, b: str) -> int:
    """How many leading turns two keys share."""
    low, high = 0, min(len(a), len(b)) // WIDE
    while low < high:
        middle = (low + high + 1) // 2
        if a.startswith(b[: WIDE * middle]):
            low = middle
        else:
            high = middle - 1
    return low


class RangeMin:
    """A sparse table: row k holds the minimum of each 2**k neighbours."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while 2 * (half := 1 << (len(self.rows) - 1)) <= len(values):
            last = self.rows[-1]
            self.rows.append(np.minimum(last[:-half], last[half:]))

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The minimum of each range, both ends included."""
        k = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        out = np.empty(len(first), self.rows[0].dtype)
        for level in np.unique(k).tolist():
            here = k == level
            row = self.rows[level]
            out[here] = np.minimum(row[first[here]], row[last[here] - (1 << level) + 1])
        return out

    def reach_right(self, start: np.ndarray, floor: np.ndarray, end: int) -> np.ndarray:
        """The greatest e of at most ``end`` such that no value behind ``start`` up to e is below ``floor``."""
        at = start.copy()
        for level in range(len(self.rows) - 1, -1, -1):
            row, to = self.rows[level], at + (1 << level)
            can = np.flatnonzero(to <= end)
            can = can[row[at[can] + 1] >= floor[can]]
            at[can] = to[can]
        return at

    def reach_left(self, start: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """The least s such that no value behind s up to ``start`` is below ``floor``."""
        at = start.copy()
        for level in range(len(self.rows) - 1, -1, -1):
            row, to = self.rows[level], at - (1 << level)
            can = np.flatnonzero(to >= 0)
            can = can[row[to[can] + 1] >= floor[can]]
            at[can] = to[can]
        return at


def block_nodes(rows: pa.Table, edges: pa.Table, chunk_ids: int) -> pa.Table:
    """The prefixes of one block of the order: whole ones, pieces at its edges, and end members of these."""
    rows = rows.sort_by([("key", "ascending"), ("conv_id", "ascending")])
    block, n = rows["block"][0].as_py(), rows.num_rows
    keys, convs = rows["key"].to_pylist(), rows["conv_id"].to_numpy()
    before, after = edges["before"][0].as_py(), edges["after"][0].as_py()
    chars = rows["chars"].combine_chunks()
    sizes = np.diff(chars.offsets.to_numpy()).astype(np.int64)
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    summed = np.concatenate(([0], np.cumsum(chars.flatten().to_numpy(zero_copy_only=False).astype(np.int64))))
    upto = lambda i, d: summed[offsets[i] + d] - summed[offsets[i]]  # noqa: E731  characters of the first d turns

    # lcp[i]: turns that row i shares with the one before; -1 at the ends of the whole order.
    lcp = np.array([-1 if before is None else common(before, keys[0]), *map(common, keys, keys[1:]), -1 if after is None else common(keys[-1], after)], np.int64)
    table, least_conv = RangeMin(lcp), RangeMin(convs)

    # A candidate is a prefix at the first row of this block that has it.
    low = lcp[:-1] + 1
    low[0] = 0
    count = np.maximum(sizes - low + 1, 0)
    pos = np.repeat(np.arange(n), count)
    depth = np.arange(len(pos)) - np.repeat(np.cumsum(count) - count, count) + low[pos]

    def extent(at: np.ndarray, deep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and last row of the prefix, and the edge it reaches over: 0 the first, 1 the last, -1 none."""
        a, b = table.reach_left(at, deep), table.reach_right(at, deep, n - 1)
        return a, b, np.where((a == 0) & (lcp[0] >= deep), 0, np.where((b == n - 1) & (lcp[n] >= deep), 1, -1))

    a, b, side = extent(pos, depth)
    pa_, pb, parent_side = extent(pos, np.maximum(depth - 1, 0))
    members = b - a + 1
    starts_here = (a > 0) | (lcp[0] < depth)

    inner = np.flatnonzero(sizes > lcp[:-1])
    inner = inner[inner > 0]
    marks = np.sort(lcp[inner] * (n + 1) + inner)
    behind = lambda row: np.searchsorted(marks, depth * (n + 1) + row, side="right")
    children = behind(b) - behind(a) + ((sizes[a] > depth) & ((a > 0) | (lcp[0] <= depth)))
    leaf = np.concatenate(([0], np.cumsum(lcp[1:] < sizes)))
    whole = upto(np.arange(n), sizes)
    all_chars = np.concatenate(([0], np.cumsum(whole)))
    new_chars = np.concatenate(([0], np.cumsum(whole - upto(np.arange(n), np.maximum(lcp[:-1], 0)))))
    above = upto(a, np.maximum(depth - 1, 0))
    first_new = np.where(starts_here, whole[a] - above, whole[a] - upto(0, max(lcp[0], 0)))
    saved = all_chars[b + 1] - all_chars[a] - members * above - (new_chars[b + 1] - new_chars[a + 1]) - first_new

    # Rows with equal turns; the end members of a prefix are those at its head that have no more turns.
    heads = np.flatnonzero(np.concatenate(([True], ~((lcp[1:-1] == sizes[1:]) & (sizes[1:] == sizes[:-1])))))
    run_end = np.repeat(np.concatenate((heads[1:], [n])), np.diff(np.concatenate((heads, [n]))))
    ends: list[str | None] = [NO_ENDS] * len(pos)
    chunks: list[tuple[int, int, str]] = []
    edge_names = {s: prefix_names(keys[row], int(most)) for s, row, most in ((0, 0, lcp[0]), (1, n - 1, lcp[n]))}
    for c in np.flatnonzero(sizes[a] == depth).tolist():
        ids = convs[a[c] : run_end[a[c]]].tolist()
        if side[c] < 0:
            ends[c] = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        else:
            chunks += [(c, k, ",".join(map(str, ids[k : k + chunk_ids]))) for k in range(0, len(ids), chunk_ids)]

    parent = least_conv.least(pa_, pb)
    edge = side >= 0
    named = [edge_names[s][d] if s >= 0 else None for s, d in zip(side.tolist(), depth.tolist(), strict=True)]
    # The parent of a prefix that reaches over an edge reaches over it too.
    parents = [edge_names[s][d - 1] if s >= 0 and d else None for s, d in zip(side.tolist(), depth.tolist(), strict=True)]
    m, extra = len(pos), len(chunks)
    fill = lambda values, kind: pa.concat_arrays([values.cast(kind), pa.nulls(extra, kind)])
    long, text = pa.int64(), pa.string()
    of = [c for c, _, _ in chunks]
    return pa.table({
        "kind": pa.array(np.concatenate((np.where(edge, EDGE, INNER), np.full(extra, ENDS))), pa.int32()),
        "block": pa.array(np.full(m + extra, block), pa.int32()),
        "conv_id": fill(pa.array(least_conv.least(a, b)), long),
        "depth": fill(pa.array(depth), long),
        "parent_conv_id": fill(pa.array(parent, mask=edge | (depth == 0) | (parent_side >= 0)), long),
        "n_convs": fill(pa.array(members), long), "n_children": fill(pa.array(children), long),
        "n_leaves": fill(pa.array(leaf[b + 1] - leaf[a]), long), "saved_tokens": fill(pa.array(saved), long),
        "ends_sha256": fill(pa.array(ends, text), text),
        "side": fill(pa.array(side), pa.int32()), "parent_side": fill(pa.array(parent_side, mask=(parent_side < 0) | (depth == 0)), pa.int32()),
        "node": pa.array(named + [named[c] for c in of], text), "parent_node": fill(pa.array(parents, text), text),
        "chunk_no": pa.array([None] * m + [k for _, k, _ in chunks], pa.int32()), "chunk": pa.array([None] * m + [t for _, _, t in chunks], text),
    })


def prefix_names(key: str, most: int) -> list[str]:
    """A digest for each of the first ``most`` prefixes of a key, the empty one included."""
    running, out = hashlib.sha256(), []
    for d in range(most + 1):
        out.append(f"{d}:{running.copy().hexdigest()}")
        running.update(key[WIDE * d : WIDE * (d + 1)].encode())
    return out


def joined_digests(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted chunks (node, chunk) to the digest of each node's chunks, one chunk in memory at a time."""
    node, running = None, None
    for part in parts:
        done: list[tuple[str, str]] = []
        for name, chunk in zip(part["node"].to_pylist(), part["chunk"].to_pylist(), strict=True):
            if name != node:
                if running is not None:
                    done.append((node, running.hexdigest()))
                node, running = name, hashlib.sha256(chunk.encode())
            else:
                running.update(b"," + chunk.encode())
        yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in done], pa.string()), pa.array([h for _, h in done], pa.string())], ["node", "digest"])
    if running is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([running.hexdigest()])], ["node", "digest"])


def shared_prefixes(sequenced: DataFrame, config: Trie = Trie()) -> DataFrame:
    """The prefixes of sequences (conv_id, key, chars): one row each, with its members and its subtree.

    ``key`` is the digests of the turns in a row and ``chars`` the lengths of their texts.
    """
    spark = sequenced.sparkSession
    turns = sequenced.agg(F.sum(F.size("chars"))).first()[0] or 0
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // config.block_turns))
    order = sequenced.repartitionByRange(blocks, "key", "conv_id").withColumn("block", F.spark_partition_id())
    order = cut_lineage(order, "order")
    along = Window.orderBy("block")
    # One row a block.
    edges = order.groupBy("block").agg(F.min("key").alias("first"), F.max("key").alias("last")).select(
        "block", F.lag("last").over(along).alias("before"), F.lead("first").over(along).alias("after"))
    chunk_ids = config.chunk_ids

    def nodes(rows: pa.Table, sides: pa.Table) -> pa.Table:
        return block_nodes(rows, sides, chunk_ids)

    pieces = cut_lineage(order.groupBy("block").cogroup(edges.groupBy("block")).applyInArrow(nodes, PIECE), "pieces")

    digests = (
        pieces.filter(F.col("kind") == ENDS).select("node", "block", "chunk_no", "chunk").repartition("node")
        .sortWithinPartitions("node", "block", "chunk_no").select("node", "chunk").mapInArrow(joined_digests, "node string, digest string")
    )
    at_edges = pieces.filter(F.col("kind") == EDGE)
    merged = at_edges.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.any_value("depth").alias("depth"), F.any_value("parent_node").alias("parent_node"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    ).join(digests, "node", "left")
    merged = cut_lineage(merged, "edges")
    parents = merged.select(F.col("node").alias("parent_node"), F.col("conv_id").alias("parent_conv_id"))
    figures = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    over = merged.join(parents, "parent_node", "left").select(
        "conv_id", "depth", "parent_conv_id", *figures, F.coalesce("digest", F.lit(NO_ENDS)).alias("ends_sha256"))
    # Looked up block by block, so that a prefix shared by very many doesn't gather them in one task.
    here = at_edges.select("node", "block", "depth", "side").join(merged.select("node", F.col("conv_id").alias("found")), "node").select(
        "block", (F.col("depth") + 1).alias("depth"), F.col("side").alias("parent_side"), "found")
    within = pieces.filter(F.col("kind") == INNER).join(here, ["block", "depth", "parent_side"], "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "found").alias("parent_conv_id"), *figures, "ends_sha256")
    return within.unionByName(over)


def conversation_trie(conversations: DataFrame, config: Trie = Trie()) -> DataFrame:
    """Every distinct prefix of the rebuilt conversations, with figures of its members and its subtree.

    Defined results: a null role or text is an empty one; turns are taken in the order of ``turn``,
    null first, and equal turn numbers in the order of a digest of role and text; repeated rows are
    turns of their own; rows without a conv_id belong to no conversation; a conversation whose lent and
    own turns are none is a member of the root alone; an empty table has no prefixes; other columns are
    not read. A conversation is one row of 36 bytes a turn, whatever the length of its texts.
    """
    return shared_prefixes(rebuilt(cut_lineage(sequences(conversations), "sequences"), config), config)


#: The unsigned CRC-32 of a text of ASCII characters, bit by bit.
CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({0}, ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""


def trie_sql(config: Trie = Trie()) -> str:
    """The same by listing every prefix of every conversation and every ancestor of every prefix."""
    return f"""WITH own AS MATERIALIZED (
      SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS ts
      FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
    heads AS (SELECT conv_id, ts, {CRC32.format('CAST(conv_id AS VARCHAR)')} % {config.lent} AS h FROM own),
    seqs AS MATERIALIZED (
      SELECT c.conv_id, list_concat(coalesce(b.ts[1:c.h], []), c.ts[c.h + 1:]) AS ts
      FROM heads c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % {config.family}),
    prefixes AS MATERIALIZED (SELECT conv_id, ts[1:d] AS p, d, len(ts) AS n FROM (SELECT *, unnest(range(len(ts) + 1)) AS d FROM seqs)),
    nodes AS MATERIALIZED (
      SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs, max(n) = d AS leaf,
        (count(*) - 1) * CASE WHEN d > 0 THEN length(p[d].text) ELSE 0 END AS w,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
      FROM prefixes GROUP BY p, d),
    below AS (
      SELECT p[1:k] AS q, k, CAST(sum(CASE WHEN leaf THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves, CAST(sum(w) AS BIGINT) AS saved_tokens,
        count(*) FILTER (d = k + 1) AS n_children
      FROM (SELECT *, unnest(range(d + 1)) AS k FROM nodes) GROUP BY p[1:k], k)
    SELECT v.conv_id, v.d AS depth, u.conv_id AS parent_conv_id, v.n_convs, b.n_children, b.n_leaves, b.saved_tokens, v.ends_sha256
    FROM nodes v JOIN below b ON b.q = v.p AND b.k = v.d LEFT JOIN nodes u ON v.d > 0 AND u.d = v.d - 1 AND u.p = v.p[1:v.d - 1]"""
