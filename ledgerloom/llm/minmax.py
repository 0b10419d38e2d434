"""Near-duplicate classes by min-max hashing, banding and confirmed links.

A document's set holds the hashes of its word shingles. Under each permutation both the least and the
greatest value are kept, so a signature of 2 p values takes p hash evaluations a shingle; each value
of two sets is equal with the probability of their Jaccard similarity. Bands of four values name the
buckets in which two documents can meet: at a similarity of 0.8 a pair misses all 32 bands with a
probability of 5e-8.

Documents of equal sets are one representative from the start. Then

1. every representative is compared with one leader of each of its buckets, and confirmed pairs are
   joined into classes;
2. in buckets that still hold several classes, the members outside the leader's class are compared
   with all others in blocks of bounded size, by signature and then by the ``sample`` least hashes of
   their sets, which for sets of no more hashes is the whole set. Only pairs of different classes
   that both leave possible go on: first the most alike pair of each member and class, then, where
   that didn't join them, all of them.

A link counts only where the full sets confirm it, and no step caps partners: what one step leaves
apart the next one decides. Pairs within a class are never listed. Signatures and least hashes only
spare comparisons: at ``SAFE_MARGIN`` deviations, at which ``near_duplicates`` runs, a pair at the
threshold is passed over by them with a probability of about 2e-9, less than that of missing all bands.

Classes are connected components, computed over tables in the shared folder.

Defined results: a null text or one without words has the empty set, a class of its own and links
with nothing; a text of fewer words than a shingle has its whole word sequence as its only shingle.
Of rows that repeat a doc_id each has the class of its own set; sets of the same least doc_id share
a class. Rows without a doc_id are returned with null class and
kept true. An empty table gives no rows. Other columns are dropped.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import cut_lineage

#: White space between words, as bytes; every other character is part of a word.
BLANK = b" \t\n\x0b\x0c\r"
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + BLANK, b"abcdefghijklmnopqrstuvwxyz" + b" " * len(BLANK))

#: Deviations of the estimates at which no link is passed over.
SAFE_MARGIN = 7.0


@dataclass(frozen=True)
class NearDuplicates:
    """``percent``: similarity of a link; ``block``: rows of a bucket that are compared in one group;
    ``sample``: hashes of a set that travel to a block; ``margin``: standard deviations that estimates
    are allowed, 4 of them passing over one link of 10,000."""

    shingle: int = 5
    percent: int = 80
    permutations: int = 64
    rows: int = 4
    margin: float = 4.0
    block: int = 1024
    sample: int = 512
    seed: int = 20250707

    @property
    def bands(self) -> int:
        return 2 * self.permutations // self.rows

    @property
    def possible(self) -> float:
        """The least share of equal values at which a pair may reach the similarity."""
        j = self.percent / 100
        return j - self.margin * (j * (1 - j) / (2 * self.permutations)) ** 0.5


class WordHashes(dict):
    """64-bit hashes of words; forgets all of them at ``limit``."""

    limit = 500_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


@functools.lru_cache(maxsize=1)
def _word_hashes() -> WordHashes:
    return WordHashes()


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """The ascending distinct 64-bit hashes of a text's shingles."""
    parts = (text or "").encode().translate(LOWER).split(b" ")
    words = [w for w in parts if w] if b"" in parts else parts
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_word_hashes().__getitem__, words), np.uint64, len(words))
    n = max(1, len(words) - size + 1)
    mixed = np.full(n, len(words) if len(words) < size else size, np.uint64)
    for k in range(min(size, len(words))):
        mixed = (mixed ^ h[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


class MinMax:
    """Signatures of shingle sets: the minimum and maximum under each permutation."""

    def __init__(self, policy: NearDuplicates):
        import xxhash

        self.policy = policy
        draw = np.random.default_rng(policy.seed)
        self.factor = (draw.integers(0, 2**31, (policy.permutations, 1), np.uint32) << np.uint32(1)) | np.uint32(1)
        self.shift = draw.integers(0, 2**32, (policy.permutations, 1), np.uint32)
        self.hash64 = xxhash.xxh3_64_intdigest

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        least = np.full(self.policy.permutations, 0xFFFFFFFF, np.uint32)
        most = np.zeros(self.policy.permutations, np.uint32)
        for start in range(0, len(x), 1024):
            values = x[None, start : start + 1024] * self.factor + self.shift
            values ^= values >> np.uint32(15)
            np.minimum(least, values.min(1), out=least)
            np.maximum(most, values.max(1), out=most)
        # The two values of a permutation lie in different bands.
        return np.concatenate([least, most])

    def bands(self, signature: np.ndarray) -> list[int]:
        """One signed 64-bit bucket name for each band."""
        rows = self.policy.rows
        raw = signature.astype("<u4").tobytes()
        return [self.hash64(b.to_bytes(2, "little") + raw[4 * rows * b : 4 * rows * (b + 1)]) - 2**63 for b in range(self.policy.bands)]


SKETCH = "doc_id long, n_shingles long, set_key binary, signature binary, bands array<long>"


def sketches(docs: DataFrame, policy: NearDuplicates, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document. ``signature`` holds one byte for each value, for estimates."""

    def sketch(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        hasher = MinMax(policy)
        for part in parts:
            n, key, short, bands = [], [], [], []
            for text_ in part.column(1).to_pylist():
                found = shingle_set(text_, policy.shingle)
                n.append(len(found))
                if not len(found):
                    key.append(None), short.append(None), bands.append(None)
                    continue
                full = hasher.signature(found)
                key.append(xxhash.xxh3_128_digest(found.astype("<u8").tobytes()))
                short.append((full & np.uint32(0xFF)).astype(np.uint8).tobytes())
                bands.append(hasher.bands(full))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(short, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "set_key", "signature", "bands"])

    return docs.select(docs[doc_id].cast("long"), docs[text]).mapInArrow(sketch, SKETCH)


def shingle_sets(docs: DataFrame, policy: NearDuplicates) -> DataFrame:
    """(rep, shingles, least) of (rep, text); ``least`` packs the high halves of the least hashes."""

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            sets = [shingle_set(t, policy.shingle) for t in part.column(1).to_pylist()]
            least = [(s[: policy.sample] >> np.uint64(32)).astype("<u4").tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())), pa.array(least, pa.binary())],
                ["rep", "shingles", "least"])

    return docs.select("rep", "text").mapInArrow(cut, "rep long, shingles array<long>, least binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("_x"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("_y"))
    both = F.size(F.array_intersect("_x", "_y"))
    return pairs.join(left, "a").join(right, "b").filter(100 * both >= percent * (F.size("_x") + F.size("_y") - both)).select("a", "b")


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, label) of (node, label) after joining what ``links`` (a, b) connect.

    Labels are the least label reachable. Each round takes the least label among a class and its
    neighbours and then follows labels of labels, until none changes; a class is contracted to its
    label, so rounds run over the classes that links touch.
    """
    at = nodes.select(F.col("node").alias("a"), F.col("label").alias("x"))
    to = nodes.select(F.col("node").alias("b"), F.col("label").alias("y"))
    edges = cut_lineage(links.join(at, "a").join(to, "b").filter("x <> y").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct(), "edges")
    if edges.isEmpty():
        return nodes
    roots = edges.select(F.col("x").alias("old"), F.col("x").alias("new")).union(edges.select(F.col("y"), F.col("y"))).distinct()
    both = edges.union(edges.select("y", "x"))
    while True:
        near = both.join(roots.select(F.col("old").alias("y"), "new"), "y").select(F.col("x").alias("old"), "new")
        least = roots.union(near).groupBy("old").agg(F.min("new").alias("new"))
        least = cut_lineage(least, "labels")
        jumped = least.alias("l").join(least.select(F.col("old").alias("new"), F.col("new").alias("next")), "new").select("old", F.col("next").alias("new"), (F.col("next") != F.col("new")).alias("moved"))
        changed = least.join(roots.select("old", F.col("new").alias("was")), "old").filter("new <> was")
        if changed.isEmpty():
            roots = least
            break
        roots = cut_lineage(jumped.select("old", "new"), "labels")
    moved = roots.filter("old <> new").select(F.col("old").alias("label"), "new")
    return cut_lineage(nodes.join(moved, "label", "left").select("node", F.coalesce("new", "label").alias("label")), "classes")


def _estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity of rows of byte signatures; chance agreement of one byte is taken out."""
    share = (a == b).mean(-1)
    return (share - 1 / 256) / (1 - 1 / 256)


def _sampled(one: np.ndarray, others: list[np.ndarray], policy: NearDuplicates) -> tuple[np.ndarray, np.ndarray]:
    """Similarity of a set to others by their least hashes, and whether it leaves a link possible.

    Hashes up to the lesser of the two last ones are known of both sets. Where neither set was cut,
    that is all of them; where one was, ``margin`` standard deviations are allowed for. One hash is
    allowed for in any case, as two may share their high half.
    """
    every = np.uint32(0xFFFFFFFF)
    last = np.array([o[-1] if len(o) >= policy.sample else every for o in others], np.uint32)
    last = np.minimum(last, one[-1] if len(one) >= policy.sample else every)
    sizes = np.fromiter(map(len, others), np.int64, len(others))
    starts = np.cumsum(sizes) - sizes
    hashes = np.concatenate(others)
    known = hashes <= np.repeat(last, sizes)
    place = np.minimum(np.searchsorted(one, hashes), len(one) - 1)
    both = np.add.reduceat(known & (one[place] == hashes), starts, dtype=np.int64)
    union = np.add.reduceat(known, starts, dtype=np.int64) + np.searchsorted(one, last, "right") - both
    j = policy.percent / 100
    least = np.where(last == every, j, j - policy.margin * np.sqrt(j * (1 - j) / np.maximum(union, 1)))
    return both / np.maximum(union, 1), both + 1 >= least * (union - 1)


def leader_pairs(shared: DataFrame, reps: DataFrame, policy: NearDuplicates) -> DataFrame:
    """Distinct (a, b) of members and their buckets' leaders that the signatures leave possible."""
    pairs = shared.filter("rep <> leader").select(F.col("rep").alias("a"), F.col("leader").alias("b")).distinct()
    left = reps.select(F.col("rep").alias("a"), F.col("signature").alias("x"), F.col("n_shingles").alias("n"))
    right = reps.select(F.col("rep").alias("b"), F.col("signature").alias("y"), F.col("n_shingles").alias("m"))
    sized = pairs.join(left, "a").join(right, "b").filter(_sizes_fit(F.col("n"), F.col("m"), policy))

    def keep(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            x, y = (np.frombuffer(b"".join(part.column(k).to_pylist()), np.uint8).reshape(part.num_rows, -1) for k in (2, 3))
            fits = pa.array(_estimate(x, y) >= policy.possible) if part.num_rows else pa.array([], pa.bool_())
            yield part.select(["a", "b"]).filter(fits)

    return sized.select("a", "b", "x", "y").mapInArrow(keep, "a long, b long")


def _sizes_fit(n: Column, m: Column, policy: NearDuplicates) -> Column:
    return 100 * F.least(n, m) >= policy.percent * F.greatest(n, m)


def crossing_pairs(shared: DataFrame, reps: DataFrame, sets: DataFrame, classes: DataFrame, policy: NearDuplicates, best: bool) -> DataFrame:
    """(a, b) of members of one bucket and different classes that may be alike.

    ``a`` is a member outside its bucket's main class. A bucket is cut into blocks by a hash; each
    block of outside members meets each block of all members in a group of its own. With ``best``,
    each ``a`` comes with the most alike member of each other class only.
    """
    labelled = shared.join(classes.select(F.col("node").alias("rep"), "label"), "rep")
    labelled = labelled.join(classes.select(F.col("node").alias("leader"), F.col("label").alias("main")), "leader")
    mixed = labelled.groupBy("bucket").agg(F.count_if(F.col("label") != F.col("main")).alias("outside")).filter("outside > 0")
    rows = labelled.join(mixed, "bucket").join(reps.select("rep", "signature", "n_shingles", "bands"), "rep").join(sets.select("rep", "least"), "rep")
    cuts = lambda n: F.ceil(n / F.lit(policy.block)).cast("int")
    slot = lambda n: F.pmod(F.xxhash64("rep", "bucket"), cuts(n)).cast("int")
    columns = ["bucket", "out_block", "block", "rep", "label", "signature", "n_shingles", "bands", "least", "asks"]
    members = rows.withColumn("block", slot(F.col("size"))).withColumn("out_block", F.explode(F.sequence(F.lit(0), cuts(F.col("outside")) - 1)))
    members = members.withColumn("asks", F.lit(False)).select(*columns)
    asking = rows.filter("label <> main").withColumn("out_block", slot(F.col("outside"))).withColumn("block", F.explode(F.sequence(F.lit(0), cuts(F.col("size")) - 1)))
    asking = asking.withColumn("asks", F.lit(True)).select(*columns)

    def compare(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        asks = np.array(table.column("asks").to_pylist())
        rep, label, n = (np.array(table.column(c).to_pylist(), np.int64) for c in ("rep", "label", "n_shingles"))
        signature = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8).reshape(len(rep), -1)
        bands = np.array(table.column("bands").to_pylist(), np.int64)
        least = [np.frombuffer(x, "<u4") for x in table.column("least").to_pylist()]
        own = int(np.flatnonzero(bands[0] == bucket)[0])
        every = np.flatnonzero(~asks)
        out: list[list] = [[], [], [], []]
        for i in np.flatnonzero(asks):
            fits = every[(label[every] != label[i]) & (100 * np.minimum(n[every], n[i]) >= policy.percent * np.maximum(n[every], n[i]))]
            # A pair belongs to the first band that it shares.
            fits = fits[~(bands[fits, :own] == bands[i, :own]).any(1)]
            fits = fits[_estimate(signature[fits], signature[i]) >= policy.possible]
            if not len(fits):
                continue
            likely, possible = _sampled(least[i], [least[k] for k in fits], policy)
            fits, likely = fits[possible], likely[possible]
            if best:
                fits, likely = fits[np.argsort(-likely, kind="stable")], np.sort(likely)[::-1]
                first = np.unique(label[fits], return_index=True)[1]
                fits, likely = fits[first], likely[first]
            for column, values in zip(out, (np.full(len(fits), rep[i]), rep[fits], label[fits], likely), strict=True):
                column.append(values)
        a, b, to, e = (np.concatenate(c) if c else np.zeros(0) for c in out)
        return pa.table({"a": pa.array(a.astype(np.int64)), "b": pa.array(b.astype(np.int64)), "label": pa.array(to.astype(np.int64)), "estimate": pa.array(e.astype(float))})

    found = members.union(asking).groupBy("bucket", "out_block", "block").applyInArrow(compare, "a long, b long, label long, estimate double")
    if best:
        found = found.groupBy("a", "label").agg(F.max(F.struct("estimate", "b")).alias("m")).select("a", F.col("m.b").alias("b"))
    return found.select("a", "b").distinct()


def near_duplicates(docs: DataFrame, policy: NearDuplicates = NearDuplicates(margin=SAFE_MARGIN), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    rows = cut_lineage(sketches(docs, policy, doc_id, text), "sketches")
    known = rows.filter("doc_id IS NOT NULL AND set_key IS NOT NULL")
    best = F.min(F.struct("doc_id", "n_shingles", "signature", "bands"))
    reps = cut_lineage(known.groupBy("set_key").agg(best.alias("r")).select("set_key", F.col("r.doc_id").alias("rep"), "r.n_shingles", "r.signature", "r.bands"), "reps")
    spread = reps.select(F.explode("bands").alias("bucket"), "rep")
    buckets = spread.groupBy("bucket").agg(F.count("*").alias("size"), F.min("rep").alias("leader")).filter("size > 1")
    shared = cut_lineage(spread.join(buckets, "bucket"), "shared")
    sharing = shared.select("rep").distinct()
    texts = docs.select(docs[doc_id].cast("long").alias("rep"), docs[text].alias("text")).join(sharing, "rep")
    sets = cut_lineage(shingle_sets(texts, policy), "sets")
    classes = reps.select(F.col("rep").alias("node"), F.col("rep").alias("label")).distinct()
    classes = components(classes, cut_lineage(confirmed(leader_pairs(shared, reps, policy), sets, policy.percent), "links"))
    for best in (True, False):
        crossing = cut_lineage(crossing_pairs(shared, reps, sets, classes, policy, best), "crossing")
        classes = components(classes, cut_lineage(confirmed(crossing, sets, policy.percent), "links"))
    named = reps.select("set_key", F.col("rep").alias("node")).join(classes, "node").select("set_key", "label")
    out = rows.join(named, "set_key", "left").withColumn("component_id", F.coalesce("label", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
