"""The shuffle into shards, centroid clustering and the prefix trie against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import SF, empty_documents, odd_documents
from pyspark.sql import functions as F

from ledgerloom.llm import centroids, prefix_trie, shuffle
from ledgerloom.llm import queries as llm

# --- shuffle -----------------------------------------------------------------------------------


def test_hypergeometric_draws_follow_the_law():
    good, bad, draws, n = 7, 9, 6, 40_000
    rng = np.random.default_rng(5)
    seen = Counter(shuffle.hypergeometric(rng, good, bad, draws) for _ in range(n))
    for k in range(draws + 1):
        p = math.comb(good, k) * math.comb(bad, draws - k) / math.comb(good + bad, draws)
        assert abs(seen[k] - n * p) < 5 * math.sqrt(n * p * (1 - p)) + 1


def test_hypergeometric_draws_of_very_many():
    rng = np.random.default_rng(6)
    good, bad, draws = 10**12, 3 * 10**12, 10**11
    sd = math.sqrt(draws * 0.25 * 0.75 * (1 - draws / (good + bad)))
    got = np.array([shuffle.hypergeometric(rng, good, bad, draws) for _ in range(200)], float)
    assert abs(got.mean() - draws / 4) < 5 * sd / math.sqrt(200) and 0.8 * sd < got.std() < 1.2 * sd


def test_hypergeometric_draws_at_the_ends():
    rng = np.random.default_rng(1)
    assert [shuffle.hypergeometric(rng, *x) for x in ((0, 5, 3), (5, 0, 3), (4, 4, 8), (4, 4, 0))] == [0, 3, 4, 0]


def test_matrix_has_exact_sums_whatever_is_asked_first():
    sizes = np.array([0, 5, 9000, 1, 0, 12_345, 7])
    config = shuffle.Shuffle(shards=6, block_rows=1000)
    matrix = [shuffle.Dealer(sizes, config).matrix_row(c) for c in range(len(sizes))]
    assert [int(r.sum()) for r in matrix] == sizes.tolist()
    columns = np.sum(matrix, axis=0)
    assert columns.max() - columns.min() <= 1
    dealer = shuffle.Dealer(sizes, config)
    for cell in (5, 2, 6, 5, 1):
        blocks = list(range(-(-int(sizes[cell]) // 1000)))
        random.Random(3).shuffle(blocks)
        labels = {b: dealer.labels(cell, b) for b in blocks}
        assert all(len(labels[b]) == min(1000, sizes[cell] - 1000 * b) for b in blocks)
        assert np.bincount(np.concatenate(list(labels.values())), minlength=6).tolist() == matrix[cell].tolist()


def test_every_row_is_as_likely_in_every_shard():
    seen, sizes = np.zeros((7, 3)), np.array([4, 3])
    for seed in range(6000):
        dealer = shuffle.Dealer(sizes, shuffle.Shuffle(shards=3, seed=seed, block_rows=2))
        row = np.concatenate([dealer.labels(c, b) for c in range(2) for b in range(2)])
        seen[np.arange(7), row] += 1
    assert np.abs(seen / 6000 - [3 / 7, 2 / 7, 2 / 7]).max() < 0.03


def places(got):
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r["shard"]].append(r["slot"])
    return by_shard


def test_shards_hold_every_document_once(spark):
    got = llm.op11_shard_shuffle(spark, SF).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    for r in got:
        raw = (docs[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 16, zlib.crc32(raw), "rows", None)
    found = places(got)
    assert set(found) == set(range(40)) and {len(s) for s in found.values()} == {5}
    assert all(sorted(s) == list(range(5)) for s in found.values())


def test_a_shuffle_keeps_odd_rows_and_agrees_with_itself(spark):
    docs = odd_documents(spark).withColumn("slot", F.lit("own")).repartition(3)
    config = shuffle.Shuffle(shards=4, part_rows=2)
    once = shuffle.shuffle_rows(docs, config)
    a, b = once.collect(), once.collect()
    assert sorted(map(repr, a)) == sorted(map(repr, b))
    assert "slot" in once.columns and once.columns.count("slot") == 1
    kept = [c for c in docs.columns if c != "slot"]
    assert sorted(map(repr, once.select(kept).collect())) == sorted(map(repr, docs.select(kept).collect()))
    assert sorted(len(s) for s in places(a).values()) == [5, 5, 5, 5] and all(sorted(s) == list(range(5)) for s in places(a).values())


def test_fewer_rows_than_shards_and_none(spark):
    few = shuffle.shuffle_rows(spark.range(3)).collect()
    assert sorted((r["shard"], r["slot"]) for r in few) == [(0, 0), (1, 0), (2, 0)]
    assert shuffle.shard_documents(empty_documents(spark)).collect() == []


def test_written_shards_read_back_in_order(spark, tmp_path):
    shuffled = shuffle.shuffle_rows(spark.range(1000).withColumn("text", F.lit("x")), shuffle.Shuffle(shards=7))
    shuffle.write_shards(shuffled, str(tmp_path / "out"))
    again = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(again.select("id", "shard", "slot").collect()) == sorted(shuffled.select("id", "shard", "slot").collect())


def test_order_within_shards_is_mixed(spark):
    got = shuffle.shuffle_rows(spark.range(0, 8000, 1, 4), shuffle.Shuffle(shards=2)).collect()
    for shard in (0, 1):
        ids = [r["id"] for r in sorted((r for r in got if r["shard"] == shard), key=lambda r: r["slot"])]
        assert abs(np.corrcoef(ids, range(len(ids)))[0, 1]) < 0.06


# --- clustering --------------------------------------------------------------------------------


@pytest.mark.parametrize("spread", [3, 1000, 1 << 26])
def test_the_search_finds_what_comparing_all_finds(spread):
    rng = np.random.default_rng(spread)
    cents = rng.integers(-spread, spread + 1, (9, 5))
    cents[4], cents[7] = cents[1], cents[2] * 0  # equal centroids, and one at the origin
    vectors = np.concatenate([rng.integers(-spread, spread + 1, (4000, 5)), cents, np.zeros((1, 5), np.int64)])
    search = centroids.Search(cents)
    found, distance = search.nearest(vectors)
    every = ((vectors[:, None] - cents[None]) ** 2).sum(axis=2)
    assert (distance == every.min(axis=1)).all() and (found == every.argmin(axis=1)).all()


def test_the_search_leaves_out_far_centroids():
    rng = np.random.default_rng(0)
    cents = rng.integers(-1000, 1000, (64, 1)) * np.ones((1, 16), np.int64) + rng.integers(-20, 20, (64, 16))
    vectors = cents[rng.integers(0, 64, 2000)] + rng.integers(-20, 20, (2000, 16))
    search = centroids.Search(cents)
    search.nearest(vectors)
    assert search.measured < 0.15 * 64 * 2000


def brute_clusters(rows, config):
    kept = []
    for i, e in rows:
        if e is not None and len(e) == config.components and all(x is not None and math.isfinite(x) for x in e):
            q = [math.floor(config.scale * x) for x in e]
            if max(map(abs, q)) <= centroids.LARGEST:
                kept.append((i, q))
    named = sorted((hashlib.sha256(f"{config.seed}:{i}".encode()).hexdigest(), q) for i, q in kept if i is not None)
    cents = [q for _, q in named[: config.clusters]]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda q: min((dist(q, c), k) for k, c in enumerate(cents))
    if not cents:
        return []
    for _ in range(config.rounds):
        groups = defaultdict(list)
        for _, q in kept:
            groups[nearest(q)[1]].append(q)
        cents = [[sum(col) // len(groups[k]) for col in zip(*groups[k], strict=True)] if groups[k] else c for k, c in enumerate(cents)]
    out = [(i, *nearest(q)[::-1]) for i, q in kept]
    each = Counter()
    for _, k, d in out:
        each[k] += d
    sha = lambda k: hashlib.sha256(",".join(map(str, cents[k])).encode()).hexdigest()
    return [(i, k, d, each[k], sum(each.values()), sha(k)) for i, k, d in out]


def test_clusters_of_odd_vectors(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(60)]
    rows += [(i, [0.25, -0.5, 1.0, 0.0]) for i in range(100, 140)]
    rows += [(5, rows[5][1]), (5, rows[5][1]), (None, [1.0, 2.0, 3.0, 4.0]), (200, None), (201, []), (202, [1.0, 2.0, 3.0]), (203, [1.0] * 5),
             (204, [1.0, None, 2.0, 3.0]), (205, [float("nan"), 0.0, 0.0, 0.0]), (206, [float("inf"), 0.0, 0.0, 0.0]), (207, [1e6, 0.0, 0.0, 0.0]), (208, [-1e5, 1e5, 0.0, 0.0])]
    config = centroids.Clustering(clusters=5, components=4)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'own' AS cluster", "1 AS packed").repartition(5)
    got = centroids.cluster_vectors(table, config)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, brute_clusters(rows, config)))


def test_fewer_vectors_than_clusters_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    config = centroids.Clustering(components=2)
    two = centroids.cluster_vectors(spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], schema), config).collect()
    assert sorted((r["vec_id"], r["distance"], r["inertia"]) for r in two) == [(1, 0, 0), (2, 0, 0)]
    none = centroids.cluster_vectors(spark.createDataFrame([(None, [1.0, 0.0]), (1, None)], schema), config)
    assert none.collect() == [] and [t for _, t in none.dtypes] == ["bigint", "int", "bigint", "bigint", "bigint", "string"]


# --- prefix trie -------------------------------------------------------------------------------


def brute_trie(rows, config):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    digest = lambda r, t: hashlib.sha256(f"{len(r)}:{r}{t}".encode()).hexdigest()[: prefix_trie.WIDE]
    own = {c: [(r, t) for _, _, r, t in sorted(ts, key=lambda x: (x[0], x[1], digest(x[2], x[3])))] for c, ts in own.items()}
    seqs = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % config.lent
        seqs[c] = tuple(own.get(c - c % config.family, [])[:h] + ts[h:])
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in children[p]) or 1
        saved[p] = sum(saved[q] for q in children[p]) + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
    ends = lambda p: ",".join(map(str, sorted(c for c in members[p] if seqs[c] == p)))
    return [(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p], hashlib.sha256(ends(p).encode()).hexdigest())
            for p, m in members.items()]


TURNS = "conv_id long, turn long, role string, text string"


def trie_of(spark, rows, config):
    got = prefix_trie.conversation_trie(spark.createDataFrame(rows, TURNS).selectExpr("*", "7 AS block", "'own' AS key").repartition(3), config)
    return sorted(map(repr, map(tuple, got.collect())))


def random_turns(seed, convs, words, longest):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(3 * convs), convs):
        for t in range(rng.randint(1, longest)):
            rows.append((c, t, rng.choice(["user", "bot"]), rng.choice(words)))
    return rows


@pytest.mark.parametrize(("seed", "convs", "words", "longest", "family"), [(1, 150, ["a", "bb"], 4, 1), (2, 200, ["a"], 9, 10), (3, 120, ["é🙂", "", "xyz", "a"], 3, 100)])
def test_trie_against_brute_force(spark, seed, convs, words, longest, family):
    config = prefix_trie.Trie(family=family, block_turns=40, chunk_ids=3)
    rows = random_turns(seed, convs, words, longest)
    assert trie_of(spark, rows, config) == sorted(map(repr, brute_trie(rows, config)))


def test_trie_of_odd_turns(spark):
    rows = [(100, None, None, None), (100, 0, "user", ""), (100, 0, "user", ""), (101, None, "user", "hi"), (None, 1, "user", "lost"), (7, 5, "", None),
            (102, 9, "x" * 40, "y" * 100_000), (103, -3, "user", "hi"), (103, 2, None, "hi")] + [(200 + i, 0, "user", "same") for i in range(40)]
    rows += [(300, t, "user", f"turn {t}") for t in range(3000)] + [(301, t, "user", f"turn {t}") for t in range(2990)]
    config = prefix_trie.Trie(block_turns=1000, chunk_ids=7)
    assert trie_of(spark, rows, config) == sorted(map(repr, brute_trie(rows, config)))


def test_trie_of_conversations_without_turns_and_of_none(spark):
    config = prefix_trie.Trie()
    # Number 1 lends nothing and gives up its only turns: h is at least 1 and its lender is absent.
    lone = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 >= 1)
    rows = [(lone, 0, "user", "gone")]
    assert trie_of(spark, rows, config) == sorted(map(repr, brute_trie(rows, config))) == [repr((lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest()))]
    assert trie_of(spark, [], config) == []


def test_least_of_ranges_and_reach():
    rng = np.random.default_rng(4)
    values = rng.integers(0, 6, 97)
    table = prefix_trie.RangeMin(values)
    first = rng.integers(0, 97, 500)
    last = np.array([rng.integers(f, 97) for f in first])
    assert table.least(first, last).tolist() == [values[f : e + 1].min() for f, e in zip(first, last, strict=True)]
    floor = rng.integers(0, 7, 500)
    right = [max(e for e in range(f, 97) if (values[f + 1 : e + 1] >= k).all()) for f, k in zip(first, floor, strict=True)]
    left = [min(s for s in range(f + 1) if (values[s + 1 : f + 1] >= k).all()) for f, k in zip(first, floor, strict=True)]
    assert table.reach_right(first, floor, 96).tolist() == right and table.reach_left(first, floor).tolist() == left
