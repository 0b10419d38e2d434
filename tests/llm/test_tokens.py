"""Encoders against the libraries, files and packings against plain restatements."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from helpers import ODD, SF, empty_documents, odd_documents
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, packing, queries, token_counts, token_store
from ledgerloom.llm.units import LibraryEncoder, UnitMemo
from ledgerloom.session import scratch_path


def library(name):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(P.path(name))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def rank_encoder():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def texts_of(spark):
    return [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]


def mixed(n=300):
    draw = random.Random(5)
    signs = "ab c\n\t .,!'sé漢1\x00~\x1c\x85\xa0\u2003\r🙂Σ"
    return ["".join(draw.choice(signs) for _ in range(draw.randrange(40))) for _ in range(n)]


def test_pair_tree_equals_the_rank_library(spark):
    expected = rank_encoder()
    ranks, memo = bpe.vocabulary(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    texts = [t or "" for t in ODD + mixed()] + texts_of(spark)
    for text, packed in zip(texts, memo.pack(texts), strict=True):
        assert np.frombuffer(packed, "<u4").tolist() == expected(text), repr(text[:60])
        assert ranks.decode(packed) == text.encode()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_units_equal_the_library_on_whole_texts(spark, name):
    expected, encoder = library(name), LibraryEncoder(P.path(name))
    texts = ODD + mixed() + texts_of(spark)
    memo = UnitMemo(encoder.cut, encoder.encode_units, limit=500)  # forgets often
    for text, packed in zip(texts, memo.pack(texts), strict=True):
        assert np.frombuffer(packed, "<u4").tolist() == expected(text), repr((text or "")[:60])


def test_op1_digests(spark):
    expected = rank_encoder()
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op1_byte_bpe(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = np.array(expected(docs[r["doc_id"]]), "<u4")
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()


def test_bpe_keeps_other_columns_and_empty_tables(spark):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    out = bpe.decode_documents(bpe.encode_documents(odd_documents(spark), path, P.PATTERN), path, P.PATTERN)
    assert [bytes(r["decoded"]) for r in out.collect()] == [(r["text"] or "").encode() for r in odd_documents(spark).collect()]
    assert "label" in out.columns and bpe.encode_documents(empty_documents(spark), path, P.PATTERN).count() == 0


@pytest.mark.parametrize("values", [[0], [0, 0, 0], list(range(0, 3000, 3)), [5, 5, 10**12], sorted(random.Random(1).randrange(10**9) for _ in range(1000))])
def test_elias_fano_round_trip(values):
    coded = token_store.EliasFano.from_bytes(token_store.EliasFano.of(np.array(values)).to_bytes())
    assert coded.all().tolist() == values
    assert [coded.get(i) for i in range(0, len(values), 7)] == values[::7]
    if len(values) == 1000:
        assert 8 * (len(coded.low) + len(coded.high)) < 1000 * (np.log2(10**9 / 1000) + 3)


def expected_starts(rows, encode):
    at, out = 0, []
    for doc, text in rows:
        ids = np.array([*encode(text), 2], "<u4")
        out.append((doc, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_op4_files(spark):
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = sorted(map(tuple, queries.op4_token_files(spark, SF).collect()))
    assert got == expected_starts(rows, library("word_bpe_49k.json"))


def test_token_files_of_odd_rows(spark):
    manifest, folder = token_store.store_documents(odd_documents(spark), P.path("word_bpe_49k.json"))
    got = token_store.read_files(manifest, folder).collect()
    encode = library("word_bpe_49k.json")
    assert Counter((r["doc_id"], r["n_tokens"]) for r in got) == Counter((r["doc_id"], len(encode(r["text"])) + 1) for r in odd_documents(spark).collect())
    starts = sorted(r["start"] for r in got)
    assert starts[0] == 0 and [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])][0] is None
    manifest, folder = token_store.store_documents(empty_documents(spark), P.path("word_bpe_49k.json"))
    assert token_store.read_files(manifest, folder).count() == 0


def test_files_close_at_their_size(spark):
    rows = spark.createDataFrame([(i, bytes(4 * 10)) for i in range(100)], "doc_id long, ids binary").coalesce(1)
    saved = scratch_path(spark, "manifest")
    folder = scratch_path(spark, "files")
    token_store.write_files(rows, folder, file_ids=95).write.parquet(saved)
    manifest = spark.read.schema(token_store.MANIFEST).parquet(saved)
    assert manifest.count() == 10
    assert token_store.read_files(manifest, folder).rdd.getNumPartitions() == 10  # not one task for all files
    assert sorted(r["start"] for r in token_store.read_files(manifest, folder).collect()) == list(range(0, 1000, 10))


def check_packing(rows, capacity=1024):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_op5_packing(spark):
    encode = library("byte_bpe_50k.json")
    rows = queries.op5_best_fit_packing(spark, SF).collect()
    total = sum(r["length"] for r in rows)
    assert check_packing(rows) <= -(-total // 1024) * 1.02 + 1
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert pieces.keys() == docs.keys()
    for doc, text in docs.items():
        ids = np.array([*encode(text), 2], "<u4")
        at = 0
        for k, (piece, start, length, crc) in enumerate(sorted(pieces[doc])):
            assert (piece, start, crc) == (k, at, zlib.crc32(ids[at : at + length].tobytes())) and (k == 0 or length == 1024)
            at += length
        assert at == len(ids) and (len(pieces[doc]) == 1 or at > 1024)


def test_packing_of_odd_rows(spark):
    rows = packing.pack_documents(odd_documents(spark), P.path("byte_bpe_50k.json"), capacity=16, keep_ids=True)
    got = rows.collect()
    check_packing(got, 16)
    assert Counter(r["doc_id"] for r in got if r["piece"] == 0) == Counter(r["doc_id"] for r in odd_documents(spark).collect())
    joined = packing.sequences(rows).collect()
    assert sum(len(r["ids"]) for r in joined) == 4 * sum(r["length"] for r in got)
    assert packing.pack_documents(empty_documents(spark), P.path("byte_bpe_50k.json")).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once_and_is_bounded(seed):
    draw = random.Random(seed)
    counts = {draw.randrange(1, 65): draw.randrange(1, 10 ** draw.randrange(1, 8)) for _ in range(draw.randrange(1, 64))}
    plan = packing.packing_plan(counts, 64)
    placed = Counter()
    for p in plan:
        assert sum(p.lengths) <= 64 and p.times > 0
        for length in p.lengths:
            placed[length] += p.times
    assert placed == Counter(counts)
    total = sum(k * n for k, n in counts.items())
    assert sum(p.times for p in plan) <= max(-(-total // 64), sum(n for k, n in counts.items() if k > 32)) * 1.25 + 1
    assert len(packing.plan_rows(plan)) < 64 * 64


def test_complements_fill_gaps_exactly():
    plan = packing.packing_plan({10: 4, 6: 2, 4: 2, 3: 2, 7: 2}, 10)
    assert sum(p.times for p in plan) == 8 and all(sum(p.lengths) == 10 for p in plan)
    assert packing.packing_plan({8: 1, 5: 2, 4: 1, 3: 1}, 10)[0].times == 1


def test_rollups(spark):
    store = token_counts.TokenRollup(spark, scratch_path(spark, "rollup"))
    change = "op string, source string, lang string, tokenizer string, n_tokens long, old_n_tokens long"
    assert store.totals().count() == 0
    first = spark.createDataFrame([("insert", "a", "en", "t", 5, None), ("insert", "a", "en", "t", 7, None), ("insert", None, "de", "t", None, None)], change)
    assert store.commit("1", first) and not store.commit("1", first)
    assert store.commit("2", spark.createDataFrame([("revise", "a", "en", "t", 9, 7), ("delete", None, "de", "t", 0, None)], change))
    assert store.commit("3", spark.createDataFrame([], change))
    assert [tuple(r) for r in store.totals().collect()] == [("a", "en", "t", 2, 14)]
    # A folder without its mark is a failed try.
    first.write.parquet(f"{store.folder}/batch=4")
    mark = store._path(f"{store.folder}/batch=4/_SUCCESS")
    store._fs.delete(mark, False)
    assert not store.committed("4") and store.totals().collect()[0]["docs"] == 2
    assert store.commit("4", first) and store.totals().filter("source = 'a'").collect()[0]["docs"] == 4
    with pytest.raises(Exception, match="unknown change"):
        store.commit("5", spark.createDataFrame([("move", "a", "en", "t", 1, None)], change))
    assert not store.committed("5")


def test_counts_of_documents_are_looked_up(spark):
    store = token_counts.DocumentCounts(spark, scratch_path(spark, "counts"))
    change = "op string, doc_id long, source string, lang string, tokenizer string, n_tokens long"
    rows = lambda *r: spark.createDataFrame(list(r), change).withColumn("old_n_tokens", F.lit(99)).withColumn("seq", F.lit(-1))
    assert store.totals().count() == 0 and store.counts().count() == 0
    first = rows(("insert", 1, "a", "en", "t", 5), ("insert", 1, "a", "en", "t", 5), ("insert", 2, "a", "en", "t", 7), ("insert", 2, "a", "en", None, 3), ("insert", 3, None, "de", "t", None),
                 ("insert", None, "n", "en", "t", 4), ("insert", None, "n", "en", "t", 4), ("revise", None, "n", "en", "t", 9), ("delete", None, "n", "en", "t", 4))
    assert store.apply("1", first) and not store.apply("1", first)
    total = lambda: sorted((tuple(r) for r in store.totals().collect()), key=repr)
    assert total() == sorted([("a", "en", "t", 2, 12), ("a", "en", None, 1, 3), (None, "de", "t", 1, 0), ("n", "en", "t", 2, 8)], key=repr)
    # A moved document, one revised though it was never there, one deleted twice, and one that never was.
    store.apply("2", rows(("revise", 1, "b", "fr", "t", 6), ("revise", 9, "a", "en", "t", 1), ("delete", 2, "x", "x", "t", None), ("delete", 77, "a", "en", "t", 5), ("delete", 2, "a", "en", None, 8)))
    store.apply("3", rows(("delete", 2, "a", "en", "t", 7), ("insert", 3, None, "de", "t", 8)))
    assert store.apply("4", rows()) and not store.apply("2", first)
    assert total() == sorted([("a", "en", "t", 1, 1), ("b", "fr", "t", 1, 6), (None, "de", "t", 1, 8), ("n", "en", "t", 2, 8)], key=repr)
    summed = store.counts().groupBy("source", "lang", "tokenizer").agg(F.count(F.lit(1)).alias("docs"), F.sum("n_tokens").alias("tokens")).collect()
    assert sorted((tuple(r) for r in summed), key=repr) == total()
    # A try that failed after it saved the documents leaves nothing behind.
    first.selectExpr("doc_id", "tokenizer", "source", "lang", "n_tokens").write.parquet(f"{store.folder}/documents/batch=5")
    assert store.counts().count() == 5 and store.apply("5", rows(("insert", 5, "a", "en", "t", 2))) and ("a", "en", "t", 2, 3) in total()
    with pytest.raises(Exception, match="unknown change"):
        store.apply("6", rows(("move", 1, "a", "en", "t", 1)))
    assert not store.rollup.committed("6")


def test_op6_totals(spark):
    encode = library("byte_bpe_50k.json")
    quality = {}
    for r in spark.read.parquet(f"{SF}/labels.parquet").collect():
        quality[r["doc_id"]] = min(r["quality"], quality.get(r["doc_id"], 1))
    expected = Counter()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        text = r["text"] or ""
        if quality.get(r["doc_id"]) == 0:
            continue
        if r["doc_id"] in quality:
            text = text.translate(str.maketrans("", "", "#*$%&|<>"))
        for name, n in (("byte_bpe_50k", len(encode(text))), ("words", len(text.split()))):
            expected[r["source"], r["lang"], name, "docs"] += 1
            expected[r["source"], r["lang"], name, "tokens"] += n
    got = Counter()
    for r in queries.op6_token_counts(spark, SF).collect():
        got[r["source"], r["lang"], r["tokenizer"], "docs"], got[r["source"], r["lang"], r["tokenizer"], "tokens"] = r["docs"], r["tokens"]
    assert got == expected


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_a_word_is_learnt_once_whatever_mark_follows(name):
    """Units end before punctuation, and their ids are those of the whole text all the same."""
    expected, encoder = library(name), LibraryEncoder(P.path(name))
    asked = []
    memo = UnitMemo(encoder.cut, lambda units: asked.extend(units) or encoder.encode_units(units))
    texts = ["a word. a word, a word; (word) word\u20ac. don't. x1. e\u0301. a=\u0338b \u0663. _a_ <|endoftext|>a", "\x1c \x85.", "'s.'ll a.'t", "", " ", "\u4e2d.\u00bd,"]
    assert [list(np.frombuffer(ids, "<u4")) for ids in memo.pack(texts)] == [expected(text) for text in texts]
    assert not {" word.", " word,", " word;", "word.", "word,", "word;"} & set(asked)
    many = [f" w{n}x" for n in range(1000)] + ["\x1c"]
    assert encoder.encode_units(many) == [x for unit in many for x in encoder.encode_units([unit])]
