"""Toxicity, quality rules, URL reputation, license scans, fingerprints and near-copies."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from helpers import ODD, SF, WORD, empty_documents, odd_documents
from pyspark.sql import functions as F

from ledgerloom.llm import fingerprints, licenses, minmax, quality, queries, reputation, toxicity


def documents(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


# Toxicity


def test_ordinal_model_orders_grades_and_shares_weights():
    rows = [({"fine": 3, f"w{i}": 1}, 0) for i in range(60)] + [({"bad": 1, "fine": 2, f"w{i}": 1}, 1) for i in range(30)] + [({"bad": 4, "awful": 3}, 2) for _ in range(30)]
    grade = np.array([g for _, g in rows])
    model = toxicity.fit(toxicity.Encoded.of(rows, (4,)), grade)
    above = model.above(np.array([model.score(c) for c in ({"fine": 5}, {"bad": 1, "fine": 2}, {"bad": 4, "awful": 3})]))
    assert list(model.thresholds) == sorted(model.thresholds) and len(model.thresholds) == 2
    assert above.sum(1)[0] < 0.5 < above.sum(1)[1] < 1.5 < above.sum(1)[2]


def test_held_out_accuracy(spark):
    base = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    model = toxicity.train(docs, labels.filter("doc_id % 2 = 0"))
    got = toxicity.score_documents(docs, model).join(labels.filter("doc_id % 2 = 1").select("doc_id", F.col("toxic").alias("truth")), "doc_id").select("toxic", "truth").collect()
    hit = sum(r["toxic"] and r["truth"] == 1 for r in got)
    assert hit >= 0.9 * sum(r["truth"] for r in got) and sum(r["toxic"] and r["truth"] == 0 for r in got) <= 0.005 * len(got)


def test_toxicity_of_odd_rows(spark):
    labels = spark.createDataFrame([(0, None), (7, 1), (7, 0), (None, 1), (999, 1), (14, 0)], "doc_id long, toxic int")
    model = toxicity.train(odd_documents(spark), labels)
    out = toxicity.score_documents(odd_documents(spark), model)
    assert out.count() == len(ODD) + 2 and out.filter("expected_severity IS NULL OR toxic IS NULL").count() == 0
    none = toxicity.train(empty_documents(spark), labels)
    assert toxicity.score_documents(odd_documents(spark), none).filter("toxic").count() == 0


# Quality


def plain_measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_measures_of_odd_rows(spark):
    rows = [*ODD, "a b c d e a b c d e", "x x x x x x x", "l one\nl one\n \n \nl two\nl one", "a b c d e f\x0ba b\x0cc d\re"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    for r in quality.measure_quality(docs).collect():
        assert tuple(r[c] for c in quality.BASE) == plain_measures(r["text"]), repr((r["text"] or "")[:40])
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]) and not (r["base_failed"] and r["kept"])
    assert quality.measure_quality(empty_documents(spark)).count() == 0


def test_cascade_orders_and_stops(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rules = quality.filter_rules()
    found = {e.name: e for e in quality.estimate_rules(docs.limit(200), rules)}
    ordered = quality.order_rules(rules, list(found.values()))
    assert [found[r.name].worth for r in ordered] == sorted((e.worth for e in found.values()), reverse=True)
    stop = [quality.Rule("first", lambda w, t: F.size(w) >= 0), quality.Rule("never", lambda w, t: F.raise_error(F.lit("evaluated")).cast("boolean"))]
    out = docs.select(quality.let(quality.words(docs["text"]), lambda w: quality.cascade(stop, w, docs["text"])).alias("f")).distinct().collect()
    assert [r["f"] for r in out] == ["first"]
    every = {quality.cascade(order, F.col("w"), F.col("text")) is not None for order in (rules, rules[::-1])}
    assert every == {True}


def test_verdict_ignores_the_order_and_keeps_clean_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality.judge_quality(docs).join(labels, "doc_id").select("failed_rule", "quality", "text").collect()
    rejected_clean = [r for r in got if r["failed_rule"] and r["quality"] == 1 and len(WORD.findall(r["text"] or "")) >= 10]
    assert len(rejected_clean) <= 0.01 * len(got)
    assert sum(r["failed_rule"] is not None for r in got if r["quality"] == 0) >= 0.9 * sum(r["quality"] == 0 for r in got)


# URLs


def test_rules_and_url_parts(spark):
    urls = [None, "", "no scheme.org/x", "http://A.Example.ORG/en/1x?q", "https://example.org/es/", "https://example.org?x=/es/", "http://org/", "http://xorg/fr/", "x://b.com/fr/#", "x://com/de/?", "ftp://u@h.net:80/p#q", "a://b://c/d"]
    pages = spark.createDataFrame([(i, u, "h", "clash", "v") for i, u in enumerate(urls)], "page_id long, url string, html string, host string, verdict string")
    none = spark.createDataFrame([(3, None), (None, 1), (99, 1)], "page_id long, bad int")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in reputation.judge_urls(pages, none, queries.URL_RULES).collect()}
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[3] == ("a.example.org", "/en/1x", "example.org/en/1", "block")
    assert got[4][2:] == ("example.org/es/", "block") and got[5] == ("example.org", "", None, "allow")
    assert got[6][2:] == ("org/", "allow") and got[7][2] is None and got[8][2:] == ("com/fr/", "allow") and got[9][2:] == ("com/de/", "block")
    assert got[10][:2] == ("u@h.net:80", "/p") and got[11][:2] == ("b:", "//c/d")
    assert reputation.judge_urls(pages.limit(0), none, []).count() == 0


def test_shrinkage(spark):
    pages = spark.createDataFrame([(i, "x://bad.a.com/") for i in range(60)] + [(100 + i, "x://good.a.com/") for i in range(60)] + [(200, "x://new.a.com/"), (300, "x://one.b.com/")], "page_id long, url string")
    outcomes = spark.createDataFrame([(i, 1) for i in range(60)] + [(100 + i, 0) for i in range(60)] + [(300, 1), (300, 0)], "page_id long, bad int")
    got = {r["host"]: r for r in reputation.judge_urls(pages, outcomes, []).collect()}
    assert got["bad.a.com"]["verdict"] == "block" and got["good.a.com"]["verdict"] == "allow"
    assert got["new.a.com"]["n_outcomes"] == 0 and 0.3 < got["new.a.com"]["bad_share"] < 0.7
    assert got["one.b.com"]["bad_share"] < 1 and got["one.b.com"]["bad_bound"] < got["bad.a.com"]["bad_bound"]


# Licenses


def brute_alignment(text, template):
    """Length of the longest common subsequence, an upper bound of any alignment."""
    row = [0] * (len(template) + 1)
    for w in text:
        last = row[:]
        for j, v in enumerate(template):
            row[j + 1] = last[j] + 1 if v == w else max(row[j], last[j + 1])
    return row[-1]


def test_patience_alignment():
    assert licenses.longest_increasing([3, 1, 2, 5, 4]) in ([1, 2, 3], [1, 2, 4])
    for text, template in (("a b c d", "a b c d"), ("x a b y c d z", "a b c d"), ("a a b c", "a b c"), ("q", "a b"), ("d c b a", "a b c d"), ("a x b a y b c", "a b a b c")):
        pairs = licenses.align(text.split(), template.split())
        assert all(text.split()[i] == template.split()[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
        assert len(pairs) <= brute_alignment(text.split(), template.split())
    assert len(licenses.align("x a b y c d z".split(), "a b c d".split())) == 4


def test_license_scan(spark):
    mit = licenses.TEMPLATES["mit-permission"]
    texts = ["word " * 500 + "Released under the\nMIT license. " + "more " * 500, mit.replace("free of charge", "free"), "the MIT license of the work", None, "", "ALL RIGHTS RESERVED", "rights all reserved"]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, license string")
    got = {r["doc_id"]: r for r in licenses.scan_licenses(docs).collect()}
    assert (got[0]["license"], got[0]["coverage"], got[0]["first_word"], got[0]["end_word"]) == ("mit", 1.0, 500, 505)
    assert got[1]["license"] == "mit-permission" and 0.8 <= got[1]["coverage"] < 1
    assert [got[i]["license"] for i in (2, 3, 4, 5, 6)] == [None, None, None, "all-rights-reserved", None]
    assert licenses.scan_licenses(empty_documents(spark)).count() == 0 and licenses.scan_licenses(odd_documents(spark)).count() == len(ODD) + 2


def test_license_scan_takes_the_best_window():
    scanner = licenses.Scanner()
    prepared = {k: v for k, v in scanner.words_of().items() if len(v) <= 20}
    plain = {k: " ".join(v) for k, v in prepared.items()}
    texts = ["MIT License. Released under the MIT License.", "Apache License, Version 2.0. Licensed under the Apache License, Version 2.0."]
    texts += [f"{k} license the of. {head} {v} {tail}" for k, v in plain.items() for head, tail in (("the work is under this license:", "the license under"), (v[len(v) // 2 :], v[: len(v) // 3]))]
    for text in texts:
        words = licenses.WORD.findall(text.lower())
        best = 0
        for name, template in prepared.items():
            span = scanner.stretch * len(template)
            matched = max(len(licenses.align(words[max(0, end - span) : end], template)) for end in range(1, len(words) + 1))
            best = max(best, matched if matched / len(template) >= scanner.min_coverage else 0)
        assert scanner.scan(text, prepared)[2] >= best > 0, text
    assert [scanner.scan(t, prepared)[:2] for t in texts[:2]] == [("mit", 1.0), ("apache-2.0", 1.0)]


def test_license_scan_asks_for_the_identifying_words(spark):
    texts = [
        "Licensed under CC BY 4.0.", "Licensed under CC BY-SA 4.0.", "Released under the BSD License.", "Licensed under the Apache License, Version 1.1.",
        "This work is licensed under the GNU General Public License, version 2.", "This work is licensed under the GNU Lesser General Public License, version 3.",
        "Dual licensed under the MIT License and the Apache License, Version 2.0. " + "word " * 300 + "Released under the MIT License. All rights reserved.",
        licenses.TEMPLATES["apache-2.0-notice"],
    ]
    wrong = {"cc-by-nc-4.0", "mit", "gpl-3.0", "apache-2.0"}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.scan_licenses(docs).collect()}
    assert not any(got[i]["license"] in wrong for i in range(6))
    two = got[6]["licenses"]
    assert [(x["license"], x["first_word"], x["end_word"]) for x in two] == [("apache-2.0", 1, 12), ("mit", 1, 6), ("mit", 312, 317), ("all-rights-reserved", 317, 320)]
    assert tuple(two[0]) == tuple(got[6][f] for f in ("license", "coverage", "matched_words", "first_word", "end_word"))
    assert [x["license"] for x in got[7]["licenses"]] == ["apache-2.0-notice"]


DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE REGENTS AND CONTRIBUTORS ``AS IS'' AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO,
THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE REGENTS OR CONTRIBUTORS BE LIABLE FOR
ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution. """
GPL = """# Frob is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by
# the Free Software Foundation, either version {} of the License, or (at your option) any later version.
# Frob is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {}General Public License for more details."""


@pytest.mark.parametrize(("text", "name"), [
    (BSD + DISCLAIMER, "bsd-2-clause"),
    (BSD + "3. Neither the name of the University nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. " + DISCLAIMER, "bsd-3-clause"),
    (GPL.format("", "3", ""), "gpl-3.0-notice"), (GPL.format("", "2", ""), "gpl-2.0-notice"), (GPL.format("Lesser ", "3", "Lesser "), "lgpl-3.0-notice"),
    (GPL.format("Lesser ", "2.1", "Lesser "), "lgpl-2.1-notice"), (GPL.format("Affero ", "3", "Affero "), "agpl-3.0-notice"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, you can get one at http://mozilla.org/MPL/2.0/.", "mpl-2.0"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND ISC DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL ISC BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.", "isc"),
    ("The text is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "cc-by-sa-4.0"), ("Released under CC BY 4.0.", "cc-by-4.0"),
    ("To the extent possible under law, Jo Doe has waived all copyright and related or neighboring rights to this work.", "cc0-1.0"),
])
def test_license_scan_of_common_wordings(text, name):
    scanner = licenses.Scanner()
    prepared = scanner.words_of()
    for body in (text, "intro " * 400 + text + " more" * 400):
        assert [x[0] for x in scanner.scan_all(body, prepared)] == [name]


def test_op10_finds_every_license_line(spark):
    lines = [licenses.TEMPLATES[k] for k in ("apache-2.0", "gpl-3.0", "mit", "cc-by-nc-4.0", "all-rights-reserved")]
    docs = documents(spark)
    got = {r["doc_id"]: r["license"] for r in queries.op10_license_scan(spark, SF).collect()}
    assert len(got) == len(docs)
    for doc, text in docs.items():
        assert (got[doc] is not None) == any(line in text for line in lines)


# Fingerprints


def jaccard(a, b):
    x, y = Counter(WORD.findall(a)), Counter(WORD.findall(b))
    return sum((x & y).values()) / max(1, sum((x | y).values())) if x or y else 1.0


def edits(rows):
    out = []
    for i, (doc, text) in enumerate(rows):
        half = len(text) // 2
        after = rows[(i + 1) % len(rows)][1]
        out.append((doc, text, text[: len(text) - half] + after[:half], after))
    return out


def test_op9_edits_and_likeness(spark):
    expected = edits(sorted(documents(spark).items()))
    got = {r["doc_id"]: r for r in queries.op9_fingerprints(spark, SF).collect()}
    assert len(got) == len(expected)
    off = []
    for doc, text, edited, after in expected:
        r = got[doc]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r["near_next"] == 1.0 or text != after
        off += [r["near_edited"] - jaccard(text, edited), r["near_next"] - jaccard(text, after)]
    assert abs(np.mean(off)) < 0.02 and np.std(off) < 1 / np.sqrt(fingerprints.SAMPLES)
    by_text = {}
    for doc, text, _, _ in expected:
        assert by_text.setdefault(text, got[doc]["fingerprint"]) == got[doc]["fingerprint"]


def test_collision_rate_is_the_generalised_jaccard(spark):
    pairs = [("a " * 5 + "b c", "a a b b d"), ("x y z", "x y z w"), ("p " * 30, "p " * 10), ("k l", "m n"), ("a b " * 20 + "c", "a b " * 15 + "c d e")]
    docs = spark.createDataFrame([(2 * i + k, p[k]) for i, p in enumerate(pairs) for k in (0, 1)], "key long, text string")
    got = {r["key"]: r["signature"] for r in fingerprints.signatures(fingerprints.weighted_terms(docs, ["key"]), ["key"], samples=2000).collect()}
    for i, (a, b) in enumerate(pairs):
        assert abs(np.mean(np.array(got[2 * i]) == np.array(got[2 * i + 1])) - jaccard(a, b)) < 0.05


@pytest.mark.parametrize("n", [15_000, 300_000])
def test_collision_rate_of_long_texts(spark, n):
    """Texts of n terms, of which 58 % are shared, of weights 1 to 3."""
    weight = lambda by: F.ln((1 + F.col("id") % by).cast("double")).alias("log_weight")
    ids = [spark.range(0, n, 1, 8).select(F.lit(0).alias("key"), "id", weight(2)), spark.range(42 * n // 100, 142 * n // 100, 1, 8).select(F.lit(1).alias("key"), "id", weight(3))]
    terms = ids[0].union(ids[1]).select("key", F.xxhash64("id").alias("term"), "log_weight")
    x, y = (Counter({i: 1 + i % by for i in span}) for by, span in ((2, range(n)), (3, range(42 * n // 100, 142 * n // 100))))
    true = sum((x & y).values()) / sum((x | y).values())
    got = {r["key"]: np.array(r["signature"]) for r in fingerprints.signatures(terms, ["key"], samples=2000).collect()}
    assert abs((got[0] == got[1]).mean() - true) < 0.03


def test_fingerprints_of_odd_rows(spark):
    rows = [(i * 5000, t) for i, t in enumerate(ODD)] + [(-3, "negative id"), (64, "a b"), (64, "a b"), (65, "c d")]
    docs = spark.createDataFrame([*rows, (None, "lost words here")], "doc_id long, text string").withColumn("n_chars", F.lit("clash"))
    got = fingerprints.fingerprint_edits(docs).collect()
    expected = Counter((d, len(t), hashlib.sha256(e.encode()).hexdigest()) for d, t, e, _ in edits(sorted((d, t or "") for d, t in rows)))
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got if r["doc_id"] is not None) == expected
    lost = [r for r in got if r["doc_id"] is None]
    assert len(lost) == 1 and lost[0]["near_next"] is None and lost[0]["edited_sha256"] == hashlib.sha256(b"lost wor").hexdigest()
    assert fingerprints.fingerprint_edits(empty_documents(spark)).count() == 0


# Near-copies


def brute_classes(docs, size, percent=80):
    sets = {}
    for doc, text in docs.items():
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
        sets[doc] = {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    root = {d: d for d in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    at = {}
    for d, s in sets.items():
        for g in s:
            at.setdefault(g, []).append(d)
    near = {(a, b) for ds in at.values() for a in ds for b in ds if a < b}
    for a, b in near:
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in docs}


@pytest.mark.parametrize("base", [SF, "/root/testdata/sf0.01"])
def test_op7_equals_brute_force(spark, base):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{base}/documents.parquet").collect()}
    expected = brute_classes(docs, 4)
    got = {r["doc_id"]: r for r in queries.op7_minmax_dedup(spark, base).collect()}
    assert {d: (r["n_shingles"], r["component_id"]) for d, r in got.items()} == expected
    assert all(r["kept"] == (d == r["component_id"]) for d, r in got.items())


def family(n=260):
    """A base text of 100 words, copies with some words changed, chains of further copies, and strangers
    that share one long passage."""
    draw = np.random.default_rng(3)
    words = [f"w{i}" for i in range(100)]
    docs = {}
    for k in range(n):
        copy = list(docs[int(draw.integers(0, k))].split()) if k and k % 3 == 0 else list(words)
        for p in draw.integers(0, 100, int(draw.integers(1, 7))):
            copy[p] = f"c{k}x{p}"
        docs[k] = " ".join(copy)
    for k in range(n, n + 80):
        docs[k] = " ".join([f"s{k}w{i}" for i in range(40)] + words[:60])
    return docs


def test_large_family_equals_brute_force_in_small_blocks(spark):
    docs = family()
    policy = minmax.NearDuplicates(shingle=5, block=16)
    rows = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minmax.near_duplicates(rows, policy).collect()}
    assert got == brute_classes(docs, 5)


def test_signatures_pass_over_no_pair_at_the_threshold():
    """20,000 pairs of sets of exactly 0.8: none is lost before the full sets are compared."""
    policy, draw = minmax.NearDuplicates(margin=minmax.SAFE_MARGIN), np.random.default_rng(11)
    hasher = minmax.MinMax(policy)
    for _ in range(20_000):
        hashes = draw.integers(0, 2**64, 50, np.uint64)
        x, y = (hasher.signature(np.sort(h)).astype(np.uint8) for h in (hashes[:45], hashes[5:]))
        assert minmax._estimate(x, y) >= policy.possible


def test_least_hashes_leave_every_link_possible():
    policy, draw = minmax.NearDuplicates(sample=64), np.random.default_rng(3)
    for size in (1, 5, 40, 64, 300, 2000):
        one = np.unique(draw.integers(0, 2**32, size, np.uint32))
        others = [np.unique(np.concatenate([one[draw.random(len(one)) < keep], draw.integers(0, 2**32, 1 + int(size * (1 - keep)), np.uint32)])) for keep in draw.uniform(0.4, 1, 300)]
        exact = np.array([len(np.intersect1d(one, o)) / len(np.union1d(one, o)) for o in others])
        found, possible = minmax._sampled(one[:64], [o[:64] for o in others], policy)
        assert possible[exact >= 0.8].all()
        assert not possible[exact < 0.5].any() or size < 64
        if size == 40:
            assert np.allclose(found, exact)


def test_near_duplicates_of_odd_rows(spark):
    got = minmax.near_duplicates(odd_documents(spark).withColumn("kept", F.lit("clash"))).collect()
    assert len(got) == len(ODD) + 2
    lost = [r for r in got if r["doc_id"] is None]
    assert lost[0]["component_id"] is None and lost[0]["kept"]
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], r)
    assert by[9 * 7]["component_id"] == 9 * 7 and by[17 * 7]["component_id"] == 9 * 7 and by[2 * 7]["n_shingles"] == 0
    assert minmax.near_duplicates(empty_documents(spark)).count() == 0
