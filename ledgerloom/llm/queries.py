"""The registered queries of the text operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, centroids, fingerprints, licenses, minmax, packing, prefix_trie, quality, reputation, shuffle, token_counts, token_store, toxicity
from ledgerloom.llm.units import library_counts
from ledgerloom.session import scratch_path

URL_RULES = [
    reputation.Rule("allow", "org/"), reputation.Rule("block", "example.org/es/"), reputation.Rule("block", "example.org/en/1"),
    reputation.Rule("allow", "com/fr/"), reputation.Rule("block", "com/de/"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    coded = bpe.code_documents(table(spark, sf_dir, "documents"), path, pattern)
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model).drop("text")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measure_quality(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    manifest, folder = token_store.store_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return token_store.read_files(manifest, folder)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after inserting all documents, recounting the labelled ones without symbols, deleting
    those of low quality, and sending the recount twice."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    labels = table(spark, sf_dir, "labels").filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))

    def versions(df: DataFrame, op: str) -> DataFrame:
        """A change for each of two versions: the vocabulary's ids, and words."""
        words = F.coalesce(F.size(quality.words(F.col("text"))), F.lit(0)).cast("long")
        counted = library_counts(df.select("doc_id", "source", "lang", words.alias("words"), "text"), path)
        both = F.array(F.struct(F.lit("byte_bpe_50k").alias("tokenizer"), "n_tokens"), F.struct(F.lit("words").alias("tokenizer"), F.col("words").alias("n_tokens")))
        return counted.select(F.lit(op).alias("op"), "doc_id", "source", "lang", F.explode(both).alias("v")).select("op", "doc_id", "source", "lang", "v.*")

    store = token_counts.DocumentCounts(spark, scratch_path(spark, "token-counts"))
    # A text without symbols keeps its count; texts are counted before the join, so none is shuffled.
    cleaned = docs.withColumn("raw", F.col("text")).withColumn("text", F.regexp_replace("text", quality.SYMBOLS, "")).filter("text <> raw").drop("raw")
    recount = versions(cleaned, "revise").join(labels.select("doc_id"), "doc_id")
    gone = labels.filter("quality = 0").select(
        F.lit("delete").alias("op"), "doc_id", F.lit(None).cast("string").alias("source"), F.lit(None).cast("string").alias("lang"),
        F.explode(F.array(F.lit("byte_bpe_50k"), F.lit("words"))).alias("tokenizer"), F.lit(None).cast("long").alias("n_tokens"))
    store.apply("load", versions(docs, "insert"))
    store.apply("recount", recount)
    store.apply("drop", gone)
    store.apply("recount", recount)
    return store.totals()


def op7_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.near_duplicates(table(spark, sf_dir, "documents"), minmax.NearDuplicates(shingle=4, margin=minmax.SAFE_MARGIN))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(F.col("quality").isNotNull() & F.col("toxic").isNotNull(), 0)
    outcomes = labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return reputation.judge_urls(table(spark, sf_dir, "pages"), outcomes, URL_RULES)


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op11_shard_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shuffle.shard_documents(table(spark, sf_dir, "documents"))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_byte_bpe, op2_toxicity, op3_quality_rules, op4_token_files, op5_best_fit_packing, op6_token_counts, op7_minmax_dedup, op8_url_filter, op9_fingerprints, op10_license_scan,
              op11_shard_shuffle, op12_centroid_clusters, op13_prefix_trie)
}
ORACLES: dict[str, str] = {"op3_quality_rules": quality.quality_sql(), "op8_url_filter": reputation.judge_sql(URL_RULES),
                           "op12_centroid_clusters": centroids.cluster_sql(), "op13_prefix_trie": prefix_trie.trie_sql()}
