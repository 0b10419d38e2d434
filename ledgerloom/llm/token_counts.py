"""Token counts kept up to date by signed deltas.

A batch of changes becomes one additive row per (source, language, tokenizer version): an insert
counts +1 document and +n tokens, a delete -1 and -n, a revision the difference of the counts. The
batch is committed under its id: its folder counts only once its success mark is there, and
committing an id again changes nothing, so a batch may be sent again after any failure. Totals are
the sum over the committed batches.

Defined results: a null count is 0 tokens; a null source, language or tokenizer is a group of its
own; an unknown kind of change raises an error when the batch runs; a batch without changes commits
and adds nothing; totals that come to no documents and no tokens are dropped. Repeated change rows
count each, as only whole batches are idempotent.

``DocumentCounts`` keeps the count of each document besides, so that a batch says what documents are
now and what they were is looked up, not trusted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import cut_lineage

KEYS = ("source", "lang", "tokenizer")
DELTA = "source string, lang string, tokenizer string, docs long, tokens long"


def signed_deltas(changes: DataFrame) -> DataFrame:
    """``changes`` (op, source, lang, tokenizer, n_tokens, old_n_tokens) as additive totals."""
    op, new, old = F.col("op"), F.coalesce("n_tokens", F.lit(0)), F.coalesce("old_n_tokens", F.lit(0))
    docs = F.when(op == "insert", 1).when(op == "delete", -1).when(op == "revise", 0)
    tokens = F.when(op == "insert", new).when(op == "delete", -new).when(op == "revise", new - old)
    known = F.coalesce(docs, F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce(op, F.lit("null")))).cast("int"))
    return changes.select(*KEYS, known.cast("long").alias("docs"), tokens.cast("long").alias("tokens")).groupBy(*KEYS).agg(
        F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))


class TokenRollup:
    """The batches below one folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _batch(self, batch_id: str) -> str:
        if not batch_id or "/" in batch_id:
            raise ValueError(f"not a batch id: {batch_id!r}")
        return f"{self.folder}/batch={batch_id}"

    def committed(self, batch_id: str) -> bool:
        return self._fs.exists(self._path(f"{self._batch(batch_id)}/_SUCCESS"))

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Add a batch; False if it was committed before, in which case nothing changes.

        A folder that a failed try left without its mark is written anew. One writer at a time may
        commit a given id.
        """
        if self.committed(batch_id):
            return False
        signed_deltas(changes).write.mode("overwrite").parquet(self._batch(batch_id))
        return True

    def batches(self) -> list[str]:
        """The folders of the committed batches."""
        if not self._fs.exists(self._path(self.folder)):
            return []
        paths = [s.getPath() for s in self._fs.listStatus(self._path(self.folder))]
        return sorted(p.toString() for p in paths if p.getName().startswith("batch=") and self._fs.exists(self._path(f"{p.toString()}/_SUCCESS")))

    def totals(self) -> DataFrame:
        """docs and tokens per source, language and tokenizer version."""
        found = self.batches()
        deltas = self.spark.read.schema(DELTA).parquet(*found) if found else self.spark.createDataFrame([], DELTA)
        totals = deltas.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return totals.filter("docs <> 0 OR tokens <> 0")


STATE = "doc_id long, tokenizer string, source string, lang string, n_tokens long, old_source string, old_lang string, old_n_tokens long, seq long"


class DocumentCounts:
    """Token counts per document and tokenizer version, and the totals that follow from them.

    A batch first saves, per document it changes, what it was and what it is; then the totals commit the
    difference, and with it the batch. What a try that failed has saved is written anew. Batches are
    applied one after another.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.rollup = TokenRollup(spark, f"{folder}/totals")

    def _states(self) -> list[str]:
        return [f"{self.folder}/documents/{path.rsplit('/', 1)[1]}" for path in self.rollup.batches()]

    def counts(self) -> DataFrame:
        """doc_id, tokenizer, source, lang and n_tokens of every document that is there now."""
        saved = self._states()
        rows = self.spark.read.schema(STATE).parquet(*saved) if saved else self.spark.createDataFrame([], STATE)
        # Documents without a number can't be told apart, so each row that inserts one stands for itself.
        lost = rows.filter("doc_id IS NULL").select("doc_id", "tokenizer", "source", "lang", "n_tokens")
        latest = rows.filter("doc_id IS NOT NULL").groupBy("doc_id", "tokenizer").agg(F.max(F.struct("seq", "source", "lang", "n_tokens")).alias("now"))
        return latest.filter("now.n_tokens IS NOT NULL").select("doc_id", "tokenizer", "now.source", "now.lang", "now.n_tokens").unionByName(lost)

    def apply(self, batch_id: str, changes: DataFrame) -> bool:
        """Apply ``changes`` (op, doc_id, source, lang, tokenizer, n_tokens); False if that was done before.

        An insert or a revision says what a document is from now on, a deletion that it is gone; whether
        it was there, and with which source, language and count, is looked up. Of several rows of one
        document and tokenizer in a batch the one with the greatest (op, count, source, language) counts.
        A null count is 0 tokens. Without a doc_id, inserts count each, other changes find nothing to
        change. An unknown op raises an error when the batch runs.
        """
        if self.rollup.committed(batch_id):
            return False
        op = F.col("op")
        known = F.when(op.isin("insert", "revise", "delete"), op).otherwise(F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce(op, F.lit("null")))).cast("string"))
        count = F.when(op != "delete", F.coalesce("n_tokens", F.lit(0)))
        # Counting is the costly part, so the changes are saved before they are read twice.
        rows = cut_lineage(changes.select(known.alias("op"), F.col("doc_id").cast("long"), "tokenizer", count.cast("long").alias("n_tokens"), "source", "lang"), "changes")
        one = rows.filter("doc_id IS NOT NULL").groupBy("doc_id", "tokenizer").agg(F.max(F.struct("op", "n_tokens", "source", "lang")).alias("new"))
        before = self.counts().filter("doc_id IS NOT NULL").selectExpr("doc_id", "tokenizer AS t", "source AS old_source", "lang AS old_lang", "n_tokens AS old_n_tokens")
        same = (one["doc_id"] == before["doc_id"]) & one["tokenizer"].eqNullSafe(before["t"])
        met = one.join(before, same, "left").select(one["doc_id"], "tokenizer", "new.source", "new.lang", "new.n_tokens", "old_source", "old_lang", "old_n_tokens")
        nothing = F.lit(None).cast("string")
        lost = rows.filter("doc_id IS NULL AND op = 'insert'").select(
            "doc_id", "tokenizer", "source", "lang", "n_tokens", nothing.alias("old_source"), nothing.alias("old_lang"), F.lit(None).cast("long").alias("old_n_tokens"))
        path = f"{self.folder}/documents/batch={batch_id}"
        met.unionByName(lost).withColumn("seq", F.lit(len(self.rollup.batches())).cast("long")).write.mode("overwrite").parquet(path)
        saved = self.spark.read.schema(STATE).parquet(path)
        signed = F.array(
            F.when(F.col("old_n_tokens").isNotNull(), F.struct(F.lit("delete").alias("op"), F.col("old_source").alias("source"), F.col("old_lang").alias("lang"), F.col("old_n_tokens").alias("n_tokens"))),
            F.when(F.col("n_tokens").isNotNull(), F.struct(F.lit("insert").alias("op"), "source", "lang", "n_tokens")))
        return self.rollup.commit(batch_id, saved.select("tokenizer", F.explode(F.array_compact(signed)).alias("s")).select("tokenizer", "s.*", F.lit(None).cast("long").alias("old_n_tokens")))

    def totals(self) -> DataFrame:
        return self.rollup.totals()
