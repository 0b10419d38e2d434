"""Document fingerprints by consistent weighted sampling, in built-in functions only.

Each sample of a text is one of its terms with a level of its weight, drawn so that two texts draw
the same one with the probability of their generalised Jaccard similarity (sum of the smaller over
sum of the larger weights). For sample j and term k, r and c are Gamma(2, 1) and beta is uniform, all
three derived from a hash of (k, j). With S the weight of the term,

    t = floor(ln S / r + beta),   ln a = ln c - r (t - beta + 1),

and the term with the least a is the sample. ``ln a`` is a function of (k, t, j) alone, so it stands
for the pair (k, t): equal minima are equal samples.

The rows of a task are aggregated where they lie: documents are dealt once, by groups of consecutive
ids, and windows and aggregations keep that partitioning.

Defined results: a null text is an empty one; a text without words has the fingerprint of no terms
(all samples alike), of likeness 1 to another such text and 0 to any other. The next document is the
next row by (doc_id, text), after the last row the first. Rows without a doc_id have no place in that
order: their edited text is the kept half alone and their ``near_next`` is null. Repeated rows follow
each other and are each other's next. Other columns are dropped.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.quality import BLANK
from ledgerloom.session import cut_lineage

#: Largest standard error of a likeness, and the samples that it takes: the share of n equal samples has at most 1 / (2 sqrt n).
ERROR = 0.0885
SAMPLES = math.ceil(1 / (4 * ERROR**2))
#: Consecutive doc_ids that are dealt together, and groups that are ordered together.
GROUP, SUPER = 64, 1024


def weighted_terms(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys``, ``term`` (a hash of a word) and ``log_weight``, the logarithm of how often it occurs."""
    flat = texts.select(*keys, F.explode(F.split(text, BLANK)).alias("_word")).filter("_word <> ''")
    counted = flat.groupBy(*keys, F.xxhash64("_word").alias("term")).agg(F.count("*").alias("_n"))
    return counted.select(*keys, "term", F.ln(F.col("_n").cast("double")).alias("log_weight"))


def uniforms(bits: Column) -> tuple[Column, Column]:
    """Two draws from (0, 1), of 32 bits each, of a 64-bit hash."""
    draw = lambda x: (x.cast("double") + F.lit(0.5)) * F.lit(2.0**-32)
    return draw(F.shiftrightunsigned(bits, 32)), draw(bits.bitwiseAND(F.lit(0xFFFFFFFF)))


def gamma(bits: Column) -> Column:
    """A draw from Gamma(2, 1), which is -ln of the product of two uniform ones."""
    one, two = uniforms(bits)
    return -F.ln(one * two)


def log_a(term: Column, log_weight: Column, j: Column) -> Column:
    """``ln a`` of a term with the logarithm of its weight, for sample j.

    r, c and beta are drawn from a 64-bit hash each.
    """
    r, c = gamma(F.xxhash64(term, j)), gamma(F.xxhash64(term, j, F.lit(1)))
    beta = uniforms(F.xxhash64(term, j, F.lit(2)))[1]
    return F.ln(c) - r * (F.floor(log_weight / r + beta).cast("double") - beta + 1)


def signatures(terms: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """``keys`` and ``signature``, 16 bits a sample, of each key; a key without terms isn't returned.

    Rows that ``keys`` already partition need no exchange.
    """
    flat = terms.select("*", F.explode(F.sequence(F.lit(0), F.lit(samples - 1))).alias("_j"))
    least = flat.groupBy(*keys, "_j").agg(F.min(log_a(F.col("term"), F.col("log_weight"), F.col("_j"))).alias("_a"))
    bits = F.xxhash64("_a").bitwiseAND(F.lit(0xFFFF)).cast("int")
    ordered = F.array_sort(F.collect_list(F.struct("_j", bits.alias("bits"))))
    return least.groupBy(*keys).agg(F.transform(ordered, lambda x: x["bits"]).alias("signature"))


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """The share of equal samples."""
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    return F.round(equal / F.lit(samples), 6)


def as_text(signature: Column) -> Column:
    return F.array_join(F.transform(signature, lambda x: F.lpad(F.lower(F.hex(x.bitwiseAND(F.lit(0x1FFFF)))), 5, "0")), "")


def group_heads(ids: DataFrame) -> DataFrame:
    """(doc_id, before): the first doc_id of every group and the group before it; one row per group.

    The groups are ordered in three levels, so that the last window holds one row for each 65,536
    ids' worth of groups.
    """
    heads = ids.filter("doc_id IS NOT NULL").select(F.floor(F.col("doc_id") / GROUP).alias("g"), "doc_id").groupBy("g").agg(F.min("doc_id").alias("doc_id"))
    heads = heads.withColumn("s", F.floor(F.col("g") / SUPER))
    inner = heads.withColumn("before", F.lag("g").over(Window.partitionBy("s").orderBy("g")))
    ends = heads.groupBy("s").agg(F.max("g").alias("last"))
    line = Window.orderBy("s")
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("s", F.coalesce(F.lag("last").over(line), F.last("last").over(whole)).alias("before_first"))
    return inner.join(ends, "s").select("doc_id", F.coalesce("before", "before_first").alias("before"), F.col("g").alias("own"))


def edited_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(g, place, copy, doc_id, n_chars, text, edited): every row with its edited text.

    The first rows of each group are dealt to the group before it as well (``copy``), so that every
    row meets its next one in a window over its own group.
    """
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    heads = cut_lineage(group_heads(rows.select("doc_id")), "heads")
    own = rows.select(F.when(F.col("doc_id").isNotNull(), F.floor(F.col("doc_id") / GROUP)).otherwise(F.lit(None)).alias("g"), F.lit(False).alias("copy"), "doc_id", "text")
    copies = rows.join(heads, "doc_id").select(F.col("before").alias("g"), F.lit(True).alias("copy"), "doc_id", "text")
    order = Window.partitionBy("g").orderBy("copy", "doc_id", "text")
    both = own.union(copies).withColumn("next", F.lead("text").over(order)).withColumn("place", F.row_number().over(order))
    n = F.char_length("text").cast("long")
    half = F.floor(n / 2).cast("int")
    kept = F.substring(F.col("text"), F.lit(1), (n - half).cast("int"))
    taken = F.when(F.col("g").isNotNull(), F.substring(F.coalesce("next", F.lit("")), F.lit(1), half)).otherwise("")
    return both.select("g", "place", "copy", "doc_id", n.alias("n_chars"), "text", F.concat(kept, taken).alias("edited"))


def fingerprint_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every row's text and edited text, and their likeness to each other and to the next row's."""
    rows = edited_documents(docs, doc_id, text)
    own, changed = F.struct((2 * F.col("place")).alias("key"), F.col("text")), F.struct((2 * F.col("place") + 1).alias("key"), F.col("edited").alias("text"))
    versions = rows.select("g", F.inline(F.when(F.col("copy"), F.array(own)).otherwise(F.array(own, changed))))
    found = signatures(weighted_terms(versions, ["g", "key"]), ["g", "key"], samples).groupBy("g", F.floor(F.col("key") / 2).cast("int").alias("place")).agg(
        F.max(F.when(F.col("key") % 2 == 0, F.col("signature"))).alias("own"), F.max(F.when(F.col("key") % 2 == 1, F.col("signature"))).alias("changed"))
    told = rows.select("g", "place", "copy", "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    same = told["g"].eqNullSafe(found["g"]) & (told["place"] == found["place"])
    joined = told.join(found, same, "left").select(told["*"], *(F.coalesce(c, F.array_repeat(F.lit(-1), samples)).alias(c) for c in ("own", "changed")))
    near = joined.withColumn("next", F.lead("own").over(Window.partitionBy("g").orderBy("place")))
    return near.filter("NOT copy").select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"), as_text(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed"), samples).alias("near_edited"),
        F.when(F.col("g").isNotNull(), likeness(F.col("own"), F.col("next"), samples)).alias("near_next"))
