"""Set-based audits: every number, period and quotation in a text has to come from the record.

``docs`` has ``section_id, doc_id, text``. Texts are read whole. Claims become rows and are checked
by equality joins, so a section of any size spreads over the cluster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import grouped_number, plain_number, trimmed
from ledgerloom.operators import derive
from ledgerloom.session import cut_lineage

# A financial-year label, a number as prose prints it, a quotation of 40 and more.
WORD = r"\p{L}\p{N}_"
PERIOD = rf"(?<![{WORD}])[0-9]{{4}}-[0-9]{{2}}(?![{WORD}])"
NUMBER = rf"(?<![{WORD}.])[0-9](?:[0-9,]*[0-9])?(?:\.[0-9]+)?"
QUOTATION = r"[“\"]([^“”\"]{40,})[”\"]"

# Length of the text pieces that quotations are looked up by.
PIECE = 16


def number_tokens(text: Column) -> Column:
    """The numbers of a text after its financial-year labels are taken out."""
    return F.regexp_extract_all(F.regexp_replace(text, PERIOD, " "), F.lit(NUMBER), F.lit(0))


def period_labels(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PERIOD), F.lit(0))


def renderings(values: DataFrame, section: str = "section_id", value: str = "value") -> DataFrame:
    """``(section_id, token)``: the plain and the comma-grouped spelling of each value."""
    spelled = F.array(plain_number(F.col(value)), grouped_number(F.col(value)))
    return values.filter(F.col(value).isNotNull()).select(section, F.explode(F.array_distinct(spelled)).alias("token"))


def tokens_of(texts: DataFrame, tokens: Column) -> DataFrame:
    """Distinct ``(section_id, token)`` of served or briefed texts."""
    return texts.select("section_id", F.explode(tokens).alias("token")).distinct()


def unbacked(docs: DataFrame, tokens: Column, allowed: DataFrame) -> DataFrame:
    """``(section_id, doc_id, token, uses)`` of claims no allowed token backs.

    Uses are counted per document before the join.
    """
    claims = (
        docs.select("section_id", "doc_id", F.explode(tokens).alias("token"))
        .groupBy("section_id", "doc_id", "token")
        .agg(F.count(F.lit(1)).alias("uses"))
    )
    return claims.join(allowed.select("section_id", "token").distinct(), ["section_id", "token"], "left_anti")


def unbacked_numbers(docs: DataFrame, allowed: DataFrame) -> DataFrame:
    return unbacked(docs, number_tokens(F.col("text")), allowed)


def unbacked_periods(docs: DataFrame, allowed: DataFrame) -> DataFrame:
    return unbacked(docs, period_labels(F.col("text")), allowed)


def quotations(docs: DataFrame) -> DataFrame:
    """``(section_id, doc_id, quote)``: quoted spans of 40 characters and more, edges trimmed."""
    found = F.regexp_extract_all("text", F.lit(QUOTATION), F.lit(1))
    return docs.select("section_id", "doc_id", F.explode(found).alias("_raw")).select(
        "section_id", "doc_id", trimmed(F.col("_raw")).alias("quote")
    )


def _cuts(quotes: DataFrame, texts: DataFrame, piece: int) -> DataFrame:
    """``(section_id, quote)``: stretches of the texts that begin and are as long as some quotation."""
    starts = quotes.select(
        "section_id", F.xxhash64(F.substring("quote", 1, piece)).alias("_piece"), F.length("quote").alias("_length")
    ).distinct()
    # Every position of the text with the piece that starts there, in one pass of the matcher.
    found = F.regexp_extract_all("text", F.lit(rf"(?s)(?=(.{{{piece}}}))"), F.lit(1))
    positions = texts.select("section_id", "_id", F.posexplode(F.transform(found, lambda p: F.xxhash64(p))).alias("_at", "_piece"))
    kept = positions.join(starts.select("section_id", "_piece").distinct(), ["section_id", "_piece"], "left_semi")
    lengths = kept.join(starts, ["section_id", "_piece"]).select("_id", "_at", "_length")
    cut = F.substring(F.col("text"), F.col("_at") + 1, F.col("_length"))
    return lengths.join(texts, "_id").select("section_id", cut.alias("quote")).distinct()


def unbacked_quotations(docs: DataFrame, served: DataFrame) -> DataFrame:
    """Quotations that are no substring of any text ``served(section_id, text)`` of their section.

    A substring search as equality joins. Each distinct quotation is looked up by its first 16
    characters (by its first one if it is shorter); the served positions where such a piece starts
    are kept by a semi join, which never multiplies them. At a kept position the served text is cut
    to the lengths of the quotations that start with this piece, and the cuts are compared whole. No
    pair of a quotation and a text is formed before it is known to match.
    """
    quotes = cut_lineage(quotations(docs), "quotes")
    texts = served.select("section_id", "text").distinct().withColumn(
        "_id", F.sha2(F.concat_ws("\u0000", "section_id", "text"), 256)
    )
    size = F.length("quote")
    backed = _cuts(quotes.filter(size >= PIECE), texts, PIECE)
    short = quotes.filter((size > 0) & (size < PIECE))
    if not short.isEmpty():  # a quotation of mostly blanks
        backed = backed.unionByName(_cuts(short, texts, 1))
    # An empty quotation is in every text of its section.
    blank = texts.select("section_id", F.lit("").alias("quote")).distinct()
    return quotes.join(backed.unionByName(blank), ["section_id", "quote"], "left_anti")


def strip_exhibits(docs: DataFrame, exhibits: DataFrame) -> DataFrame:
    """``docs`` with the section's exhibits taken out of the text, longest first.

    ``exhibits(section_id, text)`` are authored texts, a handful per section; a section's distinct
    exhibits travel as one sorted array.
    """
    listed = exhibits.select("section_id", "text").distinct().groupBy("section_id").agg(
        F.array_sort(F.collect_list(F.struct((-F.length("text")).alias("n"), "text"))).alias("_exhibits")
    )
    joined = docs.join(listed, "section_id", "left")
    return joined.withColumn(
        "text",
        F.aggregate(
            F.coalesce("_exhibits", F.array().cast("array<struct<n:int,text:string>>")),
            F.col("text"),
            lambda text, e: F.replace(text, e["text"], F.lit(" ")),
        ),
    ).drop("_exhibits")


def derivation_problems(nodes: DataFrame, declared: DataFrame) -> DataFrame:
    """Declared derivations ``(id, operation, inputs, declared)`` whose value the inputs do not give.

    Values go on only from derivations that were verified, so one that rests on a wrong one has an
    unknown input, whatever it declares.
    """
    found = derive.evaluate(nodes, declared).filter(F.col("problem").isNotNull())
    return found.select("id", F.col("declared").alias("declared_value"), F.col("value").alias("recomputed_value"), "problem")


def cohort_problems(declared: DataFrame, members: DataFrame, served: DataFrame) -> DataFrame:
    """Cohorts whose count or members differ from what the served facts select.

    ``declared(cohort_id, value)``; ``members`` and ``served`` are ``(cohort_id, fact_id)``. Members
    are matched one against one by a full outer join.
    """
    a = members.distinct().withColumn("_m", F.lit(1))
    b = served.distinct().withColumn("_s", F.lit(1))
    sides = a.join(b, ["cohort_id", "fact_id"], "full_outer").groupBy("cohort_id").agg(
        F.count("_s").alias("served_count"),
        F.count_if(F.col("_s").isNull()).alias("not_served"),
        F.count_if(F.col("_m").isNull()).alias("not_declared"),
    )
    joined = declared.join(sides, "cohort_id", "full_outer")
    zero = F.lit(0)
    served_count = F.coalesce("served_count", zero)
    count_wrong = ~F.col("value").eqNullSafe(served_count)
    members_wrong = (F.coalesce("not_served", zero) > 0) | (F.coalesce("not_declared", zero) > 0)
    return joined.select(
        "cohort_id", F.col("value").alias("declared_count"), served_count.alias("served_count"),
        F.coalesce("not_served", zero).alias("not_served"), F.coalesce("not_declared", zero).alias("not_declared"),
        count_wrong.alias("count_wrong"), members_wrong.alias("members_wrong"),
    ).filter(F.col("count_wrong") | F.col("members_wrong"))


def replay_problems(figures: DataFrame, served: DataFrame) -> DataFrame:
    """Figures ``(figure_id, fact_id, value)`` whose fact is gone or carries another value."""
    now = served.select("fact_id", F.col("value").alias("served_value"), F.lit(1).alias("_hit"))
    joined = figures.join(now, "fact_id", "left")
    problem = F.when(F.col("_hit").isNull(), "fact not served").when(
        F.col("served_value").isNull() | (F.col("served_value") != F.col("value")), "value differs"
    )
    return joined.withColumn("problem", problem).filter(F.col("problem").isNotNull()).select(
        "figure_id", "fact_id", "value", "served_value", "problem"
    )


def lineage_problems(figures: DataFrame, sources: DataFrame) -> DataFrame:
    """Figures without any source, or with a source that names no resource (no date is fine)."""
    behind = sources.groupBy("fact_id").agg(
        F.count(F.lit(1)).alias("sources"),
        F.count_if(F.coalesce("resource_id", F.lit("")) == "").alias("unnamed"),
    )
    joined = figures.select("figure_id", "fact_id").join(behind, "fact_id", "left")
    problem = F.when(F.col("sources").isNull(), "no lineage").when(F.col("unnamed") > 0, "source without resource")
    return joined.withColumn("problem", problem).filter(F.col("problem").isNotNull()).select("figure_id", "fact_id", "problem")
