"""Quality measures and a short-circuit cascade of rules, in built-in functions only.

Rules are tried one after the other and the first that a text fails rejects it, so their order
decides the work but not the verdict. On a sample each rule is run by itself: its time is its cost,
the share of rows it rejects its selectivity, and rules are ordered by rejection per cost. In the
cascade a rule is evaluated for a row only if all rules before it passed.

Defined results: a null or empty text has no words, lines or symbols; all its measures are 0 and it
fails the rule of too few words. Repeated rows are judged each. An empty table keeps the rules in the
order given. Output columns replace input columns of the same name.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import cut_lineage

#: White space of words: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
#: Capital letters of Latin-1.
CAPITALS = "[A-ZÀ-ÖØ-Þ]+"
WINDOW = 5


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once for each row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK), "")


def repeated_words(parts: Column) -> Column:
    """Words covered by windows of five words that occur twice or more in ``parts``.

    Windows are compared by a 64-bit hash of their five words.
    """
    word_hashes = F.transform(parts, lambda w: F.xxhash64(w))
    hashes = let(word_hashes, lambda h: F.slice(
        F.transform(h, lambda x, i: F.xxhash64(x, *(F.get(h, i + k) for k in range(1, WINDOW)))), 1, F.size(h) - (WINDOW - 1)))

    def covered(h: Column) -> Column:
        # Equal windows stand side by side once sorted by hash; their places, in order, cover up to
        # five words each, or as many as lie before the next one.
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def of_sorted(s: Column) -> Column:
            same = lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"])
            places = F.sort_array(F.transform(F.filter(s, lambda x, j: F.coalesce(same(x, j), F.lit(False))), lambda x: x["i"]))
            return let(places, lambda p: F.aggregate(
                F.transform(p, lambda x, j: F.least(F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW)), F.lit(WINDOW))), F.lit(0), lambda a, x: a + x))

        return let(pairs, of_sorted)

    return F.when(F.size(parts) < WINDOW + 1, 0).otherwise(
        let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h))))


def word_chars(parts: Column) -> Column:
    return F.char_length(F.array_join(parts, ""))


def symbol_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SYMBOLS)), F.lit(0))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    kept = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(kept, lambda k: F.size(k) - F.size(F.array_distinct(k)))


def capital_letters(text: Column) -> Column:
    return F.char_length(text) - F.char_length(F.regexp_replace(text, CAPITALS, ""))


@dataclass(frozen=True)
class Rule:
    """``fails(words, text)`` is true for a row to be rejected; null counts as passed."""

    name: str
    fails: Callable[[Column, Column], Column]


@dataclass(frozen=True)
class Estimate:
    name: str
    seconds: float
    rejected: float

    @property
    def worth(self) -> float:
        return self.rejected / max(self.seconds, 1e-3)


def estimate_rules(sample: DataFrame, rules: Sequence[Rule], text: str = "text") -> list[Estimate]:
    """Cost and selectivity of every rule, each run alone over ``sample``; the cost of cutting the
    text into words, which all rules share, is taken off."""

    def run(rule: Rule) -> tuple[float, float]:
        fails = let(words(F.col(text)), lambda w: F.coalesce(rule.fails(w, F.col(text)), F.lit(False)))
        query = sample.agg(F.count("*").alias("n"), F.count_if(fails).alias("k"))
        query.collect()  # compiles the expression
        start = time.perf_counter()
        row = query.collect()[0]
        return time.perf_counter() - start, row["k"] / max(1, row["n"])

    base, _ = run(Rule("words only", lambda w, t: F.size(w) < 0))
    return [Estimate(rule.name, max(0.0, seconds - base), rejected) for rule in rules for seconds, rejected in [run(rule)]]


def order_rules(rules: Sequence[Rule], estimates: Sequence[Estimate]) -> list[Rule]:
    worth = {e.name: e.worth for e in estimates}
    return sorted(rules, key=lambda r: -worth[r.name])


def cascade(rules: Sequence[Rule], parts: Column, text: Column) -> Column:
    """The name of the first rule that a row fails, or null; later rules aren't evaluated."""
    first = None
    for rule in rules:
        fails = rule.fails(parts, text)
        first = F.when(fails, F.lit(rule.name)) if first is None else first.when(fails, F.lit(rule.name))
    return first if first is not None else F.lit(None).cast("string")


def planned(df: DataFrame, rules: Sequence[Rule], text: str = "text", sample_rows: int = 1000) -> list[Rule]:
    """``rules`` in the order that a sample of ``df`` suggests; only the speed depends on the sample."""
    sample = cut_lineage(df.select(text).limit(sample_rows), "rule-sample")
    return order_rules(rules, estimate_rules(sample, rules, text))


TOO_FEW, REPEATED = "too few words", "repeated words"


def filter_rules() -> list[Rule]:
    """The rules of the pipeline."""
    lines = lambda t: F.size(F.split(t, "\n"))
    return [
        Rule(TOO_FEW, lambda w, t: F.size(w) < 10),
        Rule("odd word length", lambda w, t: let(word_chars(w), lambda c: (c < 2 * F.size(w)) | (c > 20 * F.size(w)))),
        Rule("symbols", lambda w, t: 10 * symbol_count(t) > F.size(w)),
        Rule("capitals", lambda w, t: 10 * capital_letters(t) > 4 * word_chars(w)),
        Rule("repeated lines", lambda w, t: (lines(t) > 3) & (10 * duplicate_lines(t) > 3 * lines(t))),
        Rule(REPEATED, lambda w, t: 100 * repeated_words(w) > 20 * F.size(w)),
    ]


def judge_quality(df: DataFrame, text: str = "text", sample_rows: int = 1000) -> DataFrame:
    """``df`` with ``failed_rule``: the first rule failed, in the planned order, or null."""
    rules = planned(df, filter_rules(), text, sample_rows)
    return df.withColumn("failed_rule", let(words(df[text]), lambda w: cascade(rules, w, df[text])))


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure_quality(df: DataFrame, text: str = "text", sample_rows: int = 1000) -> DataFrame:
    """``df`` with the base measures of every text, ``base_failed``, and the verdict of the cascade."""
    rules = [r for r in planned(df, filter_rules(), text, sample_rows) if r.name not in (TOO_FEW, REPEATED)]
    t = df[text]

    def of_words(w: Column) -> Column:
        base = F.struct(*(value.cast("long").alias(name) for name, value in zip(BASE, (
            F.size(w), word_chars(w), symbol_count(t), duplicate_lines(t), repeated_words(w)), strict=True)))

        def of_base(b: Column) -> Column:
            failed = (b["n_words"] < 10) | (100 * b["n_repeat_words"] > 20 * b["n_words"])
            kept = F.when(failed, False).otherwise(cascade(rules, w, t).isNull())
            return F.struct(*(b[name].alias(name) for name in BASE), failed.alias("base_failed"), kept.alias("kept"))

        return let(base, of_base)

    measured = df.withColumn("_measures", let(words(t), of_words))
    return measured.withColumns({name: F.col(f"_measures.{name}") for name in (*BASE, "base_failed", "kept")}).drop("_measures")


def quality_sql() -> str:
    """The measures and the verdict in DuckDB's SQL, over ``documents``."""
    return r"""
    WITH cut AS (SELECT doc_id, coalesce(text, '') AS text,
        list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
    windows AS (SELECT *, list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) AS five FROM cut),
    repeats AS (SELECT rid, count(DISTINCT place) AS n FROM (
        SELECT rid, unnest(range(i, i + 5)) AS place FROM (
          SELECT rid, i, count(*) OVER (PARTITION BY rid, five) AS times FROM (
            SELECT rid, unnest(five) AS five, generate_subscripts(five, 1) AS i FROM (SELECT *, row_number() OVER () AS rid FROM windows)))
        WHERE times > 1) GROUP BY rid),
    measured AS (SELECT doc_id, text, w, len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(w) AS n_words,
        coalesce(length(array_to_string(w, '')), 0) AS word_chars, length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        coalesce(n, 0) AS n_repeat_words, len(string_split(text, chr(10))) AS n_lines,
        length(text) - length(regexp_replace(text, '[A-ZÀ-ÖØ-Þ]+', '', 'g')) AS capitals
      FROM (SELECT *, row_number() OVER () AS rid FROM windows) LEFT JOIN repeats USING (rid)),
    judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
      NOT base_failed AND NOT (word_chars < 2 * n_words OR word_chars > 20 * n_words OR 10 * n_symbols > n_words
        OR 10 * capitals > 4 * word_chars OR (n_lines > 3 AND 10 * n_dup_lines > 3 * n_lines)) AS kept
    FROM judged"""
