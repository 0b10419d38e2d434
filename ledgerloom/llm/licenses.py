"""License scans by patience alignment of texts with license templates.

A text and a template are aligned on the words that occur exactly once in both: the longest
increasing subsequence of such anchors is kept, and the gaps between neighbouring anchors are aligned
the same way. Where a gap has no unique word in common, equal words at its two ends are matched.
Coverage is the share of the template's words that are matched.

A template can only reach ``min_coverage`` if the text holds that many of its words, so a text that
holds fewer is settled by a count. A template is sought in every stretch of the text where its words
stand close together, found by a sliding count, so that a license in a long text is aligned with its
surroundings and not with the whole text. The best alignment over all these windows counts.

The words that identify a license (name, version, NC or SA) must be among the matched ones, side by
side as in the template, so that likeness of the rest doesn't name a license.

Defined results: a null or empty text has no license: ``license`` is null, ``coverage`` 0 and
``licenses`` empty. All places that reach ``min_coverage`` are listed, those with most matched words
first, then by name and place; a place whose identifying words all belong to a better one is left
out. ``license`` is the first of them. Repeated rows are scanned each.
"""

from __future__ import annotations

import bisect
import functools
import heapq
import pkgutil
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[a-z0-9]+(?:[.\-'][a-z0-9]+)*")

def read_templates(text: str) -> dict[str, str]:
    """The templates of a file, brackets kept: ``== name`` starts one, ``#`` a line of comment."""
    out: dict[str, list[str]] = {}
    name = ""
    for line in text.splitlines():
        if line.startswith("== "):
            name = line[3:].strip()
            out[name] = []
        elif name and not line.startswith("#"):
            out[name].append(line)
    return {name: "\n".join(lines).strip() for name, lines in out.items()}


# Statements, notices and texts of well-known licenses. Phrases in brackets identify the license.
MARKED = read_templates((pkgutil.get_data(__package__, "license_templates.txt") or b"").decode())
TEMPLATES = {name: re.sub(r"[][]", "", text) for name, text in MARKED.items()}
MARKS = {name: tuple(re.findall(r"\[(.*?)\]", text, re.DOTALL)) for name, text in MARKED.items()}

Found = tuple[str | None, float, int, int, int]


def longest_increasing(values: Sequence[int]) -> list[int]:
    """Indexes of a longest strictly increasing subsequence."""
    tops: list[int] = []
    top_at: list[int] = []
    back: list[int] = []
    for i, value in enumerate(values):
        pile = bisect.bisect_left(tops, value)
        back.append(top_at[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(value)
            top_at.append(i)
        else:
            tops[pile], top_at[pile] = value, i
    out, i = [], top_at[-1] if top_at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(text: Sequence[str], template: Sequence[str]) -> list[tuple[int, int]]:
    """Matched places (text, template), ascending in both."""
    matched: list[tuple[int, int]] = []
    todo = [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and text[a] == template[c]:
            matched.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            matched.append((b, d))
        if a >= b or c >= d:
            continue
        in_text, in_template = Counter(text[a:b]), Counter(template[c:d])
        place = {w: i for i, w in enumerate(template[c:d], c) if in_template[w] == 1}
        anchors = [(i, place[w]) for i, w in enumerate(text[a:b], a) if in_text[w] == 1 and w in place]
        chain = [anchors[k] for k in longest_increasing([j for _, j in anchors])]
        if not chain:
            continue
        matched.extend(chain)
        for (i, j), (k, m) in zip([(a - 1, c - 1), *chain], [*chain, (b, d)], strict=True):
            todo.append((i + 1, k, j + 1, m))
    return sorted(matched)


@dataclass(frozen=True)
class Scanner:
    """``min_coverage``: least share of a template's words to report it; ``stretch``: words of text
    looked at for each word of the template; ``marks``: phrases of a template that must be matched,
    each to words of the text that follow each other. What follows ``#`` in a name isn't reported."""

    templates: dict[str, str] = field(default_factory=lambda: dict(TEMPLATES))
    marks: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(MARKS))
    min_coverage: float = 0.8
    stretch: int = 2

    def words_of(self) -> dict[str, list[str]]:
        return {name: WORD.findall(text.lower()) for name, text in sorted(self.templates.items())}

    @functools.cached_property
    def _phrases(self) -> dict[str, list[tuple[int, int]]]:
        """Where the marks of each template stand in its words."""
        out: dict[str, list[tuple[int, int]]] = {}
        for name, template in self.words_of().items():
            phrases = [WORD.findall(m.lower()) for m in self.marks.get(name, ())]
            at = [(next((i for i in range(len(template)) if template[i : i + len(p)] == p), -1), len(p)) for p in phrases]
            out[name] = [(i, i + n) for i, n in at if i >= 0]
        return out

    def _need(self, template: list[str]) -> int:
        """The least matched words that reach ``min_coverage``."""
        return next((n for n in range(len(template) + 1) if n / len(template) >= self.min_coverage), len(template) + 1)

    def _stretches(self, text: list[str], template: list[str]) -> Iterator[tuple[int, int, int]]:
        """(words in common, start, end) of every window of text that holds enough of the template's words."""
        need = self._need(template)
        allowed = Counter(template)
        places = [i for i, w in enumerate(text) if w in allowed]
        if len(places) < need:
            return
        span = self.stretch * len(template)
        held: Counter[str] = Counter()
        common = start = 0
        for at in places:
            word = text[at]
            held[word] += 1
            common += held[word] <= allowed[word]
            while places[start] <= at - span:
                gone = text[places[start]]
                common -= held[gone] <= allowed[gone]
                held[gone] -= 1
                start += 1
            if common >= need:
                yield common, places[start], at + 1

    def _places(self, text: list[str], template: list[str], phrases: Sequence[tuple[int, int]] = ()) -> Iterator[list[tuple[int, int]]]:
        """The matched words of each place of the template, the best first; places don't overlap.

        Only alignments that match the ``phrases`` of the template count.

        Windows wait in order of the words that they have in common with the template, which no
        alignment exceeds, so that one is aligned only if it can still be the best. What a place
        leaves of the windows over it is looked at again.
        """
        need, allowed = self._need(template), Counter(template)
        waiting = [(-common, 1, a, b, []) for common, a, b in self._stretches(text, template)]
        heapq.heapify(waiting)
        taken: list[tuple[int, int]] = []
        seen: set[tuple[int, int]] = set()
        while waiting:
            _, unaligned, a, b, pairs = heapq.heappop(waiting)
            k = bisect.bisect_left(taken, (b,)) - 1
            if k >= 0 and taken[k][1] > a:
                for c, d in ((a, taken[k][0]), (taken[k][1], b)):
                    if d - c >= need and (c, d) not in seen:
                        seen.add((c, d))
                        common = (Counter(text[c:d]) & allowed).total()
                        if common >= need:
                            heapq.heappush(waiting, (-common, 1, c, d, []))
            elif unaligned:
                pairs = [(a + i, j) for i, j in align(text[a:b], template)]
                if len(pairs) >= need and _hold(pairs, phrases):
                    heapq.heappush(waiting, (-len(pairs), 0, a, b, pairs))
            else:
                yield pairs
                bisect.insort(taken, (pairs[0][0], pairs[-1][0] + 1))

    def scan_all(self, text: str | None, prepared: dict[str, list[str]]) -> list[Found]:
        """(license, coverage, matched words, first word, word after the last) of every license, best first.

        A place whose identifying words are all matched by a better one is part of that.
        """
        words = WORD.findall(text.lower()) if text else []
        if not words:
            return []
        present, line = set(words), f" {' '.join(words)} "
        places: list[tuple[int, str, int, str, list[tuple[int, int]]]] = []
        for name, template in prepared.items():
            phrases = self._phrases[name]
            if not all(f" {' '.join(template[c:d])} " in line for c, d in phrases):
                continue
            distinct = set(template)
            if len(distinct & present) < self._need(template) - (len(template) - len(distinct)):
                continue
            places += [(-len(pairs), name.partition("#")[0], pairs[0][0], name, pairs) for pairs in self._places(words, template, phrases)]
        out: list[Found] = []
        claimed: set[int] = set()
        for _, license_, first, name, pairs in sorted(places):
            marks = self._phrases[name]
            own = {i for i, j in pairs if not marks or any(c <= j < d for c, d in marks)}
            if own <= claimed:
                continue
            claimed.update(i for i, _ in pairs)
            out.append((license_, round(len(pairs) / len(prepared[name]), 6), len(pairs), first, pairs[-1][0] + 1))
        return out

    def scan(self, text: str | None, prepared: dict[str, list[str]]) -> Found:
        """The best license of a text."""
        return next(iter(self.scan_all(text, prepared)), (None, 0.0, 0, 0, 0))


def _hold(pairs: list[tuple[int, int]], phrases: Sequence[tuple[int, int]]) -> bool:
    """Whether each phrase of the template is matched to words that follow each other."""
    at = {j: i for i, j in pairs} if phrases else {}
    return all(c in at and all(at.get(j) == at[c] + j - c for j in range(c, d)) for c, d in phrases)


def scan_licenses(docs: DataFrame, scanner: Scanner = Scanner(), text: str = "text") -> DataFrame:
    """``docs`` with ``license``, ``coverage``, ``matched_words`` and the span of words of the best
    license, and ``licenses``, all of them with the same fields."""
    fields = ("license", "coverage", "matched_words", "first_word", "end_word")
    kinds = "license string, coverage double, matched_words int, first_word int, end_word int"

    @F.pandas_udf(f"{kinds}, licenses array<struct<{kinds.replace(' ', ':').replace(',:', ',')}>>")
    def scan(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        prepared = scanner.words_of()
        for part in texts:
            rows = []
            for t in part:
                found = scanner.scan_all(t, prepared)
                best = found[0] if found else (None, 0.0, 0, 0, 0)
                rows.append((*best, [dict(zip(fields, one, strict=True)) for one in found]))
            yield pd.DataFrame(rows, columns=[*fields, "licenses"])

    out = docs.withColumn("_license", scan(docs[text]))
    return out.withColumns({f: F.col(f"_license.{f}") for f in (*fields, "licenses")}).drop("_license")
