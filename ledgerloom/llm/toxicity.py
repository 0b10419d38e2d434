"""Toxicity by cumulative-link ordinal regression on sparse text features.

A text's features are its lower-cased words and the first four to six letters of each, weighted by
log(1 + count); those that the chi-square statistic ties to the grade are used. The model is P(grade <= j) = sigmoid(t_j - w x): one weight
vector for all grades and ascending thresholds, fitted by gradient descent on the likelihood. The
severity of a text is the expected grade, the sum over j of P(grade > j); a text is toxic where
P(grade > 0) is above one half.

The model is fitted on the driver from a bounded sample of the labelled rows: the ``sample_rows``
rows of the least hash of doc_id, with their whole texts. The driver gets the counts of those features
alone that enough of these texts have. The sample decides the weights only; every row is scored on its
whole text.

Defined results: a null or empty text, or one without known features, has the score of no features.
Labelled rows without a grade, and labels of unknown documents, are not used; a document labelled
twice has the highest grade. Without any labelled row every text has severity 0. Repeated rows are
scored each.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import cut_lineage

WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Training:
    sample_rows: int = 6000
    min_texts: int = 5
    min_chi_square: float = 15.0
    prefixes: tuple[int, ...] = (4, 5, 6)
    ridge: float = 1e-5
    steps: int = 300
    rate: float = 0.1


@dataclass(frozen=True)
class SeverityModel:
    weights: dict[str, float] = field(default_factory=dict)
    thresholds: tuple[float, ...] = ()
    prefixes: tuple[int, ...] = (4, 5, 6)

    def score(self, counts: dict[str, int]) -> float:
        """w x of a text with these word counts."""
        look = self.weights.get
        return sum(weight * math.log1p(n) for f, n in features(counts, self.prefixes).items() if (weight := look(f)))

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > j) for every threshold j."""
        return 1 / (1 + np.exp(np.clip(np.array(self.thresholds)[None, :] - score[:, None], -60, 60)))


def features(counts: dict[str, int], prefixes: tuple[int, ...]) -> dict[str, int]:
    found = dict(counts)
    for word, n in counts.items():
        for size in prefixes:
            if len(word) > size:
                key = word[:size] + "*"
                found[key] = found.get(key, 0) + n
    return found


def word_counts(text: str | None) -> Counter[str]:
    return Counter(WORD.findall((text or "").lower()))


@dataclass(frozen=True)
class Encoded:
    """Labelled texts as sparse arrays: text, feature and count of every entry."""

    names: dict[str, int]
    text: np.ndarray
    feature: np.ndarray
    count: np.ndarray
    label: np.ndarray  # of each text

    @staticmethod
    def of(rows: Iterable[tuple[dict[str, int], int]], prefixes: tuple[int, ...]) -> Encoded:
        names: dict[str, int] = {}
        parts, counts, labels = [], [], []
        for row, label in rows:
            found = features(row, prefixes)
            parts.append(np.fromiter((names.setdefault(f, len(names)) for f in found), np.int32, len(found)))
            counts.append(np.fromiter(found.values(), np.int32, len(found)))
            labels.append(label)
        text = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int32)
        return Encoded(names, text, join(parts), join(counts), np.array(labels, np.int64))


def grades_of_flags(rows: Encoded, cuts: tuple[float, ...] = (0.5, 0.85)) -> np.ndarray:
    """Severity grades for labels that only say toxic (1) or not (0).

    Features that occur almost only in flagged texts are counted; the flagged texts are cut into
    grades at the ``cuts`` quantiles of that number. Grade 0 stays for texts without the flag.
    """
    flagged = rows.label > 0
    if not flagged.any():
        return rows.label
    inside = flagged[rows.text]
    n_flagged = np.bincount(rows.feature[inside], minlength=len(rows.names))
    n_clean = np.bincount(rows.feature[~inside], minlength=len(rows.names))
    marks = (n_flagged >= 5) & (n_flagged >= 20 * n_clean)
    hits = np.bincount(rows.text, rows.count * marks[rows.feature], len(rows.label))
    bounds = np.quantile(hits[flagged], cuts)
    return np.where(flagged, 1 + (hits[:, None] > bounds).sum(1), 0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit(rows: Encoded, grade: np.ndarray, training: Training = Training()) -> SeverityModel:
    """A model of the grades (from 0) of encoded texts."""
    top = int(grade.max()) if len(grade) else 0
    if top == 0:
        return SeverityModel(prefixes=training.prefixes)
    n = len(grade)
    high = (grade > 0).astype(float)
    texts = np.bincount(rows.feature, minlength=len(rows.names)).astype(float)
    texts_high = np.bincount(rows.feature, high[rows.text], len(rows.names))
    n_high = high.sum()
    spread = texts * (n - texts) * n_high * (n - n_high)
    chi_square = np.where(spread > 0, n * (texts_high * n - texts * n_high) ** 2 / np.maximum(spread, 1), 0)
    used = ((texts >= training.min_texts) & (chi_square >= training.min_chi_square))[rows.feature]
    r, c, v = rows.text[used], rows.feature[used], np.log1p(rows.count[used])
    w = np.zeros(len(rows.names))
    # Thresholds ascend: the first one, then the logarithms of the gaps.
    share = np.clip((grade[:, None] > np.arange(top)).mean(0), 1e-4, 1 - 1e-4)
    start = np.log((1 - share) / share)
    theta = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 0.05))])
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (w, theta)]

    def ascending() -> np.ndarray:
        return theta[0] + np.concatenate([[0.0], np.cumsum(np.exp(theta[1:]))])

    for step in range(1, training.steps + 1):
        t = ascending()
        score = np.bincount(r, v * w[c], n)
        # Grade g has the probability F(t_g - s) - F(t_(g-1) - s), with F = 1 above the last threshold.
        up = np.where(grade < top, _sigmoid(t[np.minimum(grade, top - 1)] - score), 1.0)
        low = np.where(grade > 0, _sigmoid(t[np.maximum(grade - 1, 0)] - score), 0.0)
        p = np.maximum(up - low, 1e-9) * n
        d_up, d_low = up * (1 - up) / p, low * (1 - low) / p
        g_w = np.bincount(c, v * (d_up - d_low)[r], len(w)) + training.ridge * w
        g_t = np.bincount(np.maximum(grade - 1, 0), d_low, top) - np.bincount(np.minimum(grade, top - 1), d_up, top)
        g_theta = np.cumsum(g_t[::-1])[::-1] * np.concatenate([[1.0], np.exp(theta[1:])])
        for x, g, rate, (m, s) in ((w, g_w, training.rate, moments[0]), (theta, g_theta, 0.05, moments[1])):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            x -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-6)
    weights = {f: float(w[i]) for f, i in rows.names.items() if abs(w[i]) > 1e-3}
    return SeverityModel(weights, tuple(map(float, ascending())), training.prefixes)


def labelled_sample(docs: DataFrame, labels: DataFrame, training: Training, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Encoded:
    """Word counts and labels of at most ``sample_rows`` labelled documents, read by one bounded query."""
    known = labels.filter(F.col(doc_id).isNotNull() & F.col(label).isNotNull()).groupBy(doc_id).agg(F.max(label).cast("int").alias("_label"))
    # The sample is chosen on ids alone, so texts are read for its rows only.
    ids = docs.select(doc_id).join(known, doc_id).orderBy(F.xxhash64(doc_id), doc_id).limit(training.sample_rows)

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = [features(word_counts(t), training.prefixes) for t in part["text"]]
            yield pd.DataFrame({"label": part["_label"], "features": [list(f) for f in found], "counts": [list(f.values()) for f in found]})

    rows = docs.select(doc_id, F.col(text).alias("text")).join(F.broadcast(ids), doc_id).select("_label", "text")
    counted = rows.mapInPandas(count, "label int, features array<string>, counts array<int>")
    sample = cut_lineage(counted.withColumn("row", F.monotonically_increasing_id()), "labelled")
    # Features are chosen where they lie; the driver gets the entries of those alone.
    flat = sample.select("row", "label", F.explode(F.arrays_zip("features", "counts")).alias("e")).select("row", "label", F.col("e.features").alias("feature"), F.col("e.counts").alias("n"))
    size = sample.agg(F.count("*").alias("n"), F.count_if(F.col("label") > 0).alias("high")).collect()[0]
    n, high = float(size["n"]), float(size["high"])
    texts, texts_high = F.col("texts").cast("double"), F.col("texts_high").cast("double")
    spread = texts * (n - texts) * high * (n - high)
    chi_square = F.when(spread > 0, n * F.pow(texts_high * n - texts * high, 2) / spread)
    tied = flat.groupBy("feature").agg(F.count("*").alias("texts"), F.count_if(F.col("label") > 0).alias("texts_high")).filter(
        (F.col("texts") >= training.min_texts) & (chi_square >= training.min_chi_square)).select("feature")
    entries: dict[int, dict[str, int]] = {r["row"]: {} for r in sample.select("row").collect()}
    for r in flat.join(tied, "feature").select("row", "feature", "n").collect():
        entries[r["row"]][r["feature"]] = r["n"]
    labels_of = {r["row"]: r["label"] for r in sample.select("row", "label").collect()}
    got = sorted((labels_of[row], sorted(found.items())) for row, found in entries.items())  # the same model whatever order the rows come in
    return Encoded.of(((dict(found), label_) for label_, found in got), ())


def train(docs: DataFrame, labels: DataFrame, training: Training = Training(), **columns: str) -> SeverityModel:
    """A model from flags (0 and 1) of ``labels`` over ``docs``."""
    rows = labelled_sample(docs, labels, training, **columns)
    return fit(rows, grades_of_flags(rows), training)


def score_documents(docs: DataFrame, model: SeverityModel, text: str = "text") -> DataFrame:
    """``docs`` with expected_severity, toxic_probability and toxic; columns of these names are replaced."""
    # The weights are bounded by the sample that they were fitted on.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("expected_severity double, toxic_probability double")
    def severity(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for part in texts:
            above = own.above(np.array([own.score(word_counts(t)) for t in part])) if own.thresholds else np.zeros((len(part), 1))
            yield pd.DataFrame({"expected_severity": above.sum(1), "toxic_probability": above[:, 0]})

    out = docs.withColumn("_severity", severity(docs[text]))
    return out.withColumns({"expected_severity": F.round("_severity.expected_severity", 9), "toxic_probability": F.round("_severity.toxic_probability", 9)}).withColumn(
        "toxic", F.col("toxic_probability") > 0.5).drop("_severity")
