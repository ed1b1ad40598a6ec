"""Severity of toxic texts: cumulative-link ordinal regression over sparse word features."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaptrend.llm.rows import ship, table, text_of, through_pandas
from snaptrend.session import checkpointed

ship(__name__)

WORD = re.compile(r"\w+")

#: Bound of the labelled sample, rows of each class; and of the vocabulary, words.
SAMPLE = 10_000
VOCABULARY = 2_000
#: Signed root of the likelihood ratio by which a word must lean to toxic texts, and the texts it needs.
LEAN = 4.5
LEAST = 3


@dataclass
class Severity:
    """Weights shared by all thresholds: ``P(grade > k) = 1 / (1 + exp(bar_k - w x))``, ``x`` = log2(1 + count)."""

    weights: dict[str, float]
    bars: list[float]

    def grades(self, text: str | None) -> np.ndarray:
        """Probability of every grade."""
        words = Counter(w for w in WORD.findall((text or "").lower()) if w in self.weights)
        score = sum(self.weights[w] * np.log2(1 + n) for w, n in words.items())
        above = 1 / (1 + np.exp(np.clip(np.array(self.bars) - score, -60, 60)))
        return -np.diff(np.concatenate([[1.0], above, [0.0]]))


# --- fitting --------------------------------------------------------------------------------


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE) -> DataFrame:
    """At most about ``per_class`` labelled texts of each class, chosen by a hash of the id.

    Texts that share their four least word hashes count once, by the least id: copies and near copies say nothing new
    about a word. The chosen ids are few (the bound), so they are sent to all tasks.
    """
    # An id that is labelled twice counts as toxic if either says so.
    wanted = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    wanted = wanted.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("_y"))
    n = {r["_y"]: r["count"] for r in wanted.groupBy("_y").count().collect()}
    share = F.lit(0.0)
    for y, count in n.items():
        share = F.when(F.col("_y") == y, min(1.0, per_class / count)).otherwise(share)
    chosen = wanted.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < share * 1_000_003)
    texts = docs.select("doc_id", text_of().alias("_text")).join(F.broadcast(chosen), "doc_id")
    words = F.array_distinct(F.split(F.lower("_text"), r"(?U)\W+"))
    least = F.slice(F.array_sort(F.transform(words, lambda w: F.xxhash64(w))), 1, 4)
    kept = texts.groupBy(least.alias("_least"), "_y").agg(F.min(F.struct("doc_id", "_text"))["_text"].alias("_text"))
    return checkpointed(kept.select("_y", "_text"))


def leaning_words(sample: DataFrame, limit: int = VOCABULARY) -> list[str]:
    """Words whose texts are toxic more often than chance allows, by the likelihood ratio."""
    sizes = {r["_y"]: r["count"] for r in sample.groupBy("_y").count().collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return []
    words = sample.select("_y", F.explode(F.array_distinct(F.split(F.lower("_text"), r"(?U)\W+"))).alias("word"))
    counts = words.where("word <> ''").groupBy("word").agg(
        F.sum("_y").cast("double").alias("a"), F.sum(1 - F.col("_y")).cast("double").alias("b")
    )
    rate = bad / (bad + good)
    n = F.col("a") + F.col("b")

    def part(seen: Column, chance: float) -> Column:
        return F.when(seen > 0, seen * F.log(seen / (n * chance))).otherwise(0.0)

    ratio = F.sqrt(2 * F.greatest(part(F.col("a"), rate) + part(F.col("b"), 1 - rate), F.lit(0.0)))
    top = counts.where((F.col("a") >= LEAST) & (F.col("a") > n * rate)).select("word", ratio.alias("lean"))
    return [r["word"] for r in top.where(F.col("lean") >= LEAN).orderBy(F.desc("lean"), "word").limit(limit).collect()]


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, grades: np.ndarray, width: int, ridge=1e-6, steps=1500):
    """Weights and rising thresholds by gradient steps on the mean log-likelihood; sparse entries as three arrays."""
    n, top = len(grades), int(grades.max()) if len(grades) else 0
    weights, first, gaps = np.zeros(width), np.array([1.0]), np.zeros(max(top - 1, 0))
    state = [np.zeros(width + 1 + len(gaps)) for _ in range(2)]
    for t in range(1, steps + 1):
        bars = np.concatenate([first, first + np.cumsum(np.exp(gaps))])[:top]
        score = np.bincount(rows, values * weights[cols], minlength=n)
        edges = np.column_stack([np.full(n, -60.0), bars - score[:, None], np.full(n, 60.0)])
        below = 1 / (1 + np.exp(-np.clip(edges, -60, 60)))
        high, low = below[np.arange(n), grades + 1], below[np.arange(n), grades]
        chance = np.maximum(high - low, 1e-12)
        d_high, d_low = high * (1 - high) / chance, low * (1 - low) / chance
        pull = (d_high - d_low) / n  # of the score on the loss
        slope = np.zeros((top,))
        for k in range(top):
            slope[k] = (-(d_high * (grades == k)) + d_low * (grades == k + 1)).sum() / n
        d_first = slope.sum()
        d_gaps = np.array([slope[k + 1 :].sum() * np.exp(gaps[k]) for k in range(len(gaps))])
        grad = np.concatenate([np.bincount(cols, values * pull[rows], minlength=width) + ridge * weights, [d_first], d_gaps])
        state[0] = 0.9 * state[0] + 0.1 * grad
        state[1] = 0.99 * state[1] + 0.01 * grad**2
        move = 0.1 * (state[0] / (1 - 0.9**t)) / (np.sqrt(state[1] / (1 - 0.99**t)) + 1e-9)
        weights, first, gaps = weights - move[:width], first - move[width], gaps - move[width + 1 :]
    return weights, np.concatenate([first, first + np.cumsum(np.exp(gaps))])[:top]


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE) -> Severity:
    """Model of grades 0 (not toxic), 1 (toxic) and 2 (toxic, with more leaning words than half of the toxic texts).

    The labels know only toxic and not, so the toxic rows are told apart by how much of their own
    kind of words they hold. Without labels, or with one class only, nothing is ever toxic.
    """
    sample = labelled_sample(docs, labels, per_class)
    words = leaning_words(sample)
    place = {w: i for i, w in enumerate(words)}
    if not words:
        return Severity({}, [30.0, 31.0])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [Counter(place[w] for w in WORD.findall(t.lower()) if w in place) for t in batch["_text"]]
            yield pd.DataFrame({"_y": batch["_y"], "words": [list(c) for c in found], "counts": [list(c.values()) for c in found]})

    # Bounded by the sample: a few numbers for each of its rows.
    held = sample.mapInPandas(count, "_y int, words array<int>, counts array<int>").toPandas()
    total = held["counts"].map(sum).to_numpy()
    toxic = held["_y"].to_numpy() == 1
    grades = np.where(toxic, 1 + (total > np.median(total[toxic])), 0)
    size = held["words"].map(len).to_numpy()
    rows = np.repeat(np.arange(len(held)), size)
    flat = lambda c: np.array([x for xs in held[c] for x in xs])
    cols, values = flat("words").astype(int), np.log2(1 + flat("counts").astype(float))
    weights, bars = fit_ordinal(rows, cols, values, grades, len(words))
    return Severity(dict(zip(words, map(float, weights), strict=True)), [float(b) for b in bars])


# --- use ------------------------------------------------------------------------------------

ADDED = "expected_severity double, grade int, p_toxic double, rejected boolean"


def rate(docs: DataFrame, model: Severity, bar: float = 0.5) -> DataFrame:
    """doc_id, expected_severity (0 to 2), grade (the likeliest), p_toxic and rejected (p_toxic of ``bar`` or more).

    Every row gives one row, repeated or without id; a null or empty text has no words and so the
    severity of clean text. Whole texts are read. Other columns are ignored.
    """
    rows = docs.select("doc_id", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            p = np.array([model.grades(t) for t in batch["text"]]).reshape(len(batch), -1)
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "expected_severity": p @ np.arange(p.shape[1]), "grade": p.argmax(axis=1),
                "p_toxic": 1 - p[:, 0], "rejected": 1 - p[:, 0] >= bar,
            })

    return through_pandas(rows, run, ADDED, "doc_id")


def without_toxic(docs: DataFrame, model: Severity, bar: float = 0.5) -> DataFrame:
    """Documents that are not rejected, with all their columns; decided row by row, so repeats agree."""

    @F.pandas_udf("boolean")
    def stays(texts: pd.Series) -> pd.Series:
        return pd.Series([model.grades(t)[0] > 1 - bar for t in texts], dtype=bool)

    return docs.where(stays(F.col("text")))


QUERY = "op5_toxicity"


def query(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    return rate(docs, fit(docs, table(spark, folder, "labels")))
