"""Quality of texts by a sparse ensemble of rules over statistics.

Shallow trees are grown on the statistics of labelled texts. Every path from a root to a node is a rule, a conjunction of
bounds on statistics; a logistic regression with a lasso penalty gives most rules no weight. What is left is compiled
into column expressions, so that scoring is one pass of built-in functions over the texts.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaptrend.llm.rows import stored, table, text_of

#: Bound of the labelled sample, rows of each class.
SAMPLE = 20_000
TREES, DEPTH = 24, 3
#: Weight of the lasso penalty.
PENALTY = 0.002
SEED = 42

#: Names of the statistics; all are 0 for an empty text.
STATISTICS = (
    "chars", "words", "word_length", "vocabulary", "repeated_next", "short_words", "symbols", "capitals", "digits", "shouts", "stops", "commas",
    "distinct_lines", "line_words",
)
#: Outside these columns of a document nothing is read.
_WORDS, _LINES, _TEXT = "_words", "_lines", "_text"


def with_statistics(docs: DataFrame, *keep: Column) -> DataFrame:
    """Statistics of every whole text under ``_s_`` names, and the columns to keep. A null text is an empty one."""
    parts = docs.select(
        *keep,
        text_of().alias(_TEXT),
        F.filter(F.split(text_of(), r"[\x20\x09-\x0D]+"), lambda w: w != "").alias(_WORDS),
        F.filter(F.split(text_of(), "\n"), lambda x: F.trim(x) != "").alias(_LINES),
    )
    count = lambda pattern: F.regexp_count(_TEXT, F.lit(pattern)).cast("double")
    chars, words, lines = F.length(_TEXT).cast("double"), F.size(_WORDS).cast("double"), F.size(_LINES).cast("double")
    pairs = F.zip_with(_WORDS, F.slice(_WORDS, 2, F.greatest(F.size(_WORDS), F.lit(1))), lambda a, b: a.eqNullSafe(b))
    found = {
        "chars": chars,
        "words": words,
        "word_length": F.try_divide(chars, words),
        # Logarithms, since the share of distinct words falls with the length of a text.
        "vocabulary": F.try_divide(F.log(F.lit(1) + F.size(F.array_distinct(_WORDS))), F.log(F.lit(1) + words)),
        "repeated_next": F.try_divide(F.size(F.filter(pairs, lambda same: same)).cast("double"), words),
        "short_words": F.try_divide(F.size(F.filter(_WORDS, lambda w: F.length(w) <= 3)).cast("double"), words),
        "symbols": F.try_divide(count(r"[^\p{L}\p{M}\p{N}\s.,;:!?'\"()\-]"), chars),
        "capitals": F.try_divide(count(r"\p{Lu}"), chars),
        "digits": F.try_divide(count(r"\p{N}"), chars),
        "shouts": F.try_divide(count("!"), words),
        "stops": F.try_divide(count("[.?]"), words),
        "commas": F.try_divide(count(","), words),
        "distinct_lines": F.try_divide(F.size(F.array_distinct(_LINES)).cast("double"), lines),
        "line_words": F.try_divide(words, lines),
    }
    kept = [c for c in parts.columns if c not in (_TEXT, _WORDS, _LINES)]
    return parts.select(*kept, *(F.coalesce(found[n], F.lit(0.0)).alias(f"_s_{n}") for n in STATISTICS))


# --- rules ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """A conjunction: statistics that lie above ``low`` and not above ``high``."""

    bounds: tuple[tuple[str, float, float], ...]

    def column(self) -> Column:
        out = F.lit(True)
        for name, low, high in self.bounds:
            x = F.col(f"_s_{name}")
            if low > -math.inf:
                out = out & (x > low)
            if high < math.inf:
                out = out & (x <= high)
        return out

    def __str__(self) -> str:
        said = []
        for name, low, high in self.bounds:
            said += [f"{name} > {low:.4g}"] * (low > -math.inf) + [f"{name} <= {high:.4g}"] * (high < math.inf)
        return " and ".join(said)


@dataclass
class Ensemble:
    """Log-odds of quality: a constant and the weights of the rules that hold."""

    constant: float
    rules: dict[Rule, float] = field(default_factory=dict)

    def score(self) -> Column:
        odds = F.lit(self.constant)
        for rule, weight in self.rules.items():
            odds = odds + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


_SPLIT = re.compile(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+)\)")


def paths(printed: str) -> list[Rule]:
    """Rules of all paths of one tree, from its printed form: every ``If`` and ``Else`` is a node below the root."""
    found, above = [], []
    for line in printed.splitlines():
        m = _SPLIT.match(line)
        if not m:
            continue
        depth, name, side, bar = len(m[1]), STATISTICS[int(m[2])], m[3], float(m[4])
        above = [x for x in above if x[0] < depth] + [(depth, name, side, bar)]
        bounds: dict[str, tuple[float, float]] = {}
        for _, n, s, b in above:
            low, high = bounds.get(n, (-math.inf, math.inf))
            bounds[n] = (max(low, b), high) if s == ">" else (low, min(high, b))
        found.append(Rule(tuple((n, *bounds[n]) for n in STATISTICS if n in bounds)))
    return found


# --- fitting --------------------------------------------------------------------------------


def held_out(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """Whether a row is never learnt from: one fold by a hash of its id; rows without id are of that fold."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE) -> DataFrame:
    """Statistics of at most about ``per_class`` labelled texts of each class, chosen by a hash of the id; stored.

    Rows of the held-out fold are left out. An id that is labelled twice is good if all of its labels say so. The chosen
    ids are bounded, so they are sent to all tasks.
    """
    known = labels.where(F.col("quality").isNotNull() & ~held_out())
    known = known.groupBy(F.col("doc_id").alias("_id")).agg(F.min(F.col("quality").cast("int")).alias("_y"))
    share = F.lit(0.0)
    for r in known.groupBy("_y").count().collect():
        share = F.when(F.col("_y") == r["_y"], min(1.0, per_class / r["count"])).otherwise(share)
    chosen = known.where(F.pmod(F.xxhash64("_id"), F.lit(1_000_003)) < share * 1_000_003)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    # One sorted part, so that trees and weights repeat: a few numbers for each row of the sample. They are shuffled
    # there, or the one task would read all documents.
    rows = with_statistics(texts, F.col("_y").cast("double").alias("_y"), F.col("doc_id").alias("_id"))
    return stored(rows.repartition(1).sortWithinPartitions("_id", *(f"_s_{n}" for n in STATISTICS)))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE, penalty: float = PENALTY) -> Ensemble:
    """Rules and weights. Without labels every score is 0.5, with one class only it is that class's."""
    sample = labelled_sample(docs, labels, per_class)
    sizes = {r["_y"]: r["count"] for r in sample.groupBy("_y").count().collect()}
    if len(sizes) < 2:
        return Ensemble(0.0 if not sizes else 30.0 if 1.0 in sizes else -30.0)
    rows = sample.select("_y", array_to_vector(F.array(*(f"_s_{n}" for n in STATISTICS))).alias("x"))
    forest = RandomForestClassifier(
        featuresCol="x", labelCol="_y", numTrees=TREES, maxDepth=DEPTH, maxBins=64, featureSubsetStrategy="onethird", seed=SEED
    ).fit(rows)
    rules = list(dict.fromkeys(rule for tree in forest.trees for rule in paths(tree.toDebugString)))
    held = F.array(*(rule.column().cast("double") for rule in rules))
    lasso = LogisticRegression(featuresCol="x", labelCol="_y", elasticNetParam=1.0, regParam=penalty, maxIter=40)
    model = lasso.fit(sample.select("_y", array_to_vector(held).alias("x")))
    weights = model.coefficients.toArray()
    return Ensemble(float(model.intercept), {r: float(w) for r, w in zip(rules, weights, strict=True) if w})


# --- use ------------------------------------------------------------------------------------


def score(docs: DataFrame, model: Ensemble, bar: float = 0.3) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 from ``bar`` on).

    Whole texts are read, and nothing but the text enters a score. Every row gives one row, repeated or without
    id; null and empty texts get the score of statistics that are all 0. Other columns are ignored.
    """
    rows = with_statistics(docs, F.col("doc_id")).withColumn("score", model.score())
    return rows.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= bar, 1).otherwise(0).alias("predicted"))


QUERY = "op11_quality_rules"


def query(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    return score(docs, fit(docs, table(spark, folder, "labels")))
