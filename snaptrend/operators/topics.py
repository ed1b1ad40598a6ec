"""Documents and macro-topic classification, all inside the row: no join, no shuffle."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaptrend.functions import lexicon
from snaptrend.functions.lexicon import TopicRule
from snaptrend.functions.text import drop_words, normalize_text, quoted, with_grams, words
from snaptrend.operators.ranking import joined_top
from snaptrend.session import spread


def build_documents(
    videos: DataFrame,
    comments: DataFrame,
    keys: Sequence[str] = ("run_date", "video_id"),
    fields: Sequence[str] = ("title", "description", "tags", "search_query"),
    max_comments: int | None = 30,
    max_chars: int | None = 12000,
) -> DataFrame:
    """Add ``source_text``: the text fields, then the most liked comments, joined by a space.

    Comments are cut to the first ``max_comments`` per video before they are shuffled, so a video
    with very many comments costs no more than another one.
    """
    keys = list(keys)
    order = [F.col("like_count").desc_nulls_last(), F.col("comment_id").asc()]
    if max_comments is None:
        rank = F.struct(-F.coalesce("like_count", F.lit(-(2**62))), F.col("comment_id"), F.col("comment_text").alias("t"))
        listed = F.array_sort(F.collect_list(F.when(F.col("comment_text").isNotNull(), rank)))
        talk = comments.groupBy(*keys).agg(F.array_join(F.transform(listed, lambda x: x["t"]), " ").alias("_talk"))
    else:
        talk = joined_top(comments, keys, "comment_text", order, max_comments, " ", "_talk")
    text = F.concat_ws(" ", *fields, F.col("_talk"))
    if max_chars is not None:
        text = F.substring(text, 1, max_chars)
    return videos.join(talk, keys, "left").withColumn("source_text", text).drop("_talk")


def plain_normalize(text: str) -> str:
    """Normalise a rule's own text on the driver, as ``normalize_text`` does for columns."""
    folded = unicodedata.normalize("NFKD", text.lower())
    folded = "".join(c for c in folded if not unicodedata.combining(c))
    return " ".join(re.sub(r"\W", " ", folded).split())


def _matched(topic: TopicRule, hits: Column) -> Column:
    """Matched keywords of a topic in rule order, with their weight."""
    entries = ", ".join(
        f"named_struct('kw', {quoted(k)}, 'norm', {quoted(n)}, 'w', {2 if ' ' in n else 1}D)"
        for k in topic.keywords
        if (n := plain_normalize(k))
    )
    return F.filter(F.expr(f"array({entries})"), lambda e: F.array_contains(hits, e["norm"]))


def _keyword_hits(rules: Sequence[TopicRule], normalized: Column) -> Column:
    """Normalised keywords present as whole words.

    Normalised text is words with one space between them, so a phrase is present as whole words
    when the padded text contains the padded phrase. Single words come from one pass over the
    words.
    """
    norms = sorted({plain_normalize(k) for r in rules for k in r.keywords} - {""})
    singles = [n for n in norms if " " not in n]
    phrases = [n for n in norms if " " in n]
    found = F.array_distinct(F.filter(words(normalized), lambda w: w.isin(singles)))
    padded = F.concat(F.lit(" "), normalized, F.lit(" "))
    spans = [F.when(padded.contains(f" {p} "), F.lit(p)) for p in phrases]
    return F.concat(found, F.array_compact(F.array(*spans))) if spans else found


def _rule_choice(rules: Sequence[TopicRule], hits: Column) -> Column:
    """Best topic by score, then confidence, then rule order; null when nothing matches."""
    candidates = []
    for position, topic in enumerate(rules):
        kept = _matched(topic, hits)
        score = F.aggregate(kept, F.lit(0.0), lambda acc, e: acc + e["w"])
        confidence = F.least(F.lit(1.0), score / F.lit(max(3.0, len(topic.keywords) / 2)))
        candidates.append(
            F.struct(
                score.alias("score"),
                confidence.alias("confidence"),
                F.lit(-position).alias("position"),
                F.lit(topic.topic_id).alias("id"),
                F.lit(topic.name).alias("name"),
                F.array_join(F.transform(kept, lambda e: e["kw"]), ", ").alias("keywords"),
            )
        )
    return F.array_max(F.filter(F.array(*candidates), lambda c: c["score"] > 0))


class SeedVectors:
    """Fixed side of the similarity fallback: the TF-IDF vectors of the topics' own texts.

    The vocabulary is fitted on the document plus one text per topic. Only one document changes,
    so the inverse document frequency of a term takes two values: with or without the document.
    Everything here depends on the rule table alone and stays as small as it is.
    """

    def __init__(self, rules: Sequence[TopicRule], stop_words: Sequence[str]):
        self.rules = rules
        self.stop_words = list(stop_words)
        self.texts = len(rules) + 1
        stops = set(stop_words)
        self.counts: list[Counter] = []
        for rule in rules:
            text = plain_normalize(" ".join([rule.name, *rule.keywords]))
            kept = [w for w in text.split() if len(w) > 1 and w not in stops]
            self.counts.append(Counter(kept + [f"{a} {b}" for a, b in zip(kept, kept[1:])]))
        self.seed_freq = Counter(term for counts in self.counts for term in counts)

    def idf(self, freq: int) -> float:
        return math.log((1 + self.texts) / (1 + freq)) + 1

    def term_rows(self) -> Column:
        """Map from term to its weights: idf with and without the document, count per topic."""
        pairs = []
        for term, freq in sorted(self.seed_freq.items()):
            weights = [self.idf(freq + 1), self.idf(freq), *(c[term] for c in self.counts)]
            pairs.append(f"{quoted(term)}, array({', '.join(f'{w!r}D' for w in weights)})")
        return F.expr(f"map({', '.join(pairs)})")

    def own_norm(self, position: int) -> float:
        return sum((n * self.idf(self.seed_freq[t])) ** 2 for t, n in self.counts[position].items())


def _squared_counts(grams: Column) -> Column:
    """Sum of squared counts of the entries, from runs of equal neighbours in the sorted array."""
    start = F.struct(F.lit("").alias("term"), F.lit(0).cast("bigint").alias("run"), F.lit(0).cast("bigint").alias("sum"))

    def step(acc: Column, gram: Column) -> Column:
        run = F.when(acc["term"] == gram, acc["run"] + 1).otherwise(F.lit(1).cast("bigint"))
        # Growing a run from r - 1 to r adds r^2 - (r - 1)^2 = 2r - 1.
        return F.struct(gram.alias("term"), run.alias("run"), (acc["sum"] + 2 * run - 1).alias("sum"))

    return F.aggregate(F.sort_array(grams), start, step, lambda acc: acc["sum"])


def _with_similarity(df: DataFrame, seeds: SeedVectors, wanted: Column) -> DataFrame:
    """Add ``_similar``, the topic whose own text is most similar by TF-IDF cosine, else null.

    Only rows in ``wanted`` are worked on; the arrays of the others stay null. Each step is its
    own column, so that nothing is computed twice.
    """
    kept = F.filter(
        drop_words(words(F.col("_norm")), seeds.stop_words), lambda w: F.char_length(w) > 1
    )
    grams = with_grams(df, F.when(wanted, kept), "_g", 2).withColumn("_grams", F.concat("_g1", "_g2"))
    shared = grams.withColumn(
        "_shared", F.filter("_grams", lambda g: g.isin(sorted(seeds.seed_freq)))
    )
    table = seeds.term_rows()
    hits = F.transform(
        F.array_distinct("_shared"),
        lambda term: F.struct(
            F.size(F.filter("_shared", lambda g: g == term)).cast("double").alias("n"),
            F.element_at(table, term).alias("w"),
        ),
    )
    staged = shared.withColumn("_hits", hits).withColumn(
        "_squares", F.when(F.size("_hits") > 0, _squared_counts(F.col("_grams"))).cast("double")
    )

    def total(value) -> Column:
        return F.aggregate(F.col("_hits"), F.lit(0.0), lambda acc, h: acc + value(h))

    plain = F.lit(seeds.idf(1) ** 2)
    doc_norm = plain * (F.col("_squares") - total(lambda h: h["n"] * h["n"])) + total(
        lambda h: h["n"] * h["n"] * h["w"][0] * h["w"][0]
    )
    scores = []
    for position, rule in enumerate(seeds.rules):
        at = position + 2
        dot = total(lambda h: h["n"] * h["w"][at] * h["w"][0] * h["w"][0])
        norm = F.lit(seeds.own_norm(position)) + total(
            lambda h: h["w"][at] * h["w"][at] * (h["w"][0] * h["w"][0] - h["w"][1] * h["w"][1])
        )
        scores.append(
            F.struct(
                F.coalesce(F.try_divide(dot, F.col("_length") * F.sqrt(norm)), F.lit(0.0)).alias("score"),
                F.lit(-position).alias("position"),
                F.lit(rule.topic_id).alias("id"),
                F.lit(rule.name).alias("name"),
            )
        )
    best = F.array_max(F.filter(F.array(*scores), lambda c: c["score"] > 0))
    return (
        staged.withColumn("_length", F.sqrt(doc_norm))
        .withColumn("_similar", F.when(F.size("_hits") > 0, best))
        .drop("_g1", "_g2", "_grams", "_shared", "_hits", "_squares", "_length")
    )


def classify_macro_topics(
    docs: DataFrame,
    rules: Sequence[TopicRule] = lexicon.DEFAULT_TOPIC_RULES,
    stop_words: Sequence[str] | None = None,
    text: str = "source_text",
    spread_by: str | None = None,
) -> DataFrame:
    """Add the macro topic of each document: keyword rules, then similarity, then catch-all.

    Working on a text costs far more than moving it. Where texts come straight from a few large
    files, or vary much in length, ``spread_by`` names a key to spread them over all tasks first.
    """
    docs = spread(docs, spread_by) if spread_by else docs
    stop_words = lexicon.default_stop_words() if stop_words is None else stop_words
    seeds = SeedVectors(rules, stop_words)
    base = docs.withColumn("_norm", normalize_text(F.col(text)))
    by_rule = base.withColumn("_found", _keyword_hits(rules, F.col("_norm"))).withColumn(
        "_rule", _rule_choice(rules, F.col("_found"))
    )
    # Rows that a rule matched skip the similarity work.
    scored = _with_similarity(by_rule, seeds, F.col("_rule").isNull())
    rule, similar = F.col("_rule"), F.col("_similar")

    def pick(from_rule: Column, from_similar: Column, fallback) -> Column:
        return (
            F.when(rule.isNotNull(), from_rule)
            .when(similar.isNotNull(), from_similar)
            .otherwise(F.lit(fallback))
        )

    source = F.lit(lexicon.MATCHED_SOURCE)
    return scored.withColumns({
        "macro_topic_id": pick(rule["id"], similar["id"], lexicon.CATCH_ALL_ID),
        "macro_topic_name": pick(rule["name"], similar["name"], lexicon.CATCH_ALL_NAME),
        "macro_topic_keywords": pick(rule["keywords"], F.lit(""), ""),
        "topic_confidence": pick(rule["confidence"], similar["score"], 0.0),
        "topic_method": pick(F.lit(lexicon.METHOD_RULES), F.lit(lexicon.METHOD_TFIDF), lexicon.METHOD_NONE),
        "matched_source": pick(source, source, lexicon.MATCHED_NONE),
    }).drop("_norm", "_found", "_rule", "_similar")
