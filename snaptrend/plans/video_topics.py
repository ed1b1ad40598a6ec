"""Topic assignment of the videos of one run date."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaptrend.functions import lexicon
from snaptrend.functions.dates import as_date
from snaptrend.functions.lexicon import TopicRule
from snaptrend.functions.text import displayed_keywords, readable_name
from snaptrend.operators.ranking import top_per_group
from snaptrend.operators.subtopics import (
    cluster_documents, cluster_phrases, distinct_texts, document_phrases, labels_of_copies, stable_ids, term_weights,
)
from snaptrend.operators.topics import build_documents, classify_macro_topics
from snaptrend.operators.versions import latest_before
from snaptrend.plans.topic_gold import on_date, stamp
from snaptrend.session import checkpointed, stored

LABEL = ["macro_topic_id", "label"]


def previous_sub_topics(topics: DataFrame, run_date: str | date | Column) -> DataFrame:
    """Latest row of each sub-topic strictly before a date."""
    day = run_date if isinstance(run_date, Column) else F.lit(as_date(run_date, "run_date"))
    known = topics.where(F.col("sub_topic_id").isNotNull()).select(
        "run_date", "macro_topic_id", "sub_topic_id", "sub_topic_name", "keywords"
    )
    tie = [F.col("sub_topic_name"), F.col("keywords")]
    return latest_before(known, ["macro_topic_id", "sub_topic_id"], day, tie=tie).drop("run_date")


def _representative_titles(docs: DataFrame, labels: DataFrame, limit: int = 3) -> DataFrame:
    order = [
        F.col("comment_count").desc_nulls_last(), F.col("view_count").desc_nulls_last(), F.col("video_id"),
    ]
    titled = labels.join(docs.select("video_id", "title", "comment_count", "view_count"), "video_id")
    best = top_per_group(titled, LABEL, order, limit, "_rank")
    listed = F.array_sort(F.collect_list(F.struct("_rank", F.coalesce("title", F.lit("")).alias("t"))))
    return best.groupBy(*LABEL).agg(F.transform(listed, lambda x: x["t"]).alias("titles"))


def assign_sub_topics(
    docs: DataFrame,
    previous: DataFrame,
    stop_words: Sequence[str],
    starts: int = 10,
    threshold: float = 0.45,
) -> DataFrame:
    """Sub-topic id, name and keywords per video of one run date.

    All macro topics are clustered at once, on the weights from which the phrases are taken too. A topic
    of one document, or without a usable term, has a sub-topic per document. The catch-all topic has one
    fixed sub-topic.
    """
    catch_all = lexicon.CATCH_ALL_ID
    specific = docs.where(F.col("macro_topic_id") != catch_all)
    # Copies of a text are weighed and clustered once.
    texts, copies = distinct_texts(specific, ["macro_topic_id"], "video_id", "source_text")
    texts = stored(texts)
    weights = stored(term_weights(texts, ["macro_topic_id"], "video_id", "source_text", stop_words, copies="copies"))
    # One row per macro topic: how many documents, and whether any term is left.
    usable = weights.select("macro_topic_id").distinct().withColumn("_usable", F.lit(True))
    sizes = specific.groupBy("macro_topic_id").agg(F.count(F.lit(1)).alias("n")).join(
        usable, "macro_topic_id", "left"
    ).collect()
    alone = sorted(r["macro_topic_id"] for r in sizes if r["n"] == 1 or not r["_usable"])
    together = sorted(r["macro_topic_id"] for r in sizes if r["macro_topic_id"] not in alone)

    described, members = [], []
    if together:
        own = F.col("macro_topic_id").isin(together)
        labels = cluster_documents(
            weights.where(own), texts.where(own), ["macro_topic_id"], "video_id", starts=starts, copies="copies"
        )
        # Labels are text, so that clusters and single documents can be stacked; up to five
        # clusters sort alike as numbers and as text.
        of_texts = stored(
            labels.join(texts.drop("source_text"), ["macro_topic_id", "video_id"])
            .select("macro_topic_id", "video_id", F.col("label").cast("string").alias("label"), "copies")
        )
        phrases = cluster_phrases(weights, of_texts, ["macro_topic_id"], "video_id", copies="copies").drop("scores")
        all_labels = of_texts.select(*LABEL).distinct()
        labels = stored(labels_of_copies(of_texts, copies, ["macro_topic_id"], "video_id"))
        described.append(
            all_labels.join(phrases, LABEL, "left")
            .join(_representative_titles(specific, labels), LABEL, "left")
            .withColumn("phrases", F.coalesce("phrases", F.array().cast("array<string>")))
        )
        members.append(labels.select(*LABEL, "video_id"))
    if alone:
        single = specific.where(F.col("macro_topic_id").isin(alone))
        text = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("source_text", F.lit("")))
        found = document_phrases(single.withColumn("_text", text), ["macro_topic_id", "video_id"], F.col("_text"), stop_words)
        labels = _numbered_documents(single)
        described.append(
            labels.join(found, ["macro_topic_id", "video_id"])
            .join(single.select("video_id", F.array(F.coalesce("title", F.lit(""))).alias("titles")), "video_id")
            .select(*LABEL, "phrases", "titles")
        )
        members.append(labels.select(*LABEL, "video_id"))

    other = docs.where(F.col("macro_topic_id") == catch_all).select(
        "video_id",
        F.lit(lexicon.CATCH_ALL_SUB_ID).alias("sub_topic_id"),
        F.lit(lexicon.CATCH_ALL_NAME).alias("sub_topic_name"),
        F.lit("").alias("sub_topic_keywords"),
    )
    if not described:
        return other
    named = reduce(DataFrame.unionByName, described).withColumn(
        "name", readable_name(F.col("phrases"), F.col("titles"))
    )
    payload = stable_ids(stored(named.drop("titles")), previous, threshold=threshold).select(
        *LABEL, "sub_topic_id", F.col("name").alias("sub_topic_name"),
        displayed_keywords(F.col("phrases")).alias("sub_topic_keywords"),
    )
    assigned = reduce(DataFrame.unionByName, members).join(checkpointed(payload), LABEL)
    return assigned.select("video_id", "sub_topic_id", "sub_topic_name", "sub_topic_keywords").unionByName(other)


def _numbered_documents(docs: DataFrame) -> DataFrame:
    """Each document its own label, in the order of its id."""
    return docs.select("macro_topic_id", "video_id", F.col("video_id").alias("label"))


def video_topics(
    videos: DataFrame,
    comments: DataFrame,
    topics: DataFrame,
    run_date: str | date,
    rules: Sequence[TopicRule] = lexicon.DEFAULT_TOPIC_RULES,
    stop_words: Sequence[str] | None = None,
    processed_at: Column | None = None,
    starts: int = 10,
    max_comments: int | None = 30,
    max_chars: int | None = 12000,
    stored_chars: int | None = 1200,
) -> DataFrame:
    """Topic assignment of every video of a run date; ``topics`` is the history for stable ids.

    The document of a video takes ``max_comments`` comments and ``max_chars`` characters, and ``stored_chars`` of
    it are kept in the result; each limit may be None.
    """
    stop_words = lexicon.default_stop_words() if stop_words is None else stop_words
    documents = build_documents(
        on_date(videos, run_date), on_date(comments, run_date), max_comments=max_comments, max_chars=max_chars
    )
    docs = classify_macro_topics(documents, rules, stop_words, spread_by="video_id").persist(StorageLevel.MEMORY_AND_DISK)
    kept = F.col("source_text") if stored_chars is None else F.substring("source_text", 1, stored_chars)
    try:
        subs = checkpointed(assign_sub_topics(docs, previous_sub_topics(topics, run_date), stop_words, starts))
        macro = {"macro_topic_id": "topic_id", "macro_topic_name": "topic_name"}
        out = docs.join(subs, "video_id").select(
            "run_date", "video_id",
            *[F.col(c).alias(n) for c, n in macro.items()],
            *macro, "sub_topic_id", "sub_topic_name",
            F.col("sub_topic_keywords").alias("topic_keywords"),
            "macro_topic_keywords", "sub_topic_keywords", "topic_confidence", "topic_method", "matched_source",
            F.coalesce(kept, F.lit("")).alias("source_text"),
            stamp(processed_at).alias("processed_at"),
        )
        return checkpointed(out)
    finally:
        docs.unpersist()
