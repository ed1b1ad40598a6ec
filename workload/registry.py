"""The registered queries. Each runs over whole tables and whole texts."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaptrend.functions import dates, text
from snaptrend.functions.dates import date_window
from snaptrend.functions.lexicon import TopicRule
from snaptrend.operators import subtopics, topics, versions
from snaptrend.operators.deltas import with_changes
from snaptrend.operators.phrases import label_phrases
from snaptrend.plans import export, gold_job, ingest, momentum, silver, topic_gold
from snaptrend.plans.video_topics import previous_sub_topics
from snaptrend.plans.video_topics import video_topics as assign_topics
from snaptrend.schemas import (
    CHANNEL_DAILY, CHANNELS_DAILY, CHANNELS_RAW, COMMENTS_CURRENT, COMMENTS_RAW, DASHBOARD_SUMMARY_DAILY, TOPIC_DAILY, TOPIC_TRENDS_DAILY, VIDEO_TOPICS_DAILY,
    VIDEOS_DAILY, VIDEOS_RAW, TableSpec,
)
from snaptrend.session import checkpoint_folder, checkpointed, stored
from snaptrend.sources import landed, snapshots, tables
from snaptrend.sources.json_sink import to_records
from snaptrend.sources.snapshots import align, coerce
from workload import adapters as A

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def shown(column: str):
    """Instant as text with microseconds."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(column)


def as_of(spark, folder):
    return A.events(spark, folder).select(F.max("ts")).scalar()


# --- versions -------------------------------------------------------------------------------


@query
def latest_per_key(spark, folder):
    rows = versions.latest_per_key(
        A.events(spark, folder), ["user_id", "run_date"], [F.col("ts").desc(), F.col("event_id")]
    )
    return rows.select("user_id", "run_date", "event_id", "event_type", "cents", shown("ts"))


def _versioned(spark, folder):
    rows = A.events(spark, folder).withColumn("extracted_at", F.col("ts"))
    is_target = F.col("event_type").isin("view", "click", "signup")
    return rows.where(is_target), rows.where(~is_target)


@query
def upsert_newer(spark, folder):
    """Views, clicks and signups are the current table, the others arrive; key is user and day."""
    target, source = _versioned(spark, folder)
    keys = ["video_id", "run_date"]
    current = versions.latest_per_key(target, keys, [F.col("extracted_at").desc(), F.col("event_id")])
    merged = versions.upsert_newer(current, source, keys, tie=[F.col("event_id")])
    return merged.select("video_id", "run_date", "event_id", "event_type", "cents", shown("extracted_at"))


@query
def upsert_moves_date(spark, folder):
    """Key is the user alone: a newer version moves the row to its own day."""
    target, source = _versioned(spark, folder)
    current = versions.latest_per_key(target, ["video_id"], [F.col("extracted_at").desc(), F.col("event_id")])
    merged = versions.upsert_newer(current, source, ["video_id"], tie=[F.col("event_id")])
    return merged.select("video_id", "run_date", "event_id", "event_type", "cents", shown("extracted_at"))


@query
def upsert_changes(spark, folder):
    """Rows an upsert writes, with the date each one supersedes."""
    target, source = _versioned(spark, folder)
    current = versions.latest_per_key(target, ["video_id"], [F.col("extracted_at").desc(), F.col("event_id")])
    changes = versions.split_upsert(current, source, ["video_id"], tie=[F.col("event_id")])
    return changes.select("video_id", "run_date", "event_id", F.col("_old_date").alias("old_date"))


@query
def search_merge(spark, folder):
    """Users found through several event types; their first values in type order."""
    hits = A.events(spark, folder).select(
        "video_id", F.col("event_type").alias("search_query"),
        F.when(F.col("event_type") != "click", F.col("props")).alias("title"),
        "cents",
    )
    return versions.merge_hits(hits)


@query
def distinct_channels(spark, folder):
    return ingest.wanted_channels(A.order_videos(spark, folder))


@query
def first_per_key(spark, folder):
    """Duplicate comments on a day and text dropped, the most liked kept."""
    order = [F.col("like_count").desc(), F.col("comment_id")]
    rows = versions.first_per_key(A.daily_comments(spark, folder), ["run_date", "comment_text"], order)
    return rows.select("run_date", "comment_text", "comment_id", "like_count")


@query
def previous_state_lookup(spark, folder):
    """Latest row of each sub-topic before the newest day."""
    return previous_sub_topics(_topic_daily(spark, folder), A.latest_day(spark, folder))


# --- momentum and trends --------------------------------------------------------------------

FRESH = "29 days 12 hours"
LIMITS = momentum.DiscoveryLimits(driver_comments=1, driver_rate=0.0001, gem_views=3_000)


def _momentum(spark, folder):
    return momentum.video_momentum(A.daily_videos(spark, folder), as_of(spark, folder), FRESH)


@query
def video_momentum(spark, folder):
    return _momentum(spark, folder).select(
        "run_date", "video_id", "title", "channel_id", "view_count", "like_count", "comment_count",
        "previous_view_count", "previous_like_count", "previous_comment_count", "views_gained",
        "likes_gained", "comments_gained", "pct_growth", "momentum_score", "video_age_hours",
    )


@query
def video_discovery(spark, folder):
    return momentum.video_discovery(_momentum(spark, folder), LIMITS)


@query
def counter_changes_hot_keys(spark, folder):
    """Change between neighbouring events of a type: few keys, so each is cut into hours."""
    rows = A.events(spark, folder).select("event_type", "event_id", "ts", "cents", "user_id")
    changed = with_changes(
        rows, ["event_type"], ["ts", "event_id"],
        {"cents": ("previous_cents", "cents_change"), "user_id": ("previous_user", "user_change")},
        split=F.date_trunc("hour", "ts"),
    )
    return changed.select(
        "event_id", "event_type", "cents", "previous_cents", "cents_change", "previous_user", "user_change"
    )


# --- gold -----------------------------------------------------------------------------------


def _topic_daily(spark, folder):
    return topic_gold.topic_daily(
        A.assignments(spark, folder), A.daily_videos(spark, folder), A.daily_comments(spark, folder)
    )


def _stored_topics(spark, folder):
    """The gold topic table as exports read it: stored once, then read several times."""
    return checkpointed(_topic_daily(spark, folder))


@query
def topic_daily(spark, folder):
    return _topic_daily(spark, folder).drop("processed_at")


@query
def topic_trends(spark, folder):
    return topic_gold.topic_trends(_topic_daily(spark, folder)).drop("processed_at")


@query
def channel_daily(spark, folder):
    return topic_gold.channel_daily(A.order_videos(spark, folder), A.order_channels(spark, folder)).drop("processed_at")


def _summary(spark, folder):
    return topic_gold.dashboard_summary(
        A.daily_videos(spark, folder), A.daily_channels(spark, folder), A.daily_comments(spark, folder),
        A.assignments(spark, folder), processed_at=as_of(spark, folder),
    )


@query
def dashboard_summary(spark, folder):
    return _summary(spark, folder).drop("processed_at")


# --- exports --------------------------------------------------------------------------------

# The span of the supplied events.
WINDOW = date_window("2023-12-31", "2024-01-31")


@query
def date_bounds(spark, folder):
    return export.date_bounds(A.daily_videos(spark, folder), A.assignments(spark, folder))


@query
def metadata(spark, folder):
    rows = export.metadata(A.daily_videos(spark, folder), A.assignments(spark, folder), WINDOW.days)
    return rows.drop("generated_at")


@query
def dashboard_summary_export(spark, folder):
    return export.summary_of_day(_summary(spark, folder), A.latest_day(spark, folder))


@query
def top_relevant_topics(spark, folder):
    return export.top_relevant_topics(_stored_topics(spark, folder), WINDOW)


@query
def topics_over_time_dense(spark, folder):
    return export.topics_over_time(_stored_topics(spark, folder), WINDOW, limit=3)


@query
def topic_share(spark, folder):
    return export.topic_share(_stored_topics(spark, folder), A.latest_day(spark, folder))


@query
def topic_changes(spark, folder):
    return export.topic_changes(_stored_topics(spark, folder), A.latest_day(spark, folder))


@query
def top_topics(spark, folder):
    return export.top_topics(_stored_topics(spark, folder), A.latest_day(spark, folder))


@query
def catch_all_only_share(spark, folder):
    """Share of topics where every topic counts as the catch-all: the fallback keeps them."""
    same = {c: F.lit("other") for c in ("topic_id", "topic_name", "macro_topic_id", "macro_topic_name")}
    return export.topic_share(_stored_topics(spark, folder).withColumns(same), A.latest_day(spark, folder))


@query
def top_videos_by_topic(spark, folder):
    chosen = export.top_relevant_topics(_stored_topics(spark, folder), WINDOW)
    rows = export.top_videos_by_topic(
        A.assignments(spark, folder), A.daily_videos(spark, folder), chosen, A.latest_day(spark, folder)
    )
    return rows.withColumn("published_at", shown("published_at"))


@query
def sub_topics_over_time(spark, folder):
    return export.sub_topics_over_time(_stored_topics(spark, folder), WINDOW)


@query
def top_sub_topics_by_macro(spark, folder):
    return export.top_sub_topics_by_macro(_stored_topics(spark, folder), A.latest_day(spark, folder))


@query
def videos_by_sub_topic(spark, folder):
    rows = export.videos_by_sub_topic(
        A.assignments(spark, folder), A.daily_videos(spark, folder), A.latest_day(spark, folder)
    )
    return rows.withColumn("published_at", shown("published_at"))


@query
def top_channels(spark, folder):
    gold = checkpointed(topic_gold.channel_daily(A.order_videos(spark, folder), A.order_channels(spark, folder)))
    return export.top_channels(gold, gold.select(F.max("run_date")).scalar())


@query
def topics_over_time_json(spark, folder):
    """The nested document of the topic series as JSON text."""
    series = export.topics_over_time(_stored_topics(spark, folder), WINDOW, limit=3)
    return to_records(export.topics_over_time_document(series, WINDOW), "document")


@query
def top_sub_topics_json(spark, folder):
    """Sub-topics nested under their macro topic as JSON text."""
    rows = export.top_sub_topics_by_macro(_stored_topics(spark, folder), A.latest_day(spark, folder))
    slim = rows.select("macro_topic_id", "macro_topic_name", "sub_topic_rank", "sub_topic_id", "keywords", "total_comments")
    return to_records(export.nested_sub_topics(slim), "document")


@query
def json_records(spark, folder):
    """One JSON object per row with nulls, dates, instants and non-ASCII text."""
    rows = A.events(spark, folder).select(
        "event_id", "run_date", F.date_trunc("second", "ts").alias("ts"), "cents",
        F.when(F.col("event_type") != "error", F.concat(F.lit("é "), "event_type")).alias("name"),
    )
    return to_records(rows)


@query
def export_set(spark, folder):
    """All documents of the dashboard written to two folders, and the bytes that are found there."""
    documents = export.dashboard_documents(
        _summary(spark, folder), _topic_daily(spark, folder), A.assignments(spark, folder), A.daily_videos(spark, folder),
        topic_gold.channel_daily(A.daily_videos(spark, folder), A.daily_channels(spark, folder)),
        WINDOW.start, WINDOW.end, topic_limit=3, generated_at=as_of(spark, folder),
    )
    base = f"{checkpoint_folder(spark)}/dashboard-{uuid.uuid4()}"
    copies = [f"{base}/{name}" for name in ("site", "mirror")]
    names = export.export_dashboard(documents, copies)
    found = spark.read.text([f"{c}/{n}" for c in copies for n in names], wholetext=True)
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    return found.groupBy(name.alias("document"), F.col("value").alias("content")).agg(F.count(F.lit(1)).alias("copies"))


# --- scalar expressions ---------------------------------------------------------------------


@query
def normalize_text(spark, folder):
    rows = A.table(spark, folder, "documents")
    norm = text.normalize_text(F.col("text"))
    return rows.select("doc_id", F.md5(norm.cast("binary")).alias("digest"), F.length(norm).cast("bigint").alias("length"))


@query
def slugify(spark, folder):
    rows = A.table(spark, folder, "documents")
    return rows.select("doc_id", text.slugify(F.col("text")).alias("slug"), text.slugify(F.col("lang"), 1).alias("short"))


@query
def iso_duration(spark, folder):
    """Durations spelled from order lines, some with days, some unreadable."""
    rows = A.table(spark, folder, "lineitem")
    hours, minutes, seconds = (F.col(c).cast("bigint") for c in ("l_linenumber", "l_quantity", "l_suppkey"))
    spelled = (
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("P"), hours, F.lit("DT"), minutes, F.lit("H")))
        .when(F.col("l_linestatus") == "F", F.concat(F.lit("PT"), hours, F.lit("H"), minutes, F.lit("M"), seconds, F.lit("S")))
        .otherwise(F.concat(F.lit("PT"), minutes, F.lit("X")))
    )
    parsed = rows.select("l_orderkey", "l_linenumber", text.iso_duration_seconds(spelled).alias("seconds"))
    return parsed.groupBy("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber")).agg(
        F.sum("seconds").alias("seconds"), F.count(F.lit(1)).alias("lines"), F.count("seconds").alias("readable")
    )


@query
def schema_normalize(spark, folder):
    """Text columns coerced to declared types; what does not fit is null."""
    rows = A.table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("video_id"),
        F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("ts").cast("string")).alias("published_at"),
        F.when(F.col("event_type") == "view", "").otherwise(F.col("user_id").cast("string")).alias("view_count"),
        F.when(F.col("event_type") == "click", "many").otherwise(F.lit("7")).alias("like_count"),
        F.to_date("ts").cast("string").alias("run_date"),
    )
    typed = align(coerce(rows, VIDEOS_RAW.schema), VIDEOS_RAW.schema)
    return typed.select("video_id", "run_date", shown("published_at"), "view_count", "like_count", "comment_count")


@query
def date_window_local(spark, folder):
    """UTC bounds of the three local days up to each order date."""
    days = A.table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("run_date")).distinct()
    after, before = dates.search_window_utc(F.col("run_date"))
    rows = days.select("run_date", after.alias("published_after_utc"), before.alias("published_before_utc"))
    listed = F.size(dates.days_between_inclusive(F.date_sub("run_date", 2), F.col("run_date")))
    return rows.select(
        "run_date", shown("published_after_utc"), shown("published_before_utc"), listed.cast("bigint").alias("days"),
        dates.local_yesterday(F.col("published_after_utc")).alias("day_before"),
    )


# --- landed pages ---------------------------------------------------------------------------


def _pages(rows: DataFrame, keys: list[str], *items) -> DataFrame:
    """A page per row, as a page holds a bounded number of items."""
    return rows.select(*keys, F.to_json(F.struct(F.array(*items).alias("items"))).alias("page"))


@query
def flatten_search(spark, folder):
    """Pages with one hit per event and one entry without a video, flattened again."""
    rows = A.events(spark, folder)

    def item(video_id):
        return F.struct(
            F.struct(video_id.alias("videoId")).alias("id"),
            F.struct(
                F.col("channel_id").alias("channelId"), F.col("props").alias("title"),
                F.struct(F.struct(F.concat(F.lit("u/"), F.col("video_id")).alias("url")).alias("high")).alias("thumbnails"),
            ).alias("snippet"),
            F.lit("kept").alias("etag"),
        )

    found = item(F.when(F.col("event_type") != "error", F.col("event_id").cast("string")))
    pages = _pages(rows, ["event_type"], item(F.lit(None).cast("string")), found)
    flat = landed.flatten_search(pages.withColumnRenamed("event_type", "search_query"))
    return flat.select(
        "search_query", "video_id", "channel_id", "channel_title", "title", "thumbnail_url",
        F.get_json_object("raw_search_json", "$.etag").alias("etag"),
    )


@query
def flatten_details(spark, folder):
    """Detail pages of orders: counters as text, tags, ISO durations."""
    rows = A.table(spark, folder, "orders")
    key = F.col("o_orderkey").cast("string")
    item = F.struct(
        key.alias("id"),
        F.struct(
            F.col("o_orderstatus").alias("categoryId"),
            F.when(F.col("o_orderstatus") == "F", F.array("o_orderstatus", "o_orderpriority")).alias("tags"),
        ).alias("snippet"),
        F.struct(
            F.when(F.col("o_orderstatus") == "P", "").otherwise(key).alias("viewCount"),
            F.when(F.col("o_orderstatus") == "O", "0").alias("likeCount"),
        ).alias("statistics"),
        F.struct(F.concat(F.lit("PT"), F.col("o_custkey").cast("string"), F.lit("S")).alias("duration")).alias("contentDetails"),
    )
    return landed.flatten_video_details(_pages(rows, ["o_orderdate"], item))


@query
def flatten_comments(spark, folder):
    """Comment pages of events; the author id is an object or plain text."""
    rows = A.events(spark, folder)
    author = F.to_json(F.struct(F.col("video_id").alias("value")))
    page = F.concat(
        F.lit('{"items":[{"snippet":{"topLevelComment":{"id":"'), F.col("event_id").cast("string"),
        F.lit('","snippet":{"authorChannelId":'),
        F.when(F.col("event_type") == "view", F.lit('"plain"')).otherwise(author),
        F.lit(',"textDisplay":"'), F.col("event_type"), F.lit('","likeCount":'), F.col("cents").cast("string"),
        F.lit("}}}}]}"),
    )
    flat = landed.flatten_comments(rows.select("video_id", page.alias("page")))
    return flat.select("video_id", "comment_id", "parent_id", "author_channel_id", "comment_text", "like_count")


@query
def flatten_channels(spark, folder):
    rows = A.table(spark, folder, "customer")
    item = F.struct(
        F.col("c_custkey").cast("string").alias("id"),
        F.struct(F.col("c_name").alias("title"), F.col("c_mktsegment").alias("description")).alias("snippet"),
        F.struct(F.col("c_nationkey").cast("string").alias("subscriberCount"), F.lit("").alias("viewCount")).alias("statistics"),
    )
    flat = landed.flatten_channels(_pages(rows, ["c_nationkey", "c_mktsegment"], item))
    return flat.drop("raw_channel_json", "published_at")


@query
def videos_snapshot(spark, folder):
    """Search pages merged per user and joined to detail pages of those with purchases."""
    rows = A.events(spark, folder)
    hit = F.struct(
        F.struct(F.col("video_id").alias("videoId")).alias("id"),
        F.struct(F.col("channel_id").alias("channelId"), F.col("ts").cast("string").alias("publishedAt")).alias("snippet"),
    )
    search = _pages(rows, ["run_date", "event_type"], hit).withColumnRenamed("event_type", "search_query")
    bought = rows.where(F.col("event_type") == "purchase").groupBy("video_id").agg(F.sum("cents").alias("n"))
    detail = F.struct(F.col("video_id").alias("id"), F.struct(F.col("n").cast("string").alias("viewCount")).alias("statistics"))
    details = _pages(bought, [], detail)
    out = ingest.videos_snapshot(search, details, F.lit("2024-01-30"))
    return out.select(
        "run_date", "video_id", "video_url", "channel_id", "search_query", "view_count", "like_count",
        shown("published_at"), shown("published_after_utc"), shown("published_before_utc"),
    )


@query
def comments_snapshot(spark, folder):
    """Comment pages joined to their videos of a day."""
    rows = A.daily_comments(spark, folder)
    item = F.struct(F.struct(F.struct(
        F.col("comment_id").alias("id"),
        F.struct(F.col("comment_text").alias("textDisplay"), F.col("like_count").alias("likeCount")).alias("snippet"),
    ).alias("topLevelComment")).alias("snippet"))
    pages = _pages(rows, ["run_date", "video_id"], item).drop("run_date")
    videos = versions.latest_per_key(A.daily_videos(spark, folder), ["video_id"], [F.col("run_date").desc()])
    return ingest.comments_snapshot(pages, videos).select(
        "run_date", "video_id", "video_url", "video_title", "comment_id", "comment_text", "like_count"
    )


@query
def channels_snapshot(spark, folder):
    """Channel pages of all customers, kept for those with orders."""
    rows = A.table(spark, folder, "customer")
    item = F.struct(
        F.col("c_custkey").cast("string").alias("id"),
        F.struct(F.col("c_name").alias("title"), F.col("c_mktsegment").alias("country")).alias("snippet"),
        F.struct(F.col("c_nationkey").cast("string").alias("subscriberCount")).alias("statistics"),
    )
    pages = _pages(rows, ["c_nationkey", "c_mktsegment"], item)
    wanted = ingest.wanted_channels(A.order_videos(spark, folder))
    out = ingest.channels_snapshot(pages, F.lit("2024-01-30"), wanted=wanted)
    return out.select("run_date", "channel_id", "channel_title", "country", "subscriber_count", "total_view_count")


# --- documents and topics -------------------------------------------------------------------


@query
def build_documents(spark, folder):
    """Text fields and the most liked turns of each document, at the default length."""
    docs = topics.build_documents(
        A.document_videos(spark, folder), A.turn_comments(spark, folder), ["video_id"]
    )
    return docs.select(
        "video_id", F.length("source_text").cast("bigint").alias("length"),
        F.md5(F.col("source_text").cast("binary")).alias("digest"),
    )


def _classified(spark, folder, rules, stop_words):
    docs = A.table(spark, folder, "documents").select("doc_id", F.col("text").alias("source_text"))
    return topics.classify_macro_topics(docs, rules, stop_words, spread_by="doc_id").select(
        "doc_id", "macro_topic_id", "macro_topic_name", "macro_topic_keywords",
        F.round("topic_confidence", 9).alias("topic_confidence"), "topic_method", "matched_source",
    )


@query
def macro_rules(spark, folder):
    return _classified(spark, folder, A.WORD_RULES, A.SIMILARITY_STOP_WORDS)


@query
def macro_tfidf_fallback(spark, folder):
    return _classified(spark, folder, A.SIMILARITY_RULES, A.SIMILARITY_STOP_WORDS)


PHRASE_STOP_WORDS = ("the", "and", "der", "die", "und", "que", "les", "los")


@query
def top_phrases_single_doc(spark, folder):
    docs = A.table(spark, folder, "documents")
    rows = subtopics.document_phrases(docs, ["doc_id"], F.col("text"), PHRASE_STOP_WORDS)
    return rows.select("doc_id", F.array_join("phrases", "|").alias("phrases"))


DISPLAY_TERMS = {"that": "That", "dans": "DANS", "que la": "Que La", "with that": "WITH That"}


@query
def sub_topic_names(spark, folder):
    """Readable name and displayed keywords of every document on its own."""
    docs = A.table(spark, folder, "documents")
    found = subtopics.document_phrases(docs, ["doc_id"], F.col("text"), PHRASE_STOP_WORDS)
    titles = docs.select("doc_id", F.array(F.concat_ws(" ", "source", "lang")).alias("titles"))
    return found.join(titles, "doc_id").select(
        "doc_id",
        text.readable_name(F.col("phrases"), F.col("titles"), DISPLAY_TERMS).alias("name"),
        text.displayed_keywords(F.col("phrases"), DISPLAY_TERMS).alias("keywords"),
    )


@query
def cluster_top_phrases(spark, folder):
    """Phrases of highest mean TF-IDF weight per source, within each language."""
    docs = A.table(spark, folder, "documents").withColumnRenamed("source", "label")
    rows = label_phrases(docs, ["lang"], "doc_id", "text", PHRASE_STOP_WORDS)
    return rows.select(
        "lang", "label", F.array_join("phrases", "|").alias("phrases"),
        F.round(F.get("scores", F.lit(0)), 7).alias("best"),
    )


@query
def subtopic_clusters(spark, folder):
    """Documents of each language in clusters of similar texts: what any correct clustering must give."""
    docs = A.table(spark, folder, "documents").select("doc_id", "lang", "text")
    labels = subtopics.clustered_texts(docs, ["lang"], "doc_id", "text", PHRASE_STOP_WORDS)
    found = docs.join(labels, ["lang", "doc_id"])
    # Equal texts must share a label.
    copies = found.groupBy("lang", "text").agg(F.count_distinct("label").alias("n"))
    parted = copies.groupBy("lang").agg(F.sum(F.col("n") - 1).alias("parted_copies"))
    counted = found.groupBy("lang").agg(F.count(F.lit(1)).alias("documents"), F.count_distinct("label").alias("clusters"))
    return counted.join(parted, "lang")


def _worded_orders(spark, folder, kind):
    """Orders as documents whose words tell their kind; kinds share no word."""
    word = lambda stem, by: F.concat(F.lit(stem), kind, F.lit("x"), (F.col("o_orderkey") % by).cast("string"))
    said = [F.concat(F.lit(stem), kind) for stem in ("grp", "core", "base")]
    return A.table(spark, folder, "orders").select(
        "o_orderkey", kind.alias("kind"), F.concat_ws(" ", *said, word("tail", 3), word("end", 2)).alias("text")
    )


@query
def subtopic_clusters_orders(spark, folder):
    """All orders in five clusters by what their words say, numbered by the smallest order."""
    docs = _worded_orders(spark, folder, F.substring("o_orderpriority", 1, 1)).withColumn("topic", F.lit("orders"))
    labels = subtopics.clustered_texts(docs, ["topic"], "o_orderkey", "text", PHRASE_STOP_WORDS)
    return labels.select("o_orderkey", F.col("label").cast("bigint").alias("label"))


# Orders of even customers are one macro topic, those of odd ones another; each has five priorities.
ORDER_RULES = (
    TopicRule("even", "Even customers", tuple(f"core{n}a" for n in range(1, 6))),
    TopicRule("odd", "Odd customers", tuple(f"core{n}b" for n in range(1, 6))),
)


@query
def video_topics(spark, folder):
    """Topics and sub-topics of all orders as videos of one day, with the first of each sub-topic."""
    day = F.lit("2024-01-30").cast("date")
    side = F.when(F.col("o_custkey") % 2 == 0, "a").otherwise("b")
    orders = _worded_orders(spark, folder, F.concat(F.substring("o_orderpriority", 1, 1), side))
    nothing, zero = F.lit(None).cast("string"), F.lit(0).cast("bigint")
    videos = orders.select(
        day.alias("run_date"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("video_id"),
        F.concat(F.lit("grp"), "kind").alias("title"), F.col("text").alias("description"),
        nothing.alias("tags"), nothing.alias("search_query"), zero.alias("view_count"), zero.alias("comment_count"),
    )
    comments = videos.limit(0).select(
        "run_date", "video_id", nothing.alias("comment_id"), nothing.alias("comment_text"), zero.alias("like_count")
    )
    out = assign_topics(
        videos, comments, _topic_daily(spark, folder), "2024-01-30", ORDER_RULES, PHRASE_STOP_WORDS,
        max_comments=None, max_chars=None, stored_chars=None,
    )
    firsts = out.groupBy("macro_topic_id", "sub_topic_id").agg(F.min("video_id").alias("first_video"), F.count(F.lit(1)).alias("videos"))
    return out.join(firsts, ["macro_topic_id", "sub_topic_id"]).select(
        "video_id", "macro_topic_id", "macro_topic_name", "first_video", "videos", "source_text",
    )


#: Two days of orders; the run date between them has none.
GOLD_DAYS = ("2024-01-01", "2024-01-02", "2024-01-03")


def _silver_of_orders(spark, folder, database):
    """Orders as videos of two days in silver tables, their line items as comments, nations as channels."""
    side = F.when(F.col("o_custkey") % 2 == 0, "a").otherwise("b")
    kind = F.concat(F.substring("o_orderpriority", 1, 1), side)
    days = F.array(*(F.lit(GOLD_DAYS[i]).cast("date") for i in (0, 2)))
    day = F.element_at(days, (F.expr("o_orderkey div 6") % 2 + 1).cast("int"))
    key = F.lpad(F.col("o_orderkey").cast("string"), 12, "0")
    orders = A.table(spark, folder, "orders").withColumns({"kind": kind, "run_date": day, "video_id": key})
    words = _worded_orders(spark, folder, kind).select(F.col("o_orderkey").alias("k"), "text")
    channel = (F.col("o_custkey") % 25).cast("string")
    videos = orders.join(words, F.col("o_orderkey") == F.col("k")).select(
        "run_date", "video_id", F.concat(F.lit("grp"), "kind").alias("title"), F.col("text").alias("description"),
        channel.alias("channel_id"), F.concat(F.lit("channel "), channel).alias("channel_title"),
        A.cents("o_totalprice").alias("view_count"), F.length("o_orderstatus").cast("bigint").alias("like_count"),
        (F.col("o_orderkey") % 100).alias("comment_count"),
    )
    lines = A.table(spark, folder, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    comments = lines.select(
        "run_date", "video_id", F.concat_ws("-", "video_id", "l_linenumber").alias("comment_id"),
        F.when(F.col("l_returnflag") != "R", F.concat(F.lit("talk"), "kind")).alias("comment_text"),
        F.col("l_quantity").cast("bigint").alias("like_count"),
    )
    channels = A.table(spark, folder, "nation").select(
        F.explode(days).alias("run_date"), F.col("n_nationkey").cast("string").alias("channel_id"),
        F.concat(F.lit("channel "), "n_name").alias("channel_title"), F.col("n_regionkey").cast("bigint").alias("subscriber_count"),
    )
    for rows, spec in ((videos, VIDEOS_DAILY), (comments, COMMENTS_CURRENT), (channels, CHANNELS_DAILY)):
        tables.create_table(spark, database, spec)
        tables.append_rows(rows, database, spec)


@query
def gold_backfill(spark, folder):
    """The gold job over three run dates of all orders, one of them without any: what the gold tables hold afterwards.

    The empty date keeps the row it had. Sub-topics of a kind of order keep their id over the dates.
    """
    name = uuid.uuid4().hex
    silver, gold = f"silver_{name}", f"gold_{name}"
    for database in (silver, gold):
        tables.create_database(spark, database)
    _silver_of_orders(spark, folder, silver)
    gold_job.prepare_gold(spark, gold)
    kept = spark.range(1).select(F.lit(GOLD_DAYS[1]).alias("run_date"), F.lit("kept").alias("topic_id"), F.lit(7).alias("videos_count"))
    tables.append_rows(kept, gold, TOPIC_DAILY)
    gold_job.run_gold(spark, silver, gold, GOLD_DAYS, rules=ORDER_RULES, stop_words=PHRASE_STOP_WORDS, starts=1)
    read = lambda spec: spark.table(f"{gold}.{spec.name}")
    first = read(VIDEO_TOPICS_DAILY).groupBy("sub_topic_id").agg(F.min("video_id").alias("first"))
    texts = read(VIDEO_TOPICS_DAILY).groupBy("run_date", "macro_topic_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("source_text")).alias("total"), F.count_distinct("sub_topic_id").alias("change"),
    )
    totals = read(TOPIC_TRENDS_DAILY).join(first, "sub_topic_id", "left")
    parts = (
        texts.select(F.lit("text").alias("kind"), "run_date", F.col("macro_topic_id").alias("a"), F.lit("").alias("b"), "n", "total", "change"),
        totals.select(F.lit("topic"), "run_date", "topic_id", "first", "videos_count", "total_views", "videos_count_change"),
        read(TOPIC_DAILY).join(first, "sub_topic_id", "left").select(
            F.lit("talk"), "run_date", F.coalesce("sample_comments", F.lit("")), "first", "total_comments", "total_likes", F.lit(0).cast("bigint"),
        ),
        read(CHANNEL_DAILY).select(F.lit("channel"), "run_date", "channel_id", "channel_title", "videos_count", "total_views", "subscriber_count"),
        read(DASHBOARD_SUMMARY_DAILY).select(
            F.lit("summary"), "run_date", "top_topic_id", "top_channel_id", "videos_monitored", "total_comments", "comments_available"
        ),
    )
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    out = stored(out)
    for database in (silver, gold):
        spark.sql(f"DROP DATABASE {database} CASCADE")
    return out


def _event_labels(spark, folder):
    """Per event type and day a label whose keywords are the users of that day."""
    rows = A.events(spark, folder)
    return rows.groupBy(F.col("event_type").alias("macro_topic_id"), "run_date").agg(
        F.array_sort(F.collect_set(F.concat(F.lit("u"), (F.col("user_id") % 60).cast("string")))).alias("phrases")
    )


@query
def stable_ids_jaccard(spark, folder):
    """Similarity of each day's keyword set to the earlier day sets of its topic, above 0.45."""
    days = _event_labels(spark, folder)
    labels = days.where(F.col("run_date") >= "2024-01-28").select(
        "macro_topic_id", F.date_diff("run_date", F.lit("2024-01-28").cast("date")).alias("label"),
        F.concat(F.lit("day "), F.col("run_date").cast("string")).alias("name"), "phrases",
    )
    previous = days.where(F.col("run_date") < "2024-01-28").select(
        "macro_topic_id", F.concat_ws("__", "macro_topic_id", F.col("run_date").cast("string")).alias("sub_topic_id"),
        F.array_join("phrases", ", ").alias("keywords"),
    )
    return subtopics.stable_ids(labels, previous).select(
        "macro_topic_id", F.col("label").cast("bigint").alias("label"), "name", "sub_topic_id"
    )


# --- tables and snapshots -------------------------------------------------------------------

MONTHLY = TableSpec("orders_monthly", "silver", "run_date date, video_id string, view_count bigint, note string", ("video_id",))


def _monthly_orders(spark, folder):
    return A.order_videos(spark, folder).select("run_date", "video_id", "view_count")


@query
def snapshot_round_trip(spark, folder):
    """All orders written as monthly snapshots, the last of the newest month once more; two months read back."""
    path = f"{checkpoint_folder(spark)}/snapshots-{uuid.uuid4()}"
    rows = _monthly_orders(spark, folder)
    snapshots.write_snapshot(rows, path, MONTHLY)
    newest = snapshots.read_snapshot(spark, path, MONTHLY)
    # A month that is written again is replaced as a whole.
    last = newest.orderBy(F.col("video_id").cast("bigint").desc()).limit(1)
    again = stored(last.withColumn("note", F.lit("again")))
    snapshots.write_snapshot(again, path, MONTHLY)
    return snapshots.read_snapshot(spark, path, MONTHLY).unionByName(
        snapshots.read_snapshot(spark, path, MONTHLY, snapshots.run_dates(spark, path)[0])
    )


@query
def table_changes(spark, folder):
    """A table that is made, appended to, widened, replaced by month (one month ends up empty), and read back."""
    database = f"changes_{uuid.uuid4().hex}"
    tables.create_database(spark, database)
    narrow = TableSpec("orders_monthly", "silver", "run_date date, video_id string, view_count bigint", ("video_id",))
    rows = _monthly_orders(spark, folder)
    tables.create_table(spark, database, narrow)
    tables.append_rows(rows, database, narrow)
    tables.add_missing_columns(spark, database, MONTHLY)
    months = sorted(r[0] for r in spark.sql(f"SHOW PARTITIONS {database}.orders_monthly").select(F.substring("partition", 10, 10)).collect())
    fresh = rows.where(F.col("run_date") == F.lit(months[-1]).cast("date")).withColumns(
        {"view_count": F.col("view_count") + 1, "note": F.lit("replaced")}
    )
    tables.replace_run_dates(fresh, database, MONTHLY, [months[0], months[-1]])
    out = stored(spark.table(f"{database}.orders_monthly").select("run_date", "video_id", "view_count", "note"))
    tables.replace_table(out.where("note is not null"), database, MONTHLY)
    kept = stored(spark.table(f"{database}.orders_monthly").select("run_date", "video_id", "view_count", F.lit("rebuilt").alias("note")))
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return out.unionByName(kept)


@query
def raw_load(spark, folder):
    """Monthly snapshots of all orders whose files disagree on a type and a column, loaded twice into a declared table."""
    path = f"{checkpoint_folder(spark)}/raw-{uuid.uuid4()}"
    database = f"raw_{uuid.uuid4().hex}"
    rows = A.order_videos(spark, folder).select("run_date", "video_id", "view_count", "like_count", F.col("channel_title").alias("title"))
    odd = F.month("run_date") % 2 == 1
    writer = rows.where(odd).write.partitionBy("run_date")
    writer.parquet(path)
    text = rows.where(~odd).withColumn("view_count", F.concat(F.lit(" "), F.col("view_count").cast("string"))).drop("title")
    text.write.mode("append").partitionBy("run_date").parquet(path)
    tables.create_database(spark, database)
    tables.create_table(spark, database, VIDEOS_RAW)
    for _ in range(2):
        conflicts = snapshots.load_layer(spark, {VIDEOS_RAW.name: path}, database)[VIDEOS_RAW.name]
    told = "; ".join(f"{c.column}: {', '.join(c.types)} as {c.taken}" for c in conflicts)
    months = spark.sql(f"SHOW PARTITIONS {database}.{VIDEOS_RAW.name}").count()
    loaded = spark.table(f"{database}.{VIDEOS_RAW.name}").select("run_date", "video_id", "view_count", "like_count", "title")
    out = stored(loaded.withColumns({"conflicts": F.lit(told), "months": F.lit(months).cast("bigint")}))
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return out


@query
def silver_refresh(spark, folder):
    """All events as raw rows of two days, merged into the silver tables day by day, the second day once more."""
    name = uuid.uuid4().hex
    raw, current = f"raw_{name}", f"silver_{name}"
    days = ("2024-01-15", "2024-01-30")
    events = A.events(spark, folder)
    day = F.when(F.col("run_date") <= days[0], days[0]).otherwise(days[1]).cast("date")
    events = events.withColumns({"run_date": day, "extracted_at": F.col("ts"), "comment_id": F.concat_ws("-", "video_id", "event_type")})
    comments = events.select("run_date", "video_id", "comment_id", F.col("props").alias("comment_text"), F.col("cents").alias("like_count"), "extracted_at")
    videos = events.select("run_date", "video_id", F.col("event_type").alias("title"), "channel_id", F.col("cents").alias("view_count"), "extracted_at")
    channels = events.select("run_date", "channel_id", F.col("cents").alias("subscriber_count"), "extracted_at")
    for database in (raw, current):
        tables.create_database(spark, database)
    for at in (days[0], days[1], days[1]):
        for rows, spec in ((comments, COMMENTS_RAW), (videos, VIDEOS_RAW), (channels, CHANNELS_RAW)):
            tables.replace_table(rows.where(F.col("run_date") == F.lit(at).cast("date")), raw, spec)
        silver.refresh_silver(spark, raw, current, at)
    read = lambda spec: spark.table(f"{current}.{spec.name}")
    out = stored(
        read(COMMENTS_CURRENT).select(F.lit("comment").alias("kind"), "run_date", F.col("comment_id").alias("key"), F.col("like_count").alias("n"), shown("extracted_at"))
        .union(read(VIDEOS_DAILY).select(F.lit("video"), "run_date", "video_id", "view_count", shown("extracted_at")))
        .union(read(CHANNELS_DAILY).select(F.lit("channel"), "run_date", "channel_id", "subscriber_count", shown("extracted_at")))
    )
    for database in (raw, current):
        spark.sql(f"DROP DATABASE {database} CASCADE")
    return out


@query
def mixed_schemas(spark, folder):
    """Topic rows of days written before and after the hierarchy columns were added, read as one and filled in."""
    path = f"{checkpoint_folder(spark)}/topics-{uuid.uuid4()}"
    rows = A.assignments(spark, folder).select(
        "run_date", "video_id", "topic_id", "topic_name", "macro_topic_id", "macro_topic_name", "sub_topic_id", "sub_topic_name"
    )
    older = F.col("run_date") < "2024-01-15"
    rows.where(older).select("run_date", "video_id", "topic_id", "topic_name").write.partitionBy("run_date").parquet(path)
    rows.where(~older).write.mode("append").partitionBy("run_date").parquet(path)
    found, conflicts = snapshots.read_files(spark, path)
    filled = topic_gold.with_hierarchy(found.withColumn("conflicts", F.lit(len(conflicts)).cast("bigint")))
    return filled.select("run_date", "video_id", "topic_id", "macro_topic_id", "macro_topic_name", "sub_topic_id", "sub_topic_name", "conflicts")
