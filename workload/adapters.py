"""The supplied tables in the shapes the library works on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snaptrend.functions.lexicon import TopicRule
from snaptrend.session import configure


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{folder}/{name}.parquet")


def cents(column: str):
    return F.round(F.col(column) * 100).cast("bigint")


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with an instant, a run date and text ids."""
    return table(spark, folder, "events").select(
        F.col("event_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.to_date("ts").alias("run_date"),
        F.col("user_id"),
        F.col("user_id").cast("string").alias("video_id"),
        F.concat(F.lit("ch"), (F.col("user_id") % 10).cast("string")).alias("channel_id"),
        "event_type",
        cents("value").alias("cents"),
        "props",
    )


def latest_day(spark: SparkSession, folder: str):
    """Newest run date as a scalar subquery."""
    return events(spark, folder).select(F.max("run_date")).scalar()


def daily_videos(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshots: per user and day the running totals of views, clicks and purchases."""
    kind = F.col("event_type")
    per_day = events(spark, folder).groupBy("user_id", "video_id", "channel_id", "run_date").agg(
        F.sum(F.when(kind == "view", F.col("cents")).otherwise(0)).alias("v"),
        F.sum(F.when(kind == "click", 1).otherwise(0)).alias("l"),
        F.sum(F.when(kind == "purchase", 1).otherwise(0)).alias("c"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("extracted_at"),
    )
    so_far = Window.partitionBy("video_id").orderBy("run_date")
    return per_day.select(
        "run_date", "video_id",
        F.concat(F.lit("https://host/"), F.col("video_id")).alias("video_url"),
        F.concat(F.lit("user "), F.col("video_id")).alias("title"),
        "channel_id",
        F.concat(F.lit("channel "), F.col("channel_id"), F.lit("/"), (F.col("user_id") % 3).cast("string")).alias("channel_title"),
        F.lit("seen daily").alias("description"),
        F.concat(F.lit("https://host/t/"), F.col("video_id")).alias("thumbnail_url"),
        F.sum("v").over(so_far).alias("view_count"),
        F.sum("l").over(so_far).alias("like_count"),
        F.sum("c").over(so_far).alias("comment_count"),
        F.min("first_ts").over(so_far).alias("published_at"),
        "extracted_at",
    )


def daily_channels(spark: SparkSession, folder: str) -> DataFrame:
    """Channel metadata on the days on which a channel had a signup."""
    return events(spark, folder).where(F.col("event_type") == "signup").groupBy("channel_id", "run_date").agg(
        F.concat(F.lit("channel "), F.col("channel_id")).alias("channel_title"),
        F.count(F.lit(1)).alias("subscriber_count"),
        F.sum("cents").alias("total_view_count"),
        F.count_distinct("user_id").alias("total_video_count"),
    )


def daily_comments(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as a comment on its user; errors have no text."""
    return events(spark, folder).select(
        "run_date", "video_id",
        F.col("event_id").cast("string").alias("comment_id"),
        F.when(F.col("event_type") != "error", F.col("props")).alias("comment_text"),
        F.col("cents").alias("like_count"),
    )


def assignments(spark: SparkSession, folder: str) -> DataFrame:
    """Topic per user and day: the type of the last event. Signups carry the older columns only."""
    last = F.max(F.struct("ts", "event_id", "event_type"))["event_type"]
    rows = events(spark, folder).groupBy("run_date", "user_id", "video_id").agg(last.alias("kind"))
    topic = F.when(F.col("kind") == "error", "other").otherwise(F.col("kind"))
    group = (F.col("user_id") % 10).cast("string")
    newer = F.col("kind") != "signup"
    keywords = F.concat(topic, F.lit(", k"), group)
    return rows.select(
        "run_date", "video_id",
        topic.alias("topic_id"),
        F.upper(topic).alias("topic_name"),
        F.when(newer, topic).alias("macro_topic_id"),
        F.when(newer, F.upper(topic)).alias("macro_topic_name"),
        F.when(newer, F.concat(topic, F.lit("__"), group)).alias("sub_topic_id"),
        F.when(newer, F.concat(topic, F.lit(" group "), group)).alias("sub_topic_name"),
        keywords.alias("topic_keywords"),
        keywords.alias("sub_topic_keywords"),
        F.lit("props").alias("matched_source"),
    )


def order_videos(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as videos of their customer's channel, with the month as run date."""
    return table(spark, folder, "orders").select(
        F.trunc("o_orderdate", "MM").alias("run_date"),
        F.col("o_orderkey").cast("string").alias("video_id"),
        F.col("o_custkey").cast("string").alias("channel_id"),
        F.col("o_orderpriority").alias("channel_title"),
        cents("o_totalprice").alias("view_count"),
        F.length("o_orderstatus").cast("bigint").alias("like_count"),
        F.when(F.col("o_orderstatus") == "O", F.col("o_orderkey") % 100).alias("comment_count"),
    )


def order_channels(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as channels, known in the months in which they have a finished order."""
    months = table(spark, folder, "orders").where(F.col("o_orderstatus") == "F").select(
        F.col("o_custkey").alias("c_custkey"), F.trunc("o_orderdate", "MM").alias("run_date")
    ).distinct()
    return table(spark, folder, "customer").join(months, "c_custkey").select(
        "run_date",
        F.col("c_custkey").cast("string").alias("channel_id"),
        F.col("c_name").alias("channel_title"),
        F.col("c_nationkey").cast("bigint").alias("subscriber_count"),
        cents("c_acctbal").alias("total_view_count"),
        F.length("c_mktsegment").cast("bigint").alias("total_video_count"),
    )


def document_videos(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as videos: the whole text is the description."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("video_id"),
        F.concat_ws(" ", "source", "lang").alias("title"),
        F.col("text").alias("description"),
        F.col("lang").alias("tags"),
        F.col("source").alias("search_query"),
    )


def turn_comments(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns as comments on the document of the same number."""
    return table(spark, folder, "conversations").select(
        F.col("conv_id").cast("string").alias("video_id"),
        F.concat_ws("-", "conv_id", "turn").alias("comment_id"),
        F.col("text").alias("comment_text"),
        F.length("text").cast("bigint").alias("like_count"),
    )


# Words of the supplied texts, since the built-in keywords do not occur in them.
WORD_RULES = (
    TopicRule("english", "English words", ("that", "with", "from", "of the", "threading")),
    TopicRule("french", "Mots français", ("dans", "avec", "pour", "une", "le la", "été")),
    TopicRule("german", "Deutsche Wörter", ("und", "der", "nicht", "sich", "ist", "für", "mit")),
    TopicRule("spanish", "Palabras", ("para", "como", "los", "el la", "del", "con")),
)

# Phrases that never occur as such, so that every document takes the similarity fallback.
SIMILARITY_RULES = (
    TopicRule("english", "that with", ("from that with from", "by and with by that")),
    TopicRule("french", "dans avec", ("pour dans avec pour", "une dans une avec")),
    TopicRule("german", "und nicht", ("sich und sich nicht", "ist mit und ist")),
    TopicRule("spanish", "para como", ("los para los como", "del para como del")),
)
SIMILARITY_STOP_WORDS = ("the", "of", "la", "le", "de", "die")
