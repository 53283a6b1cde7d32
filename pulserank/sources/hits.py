"""Landed search-hit pages and item details, to flat records."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pulserank.functions import constants as K
from pulserank.functions.text import clean
from pulserank.functions.urls import url_host

HIT_SCHEMA = (
    "hits array<struct<objectID:string,story_id:bigint,title:string,url:string,points:bigint,"
    "num_comments:bigint,created_at_i:bigint,author:string,story_text:string>>"
)
ITEM_SCHEMA = (
    "id string, by string, type string, title string, text string, url string, score bigint, "
    "descendants bigint, time bigint, deleted boolean, dead boolean"
)
_ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """One row per hit of the landed result pages."""
    pages = spark.read.schema(HIT_SCHEMA).json(path)
    return pages.select(F.explode("hits").alias("h")).select("h.*")


def read_items(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ITEM_SCHEMA).json(path)


def _time(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), _ISO)


def search_records(hits: DataFrame, cutoff: int) -> DataFrame:
    """Records of hits that are not deleted, are recent enough and have a numeric id.

    ``external_url`` is kept for :func:`join_items`.
    """
    title, author = clean("title"), clean("author")
    story = F.when(F.coalesce("story_id", F.lit(0)) != 0, F.col("story_id").cast("string")).otherwise(
        F.coalesce("objectID", F.lit(""))
    )
    return hits.select(
        story.alias("id"),
        F.lit("hackernews").alias("source"),
        title.alias("title"),
        F.lit("").alias("text"),
        F.concat(F.lit(K.ITEM_PAGE), story).alias("url"),
        F.coalesce("points", F.lit(0)).cast("bigint").alias("score"),
        F.coalesce("num_comments", F.lit(0)).cast("bigint").alias("num_comments"),
        _time(F.col("created_at_i")).alias("created_utc"),
        url_host("url").alias("domain"),
        F.col("url").alias("external_url"),
        author.alias("_author"),
        F.col("created_at_i").alias("_at"),
    ).where(
        ~F.lower("title").isin(*K.DELETED_HIT_MARKERS)
        & ~F.col("_author").isin(*K.DELETED_HIT_MARKERS)
        & (F.col("_at") >= cutoff)
        & F.rlike("id", F.lit(r"^\d+$"))
    ).drop("_author", "_at")


def beginner_records(hits: DataFrame) -> DataFrame:
    """Records of hits with an id, a title and a time; the url falls back to the discussion page."""
    key, link = clean("objectID"), clean("url")
    return hits.where((key != "") & (clean("title") != "") & (F.coalesce("created_at_i", F.lit(0)) != 0)).select(
        key.alias("id"),
        F.lit("hackernews").alias("source"),
        clean("title").alias("title"),
        clean("story_text").alias("text"),
        F.when(link != "", link).otherwise(F.concat(F.lit(K.ITEM_PAGE), key)).alias("url"),
        F.coalesce("points", F.lit(0)).cast("bigint").alias("score"),
        F.coalesce("num_comments", F.lit(0)).cast("bigint").alias("num_comments"),
        _time(F.col("created_at_i")).alias("created_utc"),
    ).withColumn("domain", F.when(F.startswith("url", F.lit("http")), url_host("url")))


def join_items(records: DataFrame, items: DataFrame) -> DataFrame:
    """Live records with the details of their item; the item's values win where present."""
    live = items.where(
        ~F.coalesce("deleted", F.lit(False))
        & ~F.coalesce("dead", F.lit(False))
        & F.coalesce(F.col("type") == "story", F.lit(True))
        & ~clean("by").isin(*K.DELETED_HIT_MARKERS)
    ).select("id", *[F.col(c).alias(f"_{c}") for c in ("title", "text", "url", "score", "descendants", "time")])
    title = clean(F.coalesce(F.nullif("_title", F.lit("")), F.col("title")))
    link = F.coalesce(F.nullif("_url", F.lit("")), F.col("external_url"))
    return (
        records.join(live, "id")
        .select(
            "id", "source", title.alias("title"), clean("_text").alias("text"), "url",
            F.coalesce(F.nullif("_score", F.lit(0)), F.col("score")).cast("bigint").alias("score"),
            F.coalesce("_descendants", "num_comments").cast("bigint").alias("num_comments"),
            F.when(F.coalesce("_time", F.lit(0)) != 0, _time(F.col("_time"))).otherwise(F.col("created_utc")).alias("created_utc"),
            url_host(link).alias("domain"),
        )
        .where(~F.col("title").isin(*K.DELETED_HIT_MARKERS))
    )


def with_texts(records: DataFrame, texts: DataFrame) -> DataFrame:
    """Records whose ``text`` is the ``id`` of a landed text, with that text.

    They join last, so a text that many items share is moved once. Records without a landed text are dropped.
    """
    found = texts.select(F.col("id").alias("_text_id"), clean("text").alias("_body"))
    rows = records.withColumnRenamed("text", "_text_id").join(found, "_text_id")
    return rows.select(*[F.col("_body").alias("text") if c == "text" else c for c in records.columns])
