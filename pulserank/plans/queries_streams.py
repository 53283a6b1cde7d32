"""Structured Streaming queries: each reads the events as a stream until they are exhausted and returns what the sink holds."""
from __future__ import annotations

from pyspark.sql import functions as F

from pulserank.operators import analytics
from pulserank.operators.dedup import keep_best
from pulserank.operators.shaping import analytics_view
from pulserank.plans import adapters as A, oracle_parts as O
from pulserank.plans.catalog import query
from pulserank.plans.queries_feedback import FOLD, vector_view
from pulserank.session import scratch_path
from pulserank.streaming import feed, user_state

_DELAY = "45 days"


def events(spark, sf):
    schema = A.table(spark, sf, "events").schema
    # The pattern matches a single file as well as a folder of part files.
    stream = spark.readStream.schema(schema).parquet(f"{sf}/events.parquet*")
    return stream.withColumn("ingested_at", F.col("ts").cast("timestamp"))


def drain(df, name):
    """Run the stream to its end into a Parquet folder; the folder and the query."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    running = feed.append(df, path, f"{path}-checkpoint", fmt="parquet")
    running.awaitTermination()
    return spark.read.schema(df.schema).parquet(path), running


def _fingerprint():
    return F.md5(F.concat("event_type", F.lit("::"), F.col("user_id").cast("string")))


@query("stream_dedup", "SELECT DISTINCT event_type, user_id, md5(event_type || '::' || user_id) AS fp FROM events")
def stream_dedup(spark, sf):
    once = feed.dedup(events(spark, sf), _DELAY, _fingerprint())
    return drain(once.select("event_type", "user_id", "fp"), "dedup")[0]


@query("stream_dedup_forever", "SELECT DISTINCT event_type, user_id, md5(event_type || '::' || user_id) AS fp FROM events")
def stream_dedup_forever(spark, sf):
    once = feed.dedup(events(spark, sf), None, _fingerprint())
    return drain(once.select("event_type", "user_id", "fp"), "dedup")[0]


@query("stream_throughput", """SELECT count(DISTINCT event_type || '::' || user_id) AS processed, count(*) - count(DISTINCT event_type || '::' || user_id) AS duplicates, 0::BIGINT AS late, count(*) AS total FROM events""")
def stream_throughput(spark, sf):
    """Over several micro-batches: the events landed in twelve files, two a batch."""
    path = scratch_path(spark, "landing")
    A.table(spark, sf, "events").repartition(12, "event_id").write.parquet(path)
    stream = spark.readStream.schema(A.table(spark, sf, "events").schema).option("maxFilesPerTrigger", "2").parquet(path)
    once = feed.dedup(stream, key=_fingerprint()).select("fp")
    with feed.FeedCounts(spark) as counts:
        _, running = drain(once, "throughput")
        totals = counts.totals(query=running)
    return spark.createDataFrame([totals], "processed bigint, duplicates bigint, late bigint, total bigint")


@query("stream_volume", """WITH w AS (SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS events FROM events GROUP BY ALL)
SELECT CAST(day AS VARCHAR) AS day, event_type, events FROM w WHERE day + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 2 DAY""")
def stream_volume(spark, sf):
    """Windows that the watermark has closed."""
    counted = feed.volume(events(spark, sf), "1 day", "2 days", "ingested_at", "event_type")
    closed, _ = drain(counted, "volume")
    return closed.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "event_type", "events")


def landed(spark, sf):
    """The feed as landed JSON files, read two files a micro-batch."""
    path = scratch_path(spark, "landed")
    A.feed(spark, sf).select(
        F.col("event_id").cast("string").alias("event_id"), "source", "title", "url", "score", "num_comments",
        F.when(F.col("url") == "", "").otherwise(F.regexp_extract("url", "//([^/]*)", 1)).alias("domain"),
        (F.unix_micros("created_utc") / 1_000_000).alias("ingested_at"),
    ).repartition(6, "event_id").write.json(path)
    return feed.read_feed(spark, path, max_files=2).withColumnRenamed("ingested_at", "created_utc")


def current(report, name):
    """The report after the whole feed."""
    spark = report.sparkSession
    path = scratch_path(spark, name)
    feed.publish(report, path, f"{path}-checkpoint").awaitTermination()
    return spark.read.schema(report.schema).parquet(path)


@query("stream_live_daily", f"WITH {O.FEED} SELECT CAST(CAST(created_utc AS DATE) AS VARCHAR) AS day, count(*) AS count FROM feed GROUP BY 1")
def stream_live_daily(spark, sf):
    return current(analytics.daily_volume(analytics_view(landed(spark, sf))), "daily").withColumn("day", F.col("day").cast("string"))


@query("stream_live_communities", f"""WITH {O.FEED} SELECT source || '::' || CASE WHEN url = '' THEN 'unknown' ELSE regexp_extract(url, '//([^/]*)', 1) END AS community, count(*) AS post_count
FROM feed GROUP BY 1""")
def stream_live_communities(spark, sf):
    return current(analytics.active_communities(analytics_view(landed(spark, sf))), "communities")


@query("stream_incremental_daily", f"WITH {O.FEED} SELECT CAST(CAST(created_utc AS DATE) AS VARCHAR) AS day, count(*) AS count FROM feed GROUP BY 1")
def stream_incremental_daily(spark, sf):
    """Partial results of twenty micro-batches, each of them stored twice as after a lost driver."""
    landing, path = scratch_path(spark, "landed"), scratch_path(spark, "partials")
    A.feed(spark, sf).select("event_id", "created_utc").repartition(20, "event_id").write.parquet(landing)
    stream = spark.readStream.schema("event_id bigint, created_utc timestamp").option("maxFilesPerTrigger", "1").parquet(landing)

    def daily(batch):
        return analytics.daily_volume(batch, "created_utc")

    store = feed.write_partial(daily, path)

    def twice(batch, number):
        store(batch, number)
        store(batch, number)

    writer = stream.writeStream.foreachBatch(twice).option("checkpointLocation", f"{path}-checkpoint").trigger(availableNow=True)
    writer.start().awaitTermination()
    return feed.merged(spark, path, "day date, count bigint", ["day"], ["count"]).withColumn("day", F.col("day").cast("string"))


@query("stream_feedback", f"WITH {FOLD} SELECT user_id, events, round(e[1], 6) AS first, round(list_sum(e), 6) AS total, round(list_inner_product(e, e), 6) AS square FROM folded WHERE events > 0")
def stream_feedback(spark, sf):
    """The change log of the user vectors, reduced to the latest vector of every user."""
    n = A.table(spark, sf, "embeddings").count()
    acts = events(spark, sf).select(
        F.col("user_id").cast("string").alias("user_id"), (F.col("event_id") % n).cast("string").alias("opportunity_id"),
        A._case("event_type", A.ACTIONS, F.lit(None).cast("string")).alias("action"), F.col("ingested_at").alias("ts"), "event_id",
    )
    moved = user_state.vector_state(acts, A.feedback_users(spark, sf), A.feedback_items(spark, sf))
    log, _ = drain(moved, "vectors")
    return vector_view(keep_best(log, F.col("user_id"), [F.desc("events")]))
