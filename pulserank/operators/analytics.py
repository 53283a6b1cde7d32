"""Volume, distribution and coverage reports.

Every report is one aggregation with partial aggregates on the map side; windows without
a partition run only over its output, which has one row per week or category.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from pulserank.functions import constants as K
from pulserank.functions.text import col


def counts(df: DataFrame, column: str, name: str, count_name: str = "count", ordered: bool = True) -> DataFrame:
    """Rows per value, null as its own value; most frequent first, then by value."""
    out = df.groupBy(F.col(column).alias(name)).agg(F.count("*").alias(count_name))
    return out.orderBy(F.desc(count_name), F.asc(name)) if ordered else out


def active_communities(df: DataFrame) -> DataFrame:
    return counts(df, "analytics_community", "community", "post_count")


def category_distribution(df: DataFrame) -> DataFrame:
    return counts(df, "analytics_category", "category")


def domain_distribution(df: DataFrame) -> DataFrame:
    return counts(df, "analytics_domain", "domain")


def daily_volume(df: DataFrame, created: str = "analytics_created_at") -> DataFrame:
    """Rows per calendar day; values that are no date are left out."""
    return (
        df.select(F.col(created).try_cast("date").alias("day"))
        .where(F.col("day").isNotNull())
        .groupBy("day")
        .agg(F.count("*").alias("count"))
        .orderBy("day")
    )


def weekly_wow(daily: DataFrame, digits: int = 2) -> DataFrame:
    """Posts per Monday week with the change against the previous week that has data.

    ``weekly_count`` sums the posts; ``active_days`` counts the days with posts.  The
    first week has nothing to compare with and is left out.
    """
    weekly = (
        daily.groupBy(F.date_trunc("week", F.col("day").cast("timestamp")).cast("date").alias("week"))
        .agg(F.sum("count").alias("weekly_count"), F.count("*").alias("active_days"))
    )
    by_week = Window.orderBy("week")
    previous = F.col("prev_week_count")
    return (
        weekly.withColumn("prev_week_count", F.lag("weekly_count").over(by_week))
        .where(previous.isNotNull())
        .withColumn("wow_delta", F.col("weekly_count") - previous)
        .withColumn("wow_pct_change", F.round(F.try_divide(F.col("wow_delta"), previous) * 100, digits))
        .orderBy("week")
    )


def last_weeks(weekly: DataFrame, n: int = 12) -> DataFrame:
    """The latest ``n`` weeks of :func:`weekly_wow`, oldest first."""
    return weekly.orderBy(F.desc("week")).limit(n).orderBy("week")


def coverage(
    df: DataFrame,
    column: str = "domain_category",
    unknown_warn: float = K.COVERAGE_UNKNOWN_WARN,
    minimum: float = K.COVERAGE_MINIMUM,
) -> DataFrame:
    """Rows and share per category with two flags.

    ``unknown_warning`` marks the unknown category at or above ``unknown_warn``;
    ``low_coverage`` marks the smallest known category if it is below ``minimum``.
    """
    per = df.groupBy(F.col(column).alias("category")).agg(F.count("*").alias("count"))
    everything = Window.partitionBy()
    known = ~F.col("category").isin("unknown", "other")
    smallest = F.min(F.when(known, F.struct("count", "category"))).over(everything)
    return (
        per.withColumn("share", F.col("count") / F.sum("count").over(everything))
        .withColumn("_smallest", smallest)
        .select(
            "category",
            "count",
            "share",
            ((F.col("category") == "unknown") & (F.col("share") >= unknown_warn)).alias("unknown_warning"),
            F.coalesce((F.col("category") == F.col("_smallest.category")) & (F.col("share") < minimum), F.lit(False)).alias("low_coverage"),
        )
    )


def topic_summary(ranked: DataFrame, score: str = "reranked_score", topic: str = "recommended_topic") -> DataFrame:
    """Per topic: recommendations, mean score, and the best placed title."""
    best = F.min_by("title", F.struct(*[c for c in ("rank", "user_id", "id") if c in ranked.columns]))
    return (
        ranked.groupBy(topic)
        .agg(F.count("id").alias("recommendations"), F.avg(score).alias("avg_score"), best.alias("best_page"))
        .orderBy(F.desc("recommendations"), F.desc("avg_score"), F.asc(topic))
    )


def trend_categories(trends: DataFrame, n: int = 12) -> DataFrame:
    """The ``n`` categories with the largest trend count."""
    return (
        trends.groupBy("category").agg(F.sum("count").alias("count")).orderBy(F.desc("count"), F.asc("category")).limit(n)
    )


def pivot_counts(df: DataFrame, by: Sequence[str], column: str, values: Sequence[str]) -> DataFrame:
    """Rows per key and value, one column per value, 0 where there are none."""
    return df.groupBy(*by).agg(*[F.count_if(F.col(column) == v).alias(v) for v in values])


def headline(
    opportunities: DataFrame, recommendations: DataFrame, topic: str | Column = "recommended_topic", exact: bool = True
) -> DataFrame:
    """Number of opportunities, of recommendations and of topics among them, as one row."""
    distinct = F.count_distinct(col(topic)) if exact else F.approx_count_distinct(col(topic))
    total = opportunities.agg(F.count("*").alias("n")).scalar()
    return recommendations.agg(F.count("*").alias("recommendations"), distinct.alias("topics")).select(
        total.alias("opportunities"), "recommendations", "topics"
    )


def quota_attainment(df: DataFrame, topics: Sequence[str], target: int, column: str = "topic") -> DataFrame:
    """Rows per wanted topic against the target, topics without any row included."""
    per = df.where(F.col(column).isin(*topics)).groupBy(column).agg(F.count("*").alias("collected"))
    wanted = df.sparkSession.createDataFrame([(t,) for t in topics], f"{column} string")
    collected = F.coalesce("collected", F.lit(0))
    return wanted.join(F.broadcast(per), column, "left").select(
        column,
        collected.cast("bigint").alias("collected"),
        F.lit(target).cast("bigint").alias("target"),
        F.greatest(F.lit(target) - collected, F.lit(0)).cast("bigint").alias("shortfall"),
    )


def stage_counts(counts_by_stage: Mapping[str, DataFrame]) -> DataFrame:
    """One row per stage with its number of rows."""
    parts = [
        frame.agg(F.count("*").alias("rows")).select(F.lit(name).alias("stage"), "rows")
        for name, frame in counts_by_stage.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
