"""Short reasons for a recommendation, as array expressions inside the row."""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from pulserank.functions import constants as K
from pulserank.functions.text import clean
from pulserank.operators.shaping import domain_label, topic_label


def _signal(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        return F.lit(0.0)
    value = F.col(name).try_cast("double")
    return F.when(value.isNull() | F.isnan(value), 0.0).otherwise(value)


def _age_text(df: DataFrame, freshness: Column, threshold: float) -> Column:
    days = F.col("days_old").try_cast("bigint") if "days_old" in df.columns else F.lit(None).cast("bigint")
    return (
        F.when(days <= 1, "active in the last 24h")
        .when(days <= 7, "posted this week")
        .when(days <= 30, "active recently")
        .when(freshness >= threshold, "active recently")
    )


def _effort_text(value: Column, threshold: float) -> Column:
    return F.when(value >= threshold, "low effort to engage").when(value >= 0.6, "moderate effort to engage")


def _by_priority(entries: list[tuple[Column, Column]]) -> Column:
    """Texts that are not null, highest priority first; equal priorities in list order."""
    rows = F.array(*[
        F.struct((-priority).alias("p"), F.lit(place).alias("i"), text.alias("t"))
        for place, (priority, text) in enumerate(entries)
    ])
    return F.transform(F.array_sort(F.filter(rows, lambda r: r["t"].isNotNull())), lambda r: r["t"])


def with_reasons(
    df: DataFrame,
    thresholds: Mapping[str, float] = K.REASON_THRESHOLDS,
    n: int = 3,
    weights: Mapping[str, float] = K.SCORE_WEIGHTS,
) -> DataFrame:
    """Add ``why``: up to ``n`` distinct reasons.

    Signals above their threshold come first, by weighted value.  If they are fewer than
    ``n``, the strongest remaining signals follow whatever their value.
    """
    sim, eng = _signal(df, "similarity"), _signal(df, "engagement_score")
    fresh, trend, light = _signal(df, "freshness_score"), _signal(df, "trend_score"), _signal(df, "effort_score")
    label = domain_label(df)
    interest = F.when(F.lower(label) != "unknown", F.concat(F.lit("matches your interest in "), label))
    percent = F.concat(F.bround(sim * 100, 0).cast("bigint").cast("string"), F.lit("% semantic match"))
    popular, active = F.lit("high community engagement"), F.lit("strong recent activity trend")

    def above(value: Column, name: str, text: Column) -> Column:
        return F.when(value >= thresholds[name], text)

    strong = _by_priority([
        (sim * weights["similarity"], above(sim, "similarity", percent)),
        (eng * weights["engagement_score"], above(eng, "engagement_score", popular)),
        (fresh * weights["freshness_score"], _age_text(df, fresh, thresholds["freshness_score"])),
        (trend * weights["trend_score"], above(trend, "trend_score", active)),
        (light * weights["effort_score"], _effort_text(light, thresholds["effort_score"])),
        (sim * 0.25, interest),
    ])
    filler = _by_priority([
        (sim * weights["similarity"], percent),
        (eng * weights["engagement_score"], popular),
        (fresh * weights["freshness_score"], F.coalesce(_age_text(df, fresh, 1.0), F.lit("recent opportunity"))),
        (trend * weights["trend_score"], active),
        (light * weights["effort_score"], F.coalesce(_effort_text(light, 1.0), F.lit("higher effort to engage"))),
        (sim * 0.2, interest),
    ])
    out = df.withColumn("why", F.slice(F.array_distinct(F.concat(F.slice(F.array_distinct(strong), 1, n), filler)), 1, n))
    if "score" not in df.columns and "reranked_score" in df.columns:
        out = out.withColumn("score", F.col("reranked_score").cast("double"))
    return out


def similarity_reasons(df: DataFrame) -> Column:
    """Reasons of a vector based card: similarity tier, engagement, freshness, domain; the first three."""
    sim = _signal(df, "similarity")
    shown = F.format_string("%.2f", sim)
    eng = _signal(df, "engagement_score") if "engagement_score" in df.columns else _signal(df, "score")
    topic = topic_label(df)
    tier = (
        F.when(sim >= 0.85, F.concat(F.lit("high semantic similarity to your profile ("), shown, F.lit(")")))
        .when(sim >= 0.70, F.concat(F.lit("strong semantic match to your interests ("), shown, F.lit(")")))
        .otherwise(F.concat(F.lit("semantic relevance score: "), shown))
    )
    return F.slice(F.array_compact(F.array(
        tier,
        F.when(eng >= 50, F.lit("high community engagement (comments + upvotes)")),
        F.when(_signal(df, "freshness_score") >= 0.05, F.lit("recent enough to engage meaningfully")),
        F.when(topic != "General Tech", F.concat(F.lit("domain: "), topic)),
    )), 1, 3)


def cards(df: DataFrame, score: str = "reranked_score", keys: tuple[str, ...] = ("user_id", "rank")) -> DataFrame:
    """Compact view for display: title, score, reasons, url, source, domain."""
    value = F.col(score).try_cast("double")
    if "score" in df.columns:
        value = F.coalesce(F.col("score").try_cast("double"), value)
    return df.select(
        *[k for k in keys if k in df.columns],
        clean("title").alias("title"),
        F.bround(F.coalesce(value, F.lit(0.0)), 4).alias("score"),
        F.coalesce("why", F.array().cast("array<string>")).alias("why"),
        clean("url").alias("url"),
        clean("source").alias("source"),
        domain_label(df).alias("domain"),
    )


def brief(df: DataFrame) -> DataFrame:
    """Columns of the weekly brief, as far as they exist."""
    names = ("user_id", "rank", "title", "recommended_page", "recommended_topic", "reranked_score",
             "recommendation_score", "writing_prompt", "url")
    return df.select(*[n for n in names if n in df.columns])
