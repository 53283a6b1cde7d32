"""Candidate scoring and diversity re-ranking, for all users at once.

Windows are partitioned by user and see at most the user's retrieved candidates.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from pulserank.functions import constants as K
from pulserank.functions.vectors import similarity_from_distance
from pulserank.functions.text import clean
from pulserank.operators.classify import effort, effort_score
from pulserank.operators.shaping import informative_domain, is_beginner, rename_aliases, whole_days

FEATURES = ("engagement_score", "freshness_score", "trend_score")


def similarity(df: DataFrame) -> Column:
    """Given similarity, else from the distance, else 0; decided per row."""
    options = []
    if "similarity" in df.columns:
        options.append(F.col("similarity").try_cast("double"))
    if "retrieval_distance" in df.columns:
        options.append(similarity_from_distance("retrieval_distance"))
    if not options:
        raise ValueError("candidates need similarity or retrieval_distance")
    return F.coalesce(*options, F.lit(0.0))


def features(df: DataFrame, reference_ts: str | Column) -> DataFrame:
    """Raw signals of a candidate: engagement, age, freshness, trend, effort, diversity domain."""
    df = rename_aliases(df, K.CANDIDATE_ALIASES)
    reference = F.lit(reference_ts).cast("timestamp") if isinstance(reference_ts, str) else reference_ts

    def number(name: str) -> Column:
        return F.coalesce(F.col(name).try_cast("double"), F.lit(0.0)) if name in df.columns else F.lit(0.0)

    created = F.col("created_utc").try_cast("timestamp") if "created_utc" in df.columns else F.lit(None).cast("timestamp")
    text = F.col("text") if "text" in df.columns else F.lit("")
    return (
        df.withColumns({
            "similarity": similarity(df),
            "engagement_raw": number("score"),
            "comments_raw": number("num_comments"),
            "days_old": F.coalesce(whole_days(created, reference), F.lit(K.MISSING_AGE_DAYS).cast("bigint")),
            "effort": effort(text),
            "diversity_domain": informative_domain(df),
        })
        .withColumns({
            "engagement_score": F.log(F.greatest(F.col("engagement_raw") + F.col("comments_raw"), F.lit(0.0)) + 1.0),
            "freshness_score": F.lit(1.0) / (F.lit(1.0) + F.col("days_old")),
            "trend_score": F.col("comments_raw") / F.greatest(F.col("days_old"), F.lit(1)),
            "effort_score": effort_score("effort"),
        })
    )


def minmax(df: DataFrame, columns: Sequence[str] = FEATURES, by: Sequence[str] = ("user_id",)) -> DataFrame:
    """Scale columns to [0, 1] inside each group; a constant or single value becomes 0."""
    group = Window.partitionBy(*by)
    return df.withColumns({c: scaled(F.col(c), group) for c in columns if c in df.columns})


def scaled(value: Column, group) -> Column:
    value = value.cast("double")
    low, high = F.min(value).over(group), F.max(value).over(group)
    return F.when(high == low, 0.0).otherwise((value - low) / (high - low))


def score(df: DataFrame, weights: Mapping[str, float] = K.SCORE_WEIGHTS, boost: float = 0.10) -> DataFrame:
    """Weighted sum of the signals plus ``boost`` for beginner rows, as ``final_score``."""
    missing = [c for c in weights if c not in df.columns]
    if missing:
        raise ValueError(f"missing ranking columns: {missing}")
    total = None
    for name, weight in weights.items():
        part = F.lit(float(weight)) * F.col(name).cast("double")
        total = part if total is None else total + part
    return df.withColumn("final_score", total + F.when(is_beginner(df), float(boost)).otherwise(0.0))


def _domain_key(df: DataFrame) -> Column:
    name = "diversity_domain" if "diversity_domain" in df.columns else "domain"
    value = clean(name)
    return F.when(value == "", "unknown").otherwise(value)


def rerank(
    df: DataFrame,
    method: str = "simple",
    bonus: float = 0.05,
    lam: float = 0.7,
    top_n: int | None = None,
    score_column: str = "final_score",
    by: str = "user_id",
    position: str = "retrieval_rank",
) -> DataFrame:
    """Add ``reranked_score`` and the final ``rank``; keep ``top_n`` rows per user.

    ``simple``: the best row of every domain gets ``bonus``, then sort by score.

    ``mmr``: greedy maximal marginal relevance with similarity 1 inside a domain and 0
    across.  Because of that, a row is penalised exactly if a row of its domain was
    picked before, and inside a domain rows are picked by score: the greedy order is a
    sort by ``lam·score − (1−lam)·[not the first of its domain]``.  Rows after ``top_n``
    get half their score.  ``mmr_rank`` is the picking order.

    ``none``: the score as it is.  Ties always go to the earlier ``position``.
    """
    domain = _domain_key(df)
    value = F.col(score_column).cast("double")
    ties = F.asc(position)
    in_domain = Window.partitionBy(by, domain)
    in_user = Window.partitionBy(by)
    if method == "simple":
        first = F.row_number().over(in_domain.orderBy(F.desc(score_column), ties)) == 1
        df = df.withColumn("reranked_score", value + F.when(first, float(bonus)).otherwise(0.0))
        order = [F.desc("reranked_score"), F.desc(score_column), ties]
    elif method == "mmr":
        weighted = F.lit(float(lam)) * value
        first = F.row_number().over(in_domain.orderBy(weighted.desc(), ties)) == 1
        df = df.withColumn("_key", weighted - F.lit(1.0 - float(lam)) * F.when(first, 0.0).otherwise(1.0))
        df = df.withColumn("mmr_rank", F.row_number().over(in_user.orderBy(F.desc("_key"), ties)).cast("bigint"))
        kept = F.lit(True) if top_n is None else F.col("mmr_rank") <= top_n
        df = df.withColumn("reranked_score", F.when(kept, value).otherwise(value * 0.5)).drop("_key")
        order = [F.asc("mmr_rank")]
    elif method == "none":
        df = df.withColumn("reranked_score", value)
        order = [ties]
    else:
        raise ValueError("method is 'simple', 'mmr' or 'none'")
    df = df.withColumn("rank", F.row_number().over(in_user.orderBy(*order)).cast("bigint"))
    return df if top_n is None else df.where(F.col("rank") <= top_n)


def proxy_relevance(df: DataFrame, by: str = "user_id", weights: Mapping[str, float] = K.PROXY_WEIGHTS) -> Column:
    """Stand-in relevance: similarity with scaled engagement and comments."""
    group = Window.partitionBy(by)

    def raw(name: str, fallback: str) -> Column:
        return F.coalesce(F.col(name if name in df.columns else fallback).try_cast("double"), F.lit(0.0))

    return (
        F.lit(weights["similarity"]) * F.col("similarity").cast("double")
        + F.lit(weights["engagement"]) * scaled(raw("engagement_raw", "score"), group)
        + F.lit(weights["comments"]) * scaled(raw("comments_raw", "num_comments"), group)
    )


def scored_candidates(candidates: DataFrame, reference_ts: str | Column) -> DataFrame:
    """Features, scaling per user, final score."""
    return score(minmax(features(candidates, reference_ts)))


def skip_penalty(
    ranked: DataFrame,
    feedback: DataFrame,
    score_column: str = "reranked_score",
    item_penalty: float = 0.30,
    domain_penalty: float = 0.05,
    domain_limit: float = 0.20,
) -> DataFrame:
    """Lower rows that the user skipped and rows of domains the user skipped, then rank again.

    ``feedback`` has ``user_id, id, domain, action``.  Both sides of the lookup are
    aggregated to one row per user and item or domain before the join.
    """
    name = "domain" if "domain" in ranked.columns else "domain_category"
    key = F.lower(F.coalesce(F.col(name), F.lit("unknown")))
    skips = feedback.where(F.col("action") == "skip")
    items = skips.select("user_id", F.col("id").cast("string").alias("id")).distinct().withColumn("_item", F.lit(1))
    domains = skips.groupBy("user_id", F.lower(F.coalesce("domain", F.lit("unknown"))).alias("_domain")).agg(
        F.count("*").alias("_skips")
    )
    penalty = F.when(F.col("_item").isNotNull(), float(item_penalty)).otherwise(0.0) + F.least(
        F.coalesce("_skips", F.lit(0)) * F.lit(float(domain_penalty)), F.lit(float(domain_limit))
    )
    lowered = (
        ranked.withColumn("id", F.col("id").cast("string"))
        .withColumn("_domain", key)
        .join(items, ["user_id", "id"], "left")
        .join(domains, ["user_id", "_domain"], "left")
        .withColumn("_before", F.col("rank"))
        .withColumn(score_column, F.col(score_column).cast("double") - penalty)
        .drop("_item", "_skips", "_domain")
    )
    window = Window.partitionBy("user_id").orderBy(F.desc(score_column), F.asc("_before"))
    return lowered.withColumn("rank", F.row_number().over(window).cast("bigint")).drop("_before")
