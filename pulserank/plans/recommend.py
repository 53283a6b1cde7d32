"""Vectors and snapshot to explained recommendations, for all users in one job."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame

from pulserank.operators.evaluation import ndcg
from pulserank.operators.explain import with_reasons
from pulserank.operators.neighbors import join_candidates, knn
from pulserank.operators.ranking import proxy_relevance, rerank, scored_candidates


def candidates(users: DataFrame, items: DataFrame, snapshot: DataFrame, top_k: int = 100, **search) -> DataFrame:
    """Nearest items of every user with their snapshot rows."""
    return join_candidates(knn(users, items, top_k, **search), snapshot)


def recommend(
    pool: DataFrame,
    reference_ts: str | Column,
    method: str = "simple",
    bonus: float = 0.05,
    lam: float = 0.7,
    top_n: int | None = None,
) -> DataFrame:
    """Scored, re-ranked and explained rows of a candidate pool."""
    scored = scored_candidates(pool, reference_ts)
    return with_reasons(rerank(scored, method, bonus, lam, top_n))


def list_quality(pool: DataFrame, reference_ts: str | Column, k: int = 10, **options) -> DataFrame:
    """NDCG of every user's list by stand-in relevance, before and after re-ranking."""
    scored = scored_candidates(pool, reference_ts)
    before = ndcg(scored.withColumn("_rel", proxy_relevance(scored)), "_rel", "final_score", k)
    ranked = rerank(scored, **options)
    after = ndcg(ranked.withColumn("_rel", proxy_relevance(ranked)), "_rel", "reranked_score", k)
    return after.withColumnRenamed("ndcg", "ndcg_at_k").join(
        before.withColumnRenamed("ndcg", "ndcg_at_k_before"), "user_id"
    )
