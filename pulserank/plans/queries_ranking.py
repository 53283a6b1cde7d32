"""Queries over scored and re-ranked candidates."""
from __future__ import annotations

from pyspark.sql import functions as F

from pulserank.operators import analytics, explain, ranking
from pulserank.operators.shaping import page_label, topic_label
from pulserank.plans import adapters as A, oracle_parts as O, recommend as R
from pulserank.plans.catalog import listed, query, r6
from pulserank.plans.queries_retrieval import candidates
from pulserank.plans.queries_snapshot import kept
from pulserank.session import materialise

KEYS = ["user_id", "opportunity_id"]


def scored(spark, sf):
    return ranking.scored_candidates(candidates(spark, sf), A.REFERENCE_TS)


@query("ranking_features", f"""WITH {O.FEAT} SELECT user_id, opportunity_id, round(similarity, 6) AS similarity, round(engagement_score, 6) AS engagement_score,
  engagement_raw, comments_raw, days_old, round(freshness_score, 6) AS freshness_score, round(trend_score, 6) AS trend_score, effort, effort_score, diversity_domain FROM feat2""")
def ranking_features(spark, sf):
    rows = ranking.features(candidates(spark, sf), A.REFERENCE_TS)
    return rows.select(
        *KEYS, r6("similarity"), r6("engagement_score"), "engagement_raw", "comments_raw", "days_old", r6("freshness_score"),
        r6("trend_score"), "effort", "effort_score", "diversity_domain",
    )


@query("final_scores", f"""WITH {O.SCORED} SELECT user_id, opportunity_id, round(engagement_score, 6) AS engagement_score, round(freshness_score, 6) AS freshness_score,
  round(trend_score, 6) AS trend_score, round(final_score, 6) AS final_score FROM scored""")
def final_scores(spark, sf):
    return scored(spark, sf).select(*KEYS, r6("engagement_score"), r6("freshness_score"), r6("trend_score"), r6("final_score"))


@query("rerank_simple", f"WITH {O.SIMPLE} SELECT user_id, opportunity_id, round(final_score, 6) AS final_score, round(reranked_score, 6) AS reranked_score, rank FROM simple WHERE rank <= 25")
def rerank_simple(spark, sf):
    return ranking.rerank(scored(spark, sf), "simple", top_n=25).select(*KEYS, r6("final_score"), r6("reranked_score"), "rank")


@query("rerank_mmr", f"""WITH {O.SCORED}, keyed AS (
  SELECT *, 0.7::DOUBLE * final_score - (1.0::DOUBLE - 0.7::DOUBLE) * CASE WHEN row_number() OVER (PARTITION BY user_id, diversity_domain ORDER BY 0.7::DOUBLE * final_score DESC, retrieval_rank) = 1 THEN 0.0 ELSE 1.0 END AS k FROM scored),
mmr AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY k DESC, retrieval_rank) AS mmr_rank FROM keyed)
SELECT user_id, opportunity_id, mmr_rank, mmr_rank AS rank, round(final_score, 6) AS reranked_score FROM mmr WHERE mmr_rank <= 25""")
def rerank_mmr(spark, sf):
    return ranking.rerank(scored(spark, sf), "mmr", top_n=25).select(*KEYS, "mmr_rank", "rank", r6("reranked_score"))


@query("rerank_none", f"WITH {O.SCORED} SELECT user_id, opportunity_id, round(final_score, 6) AS reranked_score, row_number() OVER (PARTITION BY user_id ORDER BY retrieval_rank) AS rank FROM scored")
def rerank_none(spark, sf):
    return ranking.rerank(scored(spark, sf), "none").select(*KEYS, r6("reranked_score"), "rank")


_AGE = """CASE WHEN days_old <= 1 THEN 'active in the last 24h' WHEN days_old <= 7 THEN 'posted this week' WHEN days_old <= 30 THEN 'active recently'
  WHEN freshness_score >= {t} THEN 'active recently' END"""
_PERCENT = "CAST(round_even(similarity * 100, 0) AS BIGINT) || '% semantic match'"
_INTEREST = f"CASE WHEN lower({O.DOMAIN_LABEL}) <> 'unknown' THEN 'matches your interest in ' || {O.DOMAIN_LABEL} END"
WHY = O.SIMPLE + f""",
reasons AS (
  SELECT user_id, opportunity_id, 0 AS fill, p, i, t FROM (
    SELECT *, unnest([similarity * 0.45::DOUBLE, engagement_score * 0.20::DOUBLE, freshness_score * 0.15::DOUBLE, trend_score * 0.10::DOUBLE, effort_score * 0.10::DOUBLE, similarity * 0.25::DOUBLE]) AS p,
      generate_subscripts([1, 2, 3, 4, 5, 6], 1) AS i,
      unnest([CASE WHEN similarity >= 0.85 THEN {_PERCENT} END, CASE WHEN engagement_score >= 0.75 THEN 'high community engagement' END, {_AGE.format(t='0.75')},
        CASE WHEN trend_score >= 0.70 THEN 'strong recent activity trend' END,
        CASE WHEN effort_score >= 0.75 THEN 'low effort to engage' WHEN effort_score >= 0.6 THEN 'moderate effort to engage' END, {_INTEREST}]) AS t FROM simple) WHERE t IS NOT NULL
  UNION ALL
  SELECT user_id, opportunity_id, 1, p, i, t FROM (
    SELECT *, unnest([similarity * 0.45::DOUBLE, engagement_score * 0.20::DOUBLE, freshness_score * 0.15::DOUBLE, trend_score * 0.10::DOUBLE, effort_score * 0.10::DOUBLE, similarity * 0.2::DOUBLE]) AS p,
      generate_subscripts([1, 2, 3, 4, 5, 6], 1) AS i,
      unnest([{_PERCENT}, 'high community engagement', coalesce({_AGE.format(t='1.0')}, 'recent opportunity'), 'strong recent activity trend',
        CASE WHEN effort_score >= 1.0 THEN 'low effort to engage' WHEN effort_score >= 0.6 THEN 'moderate effort to engage' ELSE 'higher effort to engage' END, {_INTEREST}]) AS t FROM simple) WHERE t IS NOT NULL),
once AS (SELECT * FROM reasons QUALIFY row_number() OVER (PARTITION BY user_id, opportunity_id, t ORDER BY fill, p DESC, i) = 1),
why AS (
  SELECT user_id, opportunity_id, string_agg(t, ' | ' ORDER BY fill, p DESC, i) AS why FROM (
    SELECT * FROM once QUALIFY row_number() OVER (PARTITION BY user_id, opportunity_id ORDER BY fill, p DESC, i) <= 3) GROUP BY ALL)"""


def recommended(spark, sf, top_n=25):
    return R.recommend(candidates(spark, sf), A.REFERENCE_TS, "simple", top_n=top_n)


@query("rank_and_rerank", f"""WITH {WHY} SELECT user_id, opportunity_id, source, title, url, retrieval_rank, round(similarity, 6) AS similarity,
  round(final_score, 6) AS final_score, round(reranked_score, 6) AS reranked_score, rank, why FROM simple JOIN why USING (user_id, opportunity_id) WHERE rank <= 25""")
def rank_and_rerank(spark, sf):
    return recommended(spark, sf).select(
        *KEYS, "source", "title", "url", "retrieval_rank", r6("similarity"), r6("final_score"), r6("reranked_score"), "rank", listed("why", "why")
    )


@query("explain_reasons", f"WITH {WHY} SELECT user_id, opportunity_id, why FROM why")
def explain_reasons(spark, sf):
    return recommended(spark, sf, None).select(*KEYS, listed("why", "why"))


@query("recommendation_cards", f"""WITH {WHY} SELECT user_id, rank, title, CAST(score AS DOUBLE) AS score, why, url, source, {O.DOMAIN_LABEL} AS domain
FROM simple JOIN why USING (user_id, opportunity_id) WHERE rank <= 25""")
def recommendation_cards(spark, sf):
    return explain.cards(recommended(spark, sf)).withColumn("why", listed("why", "why"))


@query("similarity_cards", f"""WITH {O.SIMPLE} SELECT user_id, opportunity_id, array_to_string([x FOR x IN [
  CASE WHEN similarity >= 0.85 THEN 'high semantic similarity to your profile (' || printf('%.2f', similarity) || ')' WHEN similarity >= 0.70 THEN 'strong semantic match to your interests (' || printf('%.2f', similarity) || ')'
    ELSE 'semantic relevance score: ' || printf('%.2f', similarity) END,
  CASE WHEN engagement_raw + 2.0 * comments_raw >= 50 THEN 'high community engagement (comments + upvotes)' END,
  CASE WHEN freshness_score >= 0.05 THEN 'recent enough to engage meaningfully' END,
  CASE WHEN {O.TOPIC_LABEL} <> 'General Tech' THEN 'domain: ' || {O.TOPIC_LABEL} END] IF x IS NOT NULL][1:3], ' | ') AS why FROM simple WHERE rank <= 25""")
def similarity_cards(spark, sf):
    rows = ranking.rerank(scored(spark, sf), "simple", top_n=25)
    rows = rows.withColumn("engagement_score", F.col("engagement_raw") + 2.0 * F.col("comments_raw"))
    return rows.select(*KEYS, listed(explain.similarity_reasons(rows), "why"))


_TOPIC_ROWS = O.SIMPLE + f", board AS (SELECT *, {O.TOPIC_LABEL} AS recommended_topic, {O.PAGE_LABEL} AS recommended_page FROM simple WHERE rank <= 25)"


def board(spark, sf):
    rows = ranking.rerank(scored(spark, sf), "simple", top_n=25)
    return rows.withColumns({"recommended_topic": topic_label(rows), "recommended_page": page_label("source")})


@query("topic_summary", f"""WITH {_TOPIC_ROWS} SELECT recommended_topic, count(*) AS recommendations, round(avg(reranked_score), 6) AS avg_score,
  (list(title ORDER BY rank, user_id, id))[1] AS best_page FROM board GROUP BY 1""")
def topic_summary(spark, sf):
    return analytics.topic_summary(board(spark, sf)).withColumn("avg_score", r6("avg_score"))


@query("headline_metrics", f"WITH {_TOPIC_ROWS} SELECT (SELECT count(*) FROM snap) AS opportunities, count(*) AS recommendations, count(DISTINCT recommended_topic) AS topics FROM board")
def headline_metrics(spark, sf):
    return analytics.headline(kept(spark, sf), board(spark, sf))


@query("weekly_brief", f"WITH {_TOPIC_ROWS} SELECT user_id, rank, title, recommended_page, recommended_topic, round(reranked_score, 6) AS reranked_score, url FROM board")
def weekly_brief(spark, sf):
    return explain.brief(board(spark, sf)).withColumn("reranked_score", r6("reranked_score"))


def skips(shown):
    """Feedback on the ranked rows themselves: the action of each row's source."""
    action = F.when(F.col("source").isin("github", "newsletter"), "skip").otherwise("engage")
    return shown.select("user_id", "id", "domain", action.alias("action"))


@query("skip_penalty", f"""WITH {_TOPIC_ROWS}, fb AS (SELECT user_id, id, domain, CASE WHEN source IN ('github', 'newsletter') THEN 'skip' ELSE 'engage' END AS action FROM board),
skipped AS (SELECT DISTINCT user_id, id FROM fb WHERE action = 'skip'),
doms AS (SELECT user_id, lower(domain) AS d, count(*) AS n FROM fb WHERE action = 'skip' GROUP BY ALL),
low AS (SELECT b.user_id, b.id, b.rank AS before, b.reranked_score - (CASE WHEN s.id IS NOT NULL THEN 0.30::DOUBLE ELSE 0.0::DOUBLE END + least(coalesce(n, 0) * 0.05::DOUBLE, 0.20::DOUBLE)) AS s
  FROM board b LEFT JOIN skipped s ON s.user_id = b.user_id AND s.id = b.id LEFT JOIN doms ON doms.user_id = b.user_id AND d = lower(b.domain))
SELECT user_id, id, round(s, 6) AS reranked_score, row_number() OVER (PARTITION BY user_id ORDER BY s DESC, before) AS rank FROM low""")
def skip_penalty(spark, sf):
    shown = materialise(board(spark, sf), "board")
    rows = ranking.skip_penalty(shown, skips(shown))
    return rows.select("user_id", "id", r6("reranked_score"), "rank")
