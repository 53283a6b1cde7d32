"""Queries over labels and ranking quality."""
from __future__ import annotations

from pyspark.sql import functions as F

from pulserank.functions import constants as K
from pulserank.operators import evaluation as E
from pulserank.operators.analytics import pivot_counts
from pulserank.operators.quality import label_rules, report
from pulserank.operators.ranking import proxy_relevance, rerank
from pulserank.plans import adapters as A, oracle_parts as O, recommend as R
from pulserank.plans.catalog import query, r6
from pulserank.plans.queries_ranking import scored
from pulserank.plans.queries_retrieval import candidates
from pulserank.plans.queries_text import PREFERENCES_SQL
from pulserank.session import materialise

_INTERACTION = """CASE WHEN quality = 1 AND toxic = 0 THEN 'engaged' WHEN quality = 1 THEN 'bookmarked' WHEN toxic = 0 THEN 'clicked' ELSE 'skipped' END"""
_GRADE = O.case("interaction", {k: str(v) for k, v in K.RELEVANCE.items()}, "NULL")
_GIVEN = f"""
given AS (
  SELECT user_id, opportunity_id, interaction, CAST({_GRADE} AS INT) AS relevance_label FROM (
    SELECT 'user-' || v.label AS user_id, coalesce({O._SOURCE}, 'doc') || '::' || l.doc_id AS opportunity_id, {_INTERACTION} AS interaction
    FROM labels l JOIN embeddings v ON v.vec_id = l.doc_id % (SELECT count(*) FROM embeddings) LEFT JOIN events e ON e.event_id = l.doc_id))"""


def labelled(spark, sf):
    return E.labels(A.user_labels(spark, sf))


@query("interaction_labels", f"WITH {O.ITEMS}, {_GIVEN} SELECT * FROM given")
def interaction_labels(spark, sf):
    return labelled(spark, sf)


@query("labels_from_grades", f"""WITH {O.ITEMS}, {_GIVEN}
SELECT user_id, opportunity_id, interaction, max(relevance_label) AS relevance_label FROM given GROUP BY ALL""")
def labels_from_grades(spark, sf):
    graded = labelled(spark, sf).select(
        F.concat(F.lit(" "), "user_id").alias("user_id"), F.concat("opportunity_id", F.lit("\t")).alias("opportunity_id"),
        F.col("relevance_label").cast("string").alias("relevance_label"),
    )
    return E.labels(graded.unionByName(graded))


@query("label_checks", f"""WITH {O.ITEMS}, {_GIVEN} SELECT 'missing_user' AS rule, count(*) FILTER (user_id = '') AS violations FROM given UNION ALL
SELECT 'missing_opportunity', count(*) FILTER (opportunity_id = '') FROM given UNION ALL
SELECT 'unknown_interaction', count(*) FILTER (interaction IS NULL) FROM given UNION ALL
SELECT 'grade_out_of_range', count(*) FILTER (relevance_label NOT BETWEEN 0 AND 3) FROM given""")
def label_checks(spark, sf):
    return report(labelled(spark, sf), label_rules())


@query("label_distribution", f"""WITH {O.ITEMS}, {_GIVEN} SELECT user_id, count(*) FILTER (interaction = 'engaged') AS engaged, count(*) FILTER (interaction = 'bookmarked') AS bookmarked,
  count(*) FILTER (interaction = 'clicked') AS clicked, count(*) FILTER (interaction = 'skipped') AS skipped FROM given GROUP BY 1""")
def label_distribution(spark, sf):
    return pivot_counts(labelled(spark, sf), ["user_id"], "interaction", tuple(K.RELEVANCE))


@query("users_with_vectors", """SELECT CAST(doc_id AS VARCHAR) AS user_id, lang FROM documents WHERE doc_id IN (SELECT vec_id FROM embeddings)""")
def users_with_vectors(spark, sf):
    people = A.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("user_id"), "lang")
    vectors = A.table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("user_id"))
    return E.users_with_vectors(people, vectors)


_TOKENS = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g'))"
_ROW = "concat_ws(' ', " + ", ".join(_TOKENS.format(f"coalesce(c.{x}, '')") for x in ("topic_category", "domain_category", "domain", "title", "text")) + ")"

def _proxy_sql() -> str:
    # SNAP and PROFILES both start from the standardised rows; the second definition is left out.
    rest = O.PROFILES[len(O.STD):]
    return O.CAND + rest + "," + PREFERENCES_SQL + f""",
ulist AS (SELECT user_id, list(term) AS terms FROM uterms GROUP BY user_id),
strengths AS (
  SELECT c.user_id, c.opportunity_id, 0.65::DOUBLE * (len(list_intersect(list_distinct(string_split({_ROW}, ' ')), u.terms)) / len(u.terms)) + 0.35::DOUBLE * c.similarity AS signal
  FROM cand c JOIN ulist u USING (user_id)),
pct AS (
  SELECT *, 1.0::DOUBLE - (row_number() OVER (PARTITION BY user_id ORDER BY signal DESC, opportunity_id) - 1) / greatest(count(*) OVER (PARTITION BY user_id) - 1, 1) AS percentile FROM strengths),
given AS (
  SELECT user_id, opportunity_id, interaction, CAST({_GRADE} AS INT) AS relevance_label FROM (
    SELECT *, CASE WHEN percentile >= 0.90 THEN 'engaged' WHEN percentile >= 0.70 THEN 'bookmarked' WHEN percentile >= 0.40 THEN 'clicked' ELSE 'skipped' END AS interaction FROM pct))"""


PROXY = _proxy_sql()


@query("proxy_labels", f"WITH {PROXY} SELECT user_id, opportunity_id, interaction, relevance_label FROM given")
def proxy_labels(spark, sf):
    return E.proxy_labels(candidates(spark, sf), A.profiles(spark, sf, history=False), A.PREFERENCES)


_JUDGED = O.SIMPLE + "," + _GIVEN + """,
judged AS (
  SELECT s.*, coalesce(g.relevance_label, 0) AS relevance_label, coalesce(g.interaction, 'skipped') AS interaction
  FROM simple s LEFT JOIN given g USING (user_id, opportunity_id)),
variants AS (
  SELECT *, 'similarity_only' AS variant, similarity AS predicted_score FROM judged UNION ALL
  SELECT *, 'similarity_engagement', 0.6::DOUBLE * similarity + 0.4::DOUBLE * engagement_score FROM judged UNION ALL
  SELECT *, 'full_scoring', final_score FROM judged UNION ALL
  SELECT *, 'full_with_diversity', reranked_score FROM judged)"""


def ndcg_sql(source: str, by: str, label: str, score: str, k: int, gain: str = "linear", ties: str = "average") -> str:
    g = f"CAST({label} AS DOUBLE)" if gain == "linear" else f"pow(2.0::DOUBLE, {label}) - 1.0::DOUBLE"
    won = "avg(g) OVER (PARTITION BY " + by + ", s)" if ties == "average" else "g"
    return f"""
  SELECT {by}, CASE WHEN m > 0 THEN d / m ELSE 0.0 END AS ndcg FROM (
    SELECT {by}, sum(CASE WHEN pos <= {k} THEN won / log2(pos + 1) END) AS d, sum(CASE WHEN ideal <= {k} THEN g / log2(ideal + 1) END) AS m FROM (
      SELECT *, {won} AS won, row_number() OVER (PARTITION BY {by} ORDER BY s DESC, opportunity_id) AS pos,
        row_number() OVER (PARTITION BY {by} ORDER BY g DESC, opportunity_id) AS ideal
      FROM (SELECT {by}, opportunity_id, {score} AS s, {g} AS g FROM {source}))
    GROUP BY {by})"""


@query("ndcg_at_k", f"WITH {_JUDGED}, n AS ({ndcg_sql('variants', 'variant, user_id', 'relevance_label', 'predicted_score', 10)}) SELECT variant, user_id, round(ndcg, 6) AS ndcg FROM n")
def ndcg_at_k(spark, sf):
    return E.variant_ndcg(candidates(spark, sf), labelled(spark, sf), A.REFERENCE_TS).withColumn("ndcg", r6("ndcg"))


@query("ndcg_exponential", f"WITH {_JUDGED}, n AS ({ndcg_sql('judged', 'user_id', 'relevance_label', 'reranked_score', 10, 'exp2', 'id')}) SELECT user_id, round(ndcg, 6) AS ndcg FROM n")
def ndcg_exponential(spark, sf):
    rows = E.attach_labels(rerank(scored(spark, sf), "simple"), labelled(spark, sf))
    return E.ndcg(rows, "relevance_label", "reranked_score", gain="exp2", ties="id").withColumn("ndcg", r6("ndcg"))


@query("variant_comparison", f"""WITH {_JUDGED}, n AS ({ndcg_sql('variants', 'variant, user_id', 'relevance_label', 'predicted_score', 10)}),
means AS (SELECT variant, avg(ndcg) AS ndcg, count(*) AS users FROM n GROUP BY 1)
SELECT variant, {O.case('variant', K.VARIANT_NAMES, 'NULL')} AS display_name, round(ndcg, 6) AS ndcg, users,
  round(ndcg - (SELECT ndcg FROM means WHERE variant = 'similarity_only'), 6) AS gain_over_baseline FROM means""")
def variant_comparison(spark, sf):
    out = E.compare(candidates(spark, sf), labelled(spark, sf), A.REFERENCE_TS)
    return out.select("variant", "display_name", r6("ndcg"), "users", r6("gain_over_baseline"))


@query("evaluation_export", f"WITH {_JUDGED} SELECT user_id, opportunity_id, round(predicted_score, 6) AS predicted_score, CAST(relevance_label AS INT) AS relevance_label, interaction, title FROM variants WHERE variant = 'full_with_diversity'")
def evaluation_export(spark, sf):
    out = E.export(candidates(spark, sf), labelled(spark, sf), A.REFERENCE_TS)
    return out.withColumn("predicted_score", r6("predicted_score"))


_REL = f"0.5::DOUBLE * similarity + 0.3::DOUBLE * ({O.scaled('engagement_raw')}) + 0.2::DOUBLE * ({O.scaled('comments_raw')})"


@query("proxy_relevance", f"WITH {O.SCORED} SELECT user_id, opportunity_id, round({_REL}, 6) AS relevance FROM scored")
def relevance(spark, sf):
    rows = scored(spark, sf)
    return rows.select("user_id", "opportunity_id", r6(proxy_relevance(rows), "relevance"))


@query("list_quality", f"""WITH {O.SIMPLE}, top AS (SELECT *, {_REL} AS rel FROM simple WHERE rank <= 25), pool AS (SELECT *, {_REL} AS rel FROM scored),
a AS ({ndcg_sql('top', 'user_id', 'rel', 'reranked_score', 10)}), b AS ({ndcg_sql('pool', 'user_id', 'rel', 'final_score', 10)})
SELECT a.user_id, round(a.ndcg, 6) AS ndcg_at_k, round(b.ndcg, 6) AS ndcg_at_k_before FROM a JOIN b USING (user_id)""")
def list_quality(spark, sf):
    out = R.list_quality(materialise(candidates(spark, sf), "candidates"), A.REFERENCE_TS, method="simple", top_n=25)
    return out.select("user_id", r6("ndcg_at_k"), r6("ndcg_at_k_before"))
