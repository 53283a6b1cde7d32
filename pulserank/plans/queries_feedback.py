"""Queries over feedback and adapted user vectors."""
from __future__ import annotations

from pyspark.sql import functions as F

from pulserank.functions import constants as K
from pulserank.functions.vectors import dot
from pulserank.operators import evaluation as E, feedback as B
from pulserank.operators.neighbors import knn
from pulserank.operators.ranking import rerank
from pulserank.plans import adapters as A, oracle_parts as O
from pulserank.plans.catalog import query, r6
from pulserank.plans.queries_ranking import scored

_ACTIONS = ", ".join(f"count(*) FILTER (action = '{a}') AS {a}" for a in K.FEEDBACK_WEIGHTS)


@query("feedback_counts", f"WITH {O.FEEDBACK} SELECT user_id, {_ACTIONS} FROM feedback WHERE action IS NOT NULL GROUP BY 1")
def feedback_counts(spark, sf):
    return B.action_counts(A.feedback(spark, sf).where(F.col("action").isNotNull()))


def _unit(v: str) -> str:
    return f"[x / sqrt(list_inner_product({v}, {v})) FOR x IN {v}]"


_OWN = "CASE action WHEN 'engage' THEN 0.90::DOUBLE WHEN 'bookmark' THEN 0.93::DOUBLE ELSE 0.95::DOUBLE END"
_OTHER = "CASE action WHEN 'engage' THEN 0.10::DOUBLE WHEN 'bookmark' THEN 0.07::DOUBLE ELSE (-0.05)::DOUBLE END"
FOLD = O.FEEDBACK + f""",
vecs AS (SELECT vec_id, {_unit('e')} AS e FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)),
steps AS (
  SELECT f.user_id, row_number() OVER (PARTITION BY f.user_id ORDER BY ts, event_id) AS step, {_OWN} AS own, {_OTHER} AS other, v.e AS item
  FROM feedback f JOIN vecs v ON f.opportunity_id = CAST(v.vec_id AS VARCHAR) WHERE action IS NOT NULL),
starts AS (
  SELECT CAST(u.user_id AS VARCHAR) AS user_id, v.e FROM (SELECT DISTINCT user_id FROM events) u
  JOIN vecs v ON v.vec_id = u.user_id % (SELECT count(*) FROM embeddings)),
folded AS (
  WITH RECURSIVE walk AS (
    SELECT user_id, 0::BIGINT AS step, e FROM starts
    UNION ALL
    SELECT user_id, step, [x / sqrt(list_inner_product(m, m)) FOR x IN m] FROM (
      SELECT w.user_id, s.step, [s.own * p[1] + s.other * p[2] FOR p IN list_zip(w.e, s.item)] AS m
      FROM walk w JOIN steps s ON s.user_id = w.user_id AND s.step = w.step + 1))
  SELECT user_id, step AS events, e FROM walk QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY step DESC) = 1)"""
_FOLDED = f"WITH {FOLD} SELECT user_id, events, round(e[1], 6) AS first, round(list_sum(e), 6) AS total, round(list_inner_product(e, e), 6) AS square FROM folded"


def vector_view(df):
    total = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x)
    return df.select(
        "user_id", "events", r6(F.col("embedding")[0], "first"), r6(total, "total"), r6(dot("embedding", "embedding"), "square")
    )


@query("feedback_vectors", _FOLDED)
def feedback_vectors(spark, sf):
    return vector_view(B.fold(A.feedback_users(spark, sf), A.feedback(spark, sf), A.feedback_items(spark, sf)))


_TOP125 = O.ITEMS + "," + O.USERS + "," + O.PAIRS + "," + O.knn(125, "near", "dot DESC, opportunity_id")
PREFERENCE = _TOP125 + f""",
chosen AS (
  SELECT user_id, opportunity_id FROM near WHERE retrieval_rank > 25
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY md5('42:' || user_id || ':' || opportunity_id), opportunity_id) <= 25),
chosen_rows AS (SELECT c.user_id, i.embedding FROM chosen c JOIN items i USING (opportunity_id)),{O.centroids('chosen_rows', 'user_id', 'middles')},
mixed AS (
  SELECT u.user_id, [0.25::DOUBLE * p[1] + 0.75::DOUBLE * p[2] FOR p IN list_zip(u.embedding, {_unit('m.embedding')})] AS v
  FROM users u JOIN middles m USING (user_id)),
prefs AS (SELECT user_id, {_unit('v')} AS embedding FROM mixed)"""


def preferences(spark, sf):
    return B.preference(A.users(spark, sf), A.items(spark, sf))


@query("preference_vectors", f"WITH {PREFERENCE} SELECT user_id, round(embedding[1], 6) AS first, round(list_sum(embedding), 6) AS total, round(list_inner_product(embedding, embedding), 6) AS square FROM prefs")
def preference_vectors(spark, sf):
    return vector_view(preferences(spark, sf).withColumn("events", F.lit(0))).drop("events")


_SIMS = """
sims AS (SELECT p.user_id, i.opportunity_id, list_inner_product(p.embedding, i.embedding) AS s FROM prefs p, items i),
cuts AS (SELECT user_id, quantile_cont(s, 0.95) AS c3, quantile_cont(s, 0.85) AS c2, quantile_cont(s, 0.70) AS c1 FROM sims GROUP BY 1)"""


def _cutoffs(spark, sf, **options):
    return B.similarity_cutoffs(preferences(spark, sf), A.items(spark, sf), **options)


@query("similarity_cutoffs", f"WITH {PREFERENCE}, {_SIMS} SELECT user_id, round(c3, 6) AS c3, round(c2, 6) AS c2, round(c1, 6) AS c1 FROM cuts")
def similarity_cutoffs(spark, sf):
    cut = F.col("cutoffs")
    return _cutoffs(spark, sf).select("user_id", r6(cut[0], "c3"), r6(cut[1], "c2"), r6(cut[2], "c1"))


GRADED = PREFERENCE + "," + _SIMS + f""",
best AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY s DESC, opportunity_id) AS retrieval_rank FROM sims
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY s DESC, opportunity_id) <= 100),
graded AS (SELECT b.user_id, opportunity_id, CASE WHEN s >= c3 THEN 3 WHEN s >= c2 THEN 2 WHEN s >= c1 THEN 1 ELSE 0 END AS simulated_relevance
  FROM best b JOIN cuts USING (user_id))"""


def graded(spark, sf):
    """Grades of the items nearest to each preference vector; its cutoffs look at all items."""
    wanted = preferences(spark, sf)
    near = knn(wanted, A.items(spark, sf), 100, metric="dot")
    return near.join(_cutoffs(spark, sf), "user_id").select(
        "user_id", "opportunity_id", B.grade("score").alias("simulated_relevance")
    )


@query("preference_grades", f"WITH {GRADED} SELECT user_id, opportunity_id, simulated_relevance FROM graded")
def preference_grades(spark, sf):
    return graded(spark, sf)


_SEEN = O.SIMPLE + """,
seen AS (SELECT user_id, opportunity_id, count(*) AS n FROM simple WHERE source = 'hackernews' GROUP BY ALL),
grades AS (SELECT user_id, opportunity_id, CAST(score % 4 AS INT) AS simulated_relevance FROM simple WHERE score > num_comments),
recs AS (SELECT s.*, coalesce(g.simulated_relevance, 0) AS simulated_relevance, coalesce(n, 0) AS seen
  FROM simple s LEFT JOIN grades g USING (user_id, opportunity_id) LEFT JOIN seen USING (user_id, opportunity_id))"""


def _recommended(spark, sf):
    ranked = rerank(scored(spark, sf), "simple")
    grades = ranked.where(F.col("score") > F.col("num_comments")).select(
        "user_id", "opportunity_id", (F.col("score") % 4).cast("int").alias("simulated_relevance")
    )
    return B.attach_grades(ranked, grades)


@query("attach_grades", f"WITH {_SEEN} SELECT user_id, opportunity_id, simulated_relevance FROM recs")
def attach_grades(spark, sf):
    return _recommended(spark, sf).select("user_id", "opportunity_id", "simulated_relevance")


@query("next_item", f"""WITH {_SEEN} SELECT user_id, opportunity_id, simulated_relevance, seen, rank FROM recs
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY simulated_relevance DESC, seen, rank, opportunity_id) = 1""")
def next_item(spark, sf):
    rows = _recommended(spark, sf)
    seen = rows.where(F.col("source") == "hackernews").select("user_id", "opportunity_id")
    return B.next_item(rows, seen).select("user_id", "opportunity_id", "simulated_relevance", "seen", "rank")


@query("simulated_ndcg", f"""WITH {_SEEN}, n AS (SELECT user_id, CASE WHEN m > 0 THEN d / m ELSE 0.0 END AS ndcg FROM (
  SELECT user_id, sum(CASE WHEN pos <= 10 THEN g / log2(pos + 1) END) AS d, sum(CASE WHEN ideal <= 10 THEN g / log2(ideal + 1) END) AS m FROM (
    SELECT user_id, g, row_number() OVER (PARTITION BY user_id ORDER BY reranked_score DESC, opportunity_id) AS pos, row_number() OVER (PARTITION BY user_id ORDER BY g DESC, opportunity_id) AS ideal
    FROM (SELECT *, pow(2.0::DOUBLE, simulated_relevance) - 1.0::DOUBLE AS g FROM recs)) GROUP BY 1)) SELECT user_id, round(ndcg, 6) AS ndcg FROM n""")
def simulated_ndcg(spark, sf):
    return E.ndcg(_recommended(spark, sf), "simulated_relevance", "reranked_score", gain="exp2", ties="id").withColumn("ndcg", r6("ndcg"))
