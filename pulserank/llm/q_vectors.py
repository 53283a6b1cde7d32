"""op1: near-duplicate embeddings."""
from __future__ import annotations

from pulserank.llm.common import read
from pulserank.llm.vector_dedup import vector_groups

SQL = """WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_sum([abs(x) FOR x IN embedding]) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
u AS (SELECT vec_id, label, [x / sqrt(list_inner_product(e, e)) FOR x IN e] AS e FROM v),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_inner_product(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
comp AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM link GROUP BY a)
SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN comp c ON c.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id"""


def op1_vector_dedup(spark, sf_dir):
    return vector_groups(read(spark, sf_dir, "embeddings"))
