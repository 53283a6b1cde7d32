"""op6: documents against the benchmark."""
from __future__ import annotations

from pyspark.sql import functions as F

from pulserank.llm.common import materialise, read
from pulserank.llm.positional_index import build_index, find_phrases, hit_words, item_names, test_terms


def marked(docs, items):
    """Documents with their shared passages, through a stored index."""
    index = materialise(build_index(docs, terms=test_terms(items)), "positional-index")
    return find_phrases(index, items)


def op6_decontaminate(spark, sf_dir):
    rows = marked(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    names = item_names(F.col("spans"))
    return rows.select(
        "doc_id", "n_words", hit_words(F.col("spans")).alias("n_hit"), F.size(names).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


SQL = r"""WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[o:o + least(10, len(w)) - 1], ' ') AS k
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS o FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
dwin AS (SELECT doc_id, o, n, array_to_string(w[o:o + n - 1], ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS o FROM dw, sizes WHERE len(w) >= n)),
hit AS (SELECT d.doc_id, d.o, d.n, i.item_id FROM dwin d JOIN win i ON d.k = i.k AND d.n = i.n),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(o, o + n)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS names FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
  sha256(coalesce(i.names, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM dw d LEFT JOIN cov c USING (doc_id) LEFT JOIN its i USING (doc_id)"""
