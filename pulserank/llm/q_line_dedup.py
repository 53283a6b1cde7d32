"""op4: repeated lines dropped, as digests."""
from __future__ import annotations

from pyspark.sql import functions as F

from pulserank.llm.common import read
from pulserank.llm.line_runs import dedup_lines

SQL = r"""WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
often AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
kept AS (SELECT l.doc_id, l.line, l.pos, o.k IS NOT NULL AND o.keeper <> l.doc_id AS gone FROM keyed l LEFT JOIN often o ON l.k = o.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256 FROM kept GROUP BY doc_id"""


def op4_line_dedup(spark, sf_dir):
    rows = dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
