"""op12: phrase collocations of each language."""
from __future__ import annotations

from pulserank.llm.collocations import LOWER, UPPER, collocations
from pulserank.llm.common import read


def op12_collocations(spark, sf_dir):
    return collocations(read(spark, sf_dir, "documents"))


SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\n-\r]')) AS piece FROM documents),
lists AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), w -> w <> '') AS w FROM pieces),
grams AS (
  SELECT lang, m AS size, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM (SELECT lang, w, unnest(range(1, 6)) AS m FROM lists) WHERE len(w) >= m)),
counted AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM counted WHERE size = 1 GROUP BY lang),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM counted WHERE size > 1 AND f >= 100),
cuts AS (
  SELECT lang, phrase, f, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)),
scored AS (
  SELECT c.lang, c.phrase, c.f AS a, c.k, h.f AS l, t.f AS r, n, ((1000::HUGEINT * c.f * n) // (h.f::HUGEINT * t.f))::BIGINT AS score
  FROM cuts c JOIN counted h ON h.lang = c.lang AND h.phrase = c.head JOIN counted t ON t.lang = c.lang AND t.phrase = c.tail JOIN totals USING (lang)),
worst AS (FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
subs AS (
  SELECT lang, f, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, size - m + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS m FROM candidates WHERE size > 2))),
longer AS (SELECT lang, phrase, max(f) AS f FROM subs GROUP BY ALL),
ranked AS (
  SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank, s.phrase, a, l, r, n::BIGINT AS n, score
  FROM worst s LEFT JOIN longer g ON g.lang = s.lang AND g.phrase = s.phrase WHERE g.f IS NULL OR 100 * g.f < 100 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
