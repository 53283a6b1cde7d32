"""Queries over terms: trending topics, profiles, keyword ranking."""
from __future__ import annotations

from pyspark.sql import functions as F

from pulserank.functions import constants as K
from pulserank.operators import keyword, profiles as P
from pulserank.operators.analytics import trend_categories
from pulserank.operators.shaping import analytics_view, good_first_issues, snapshot_features
from pulserank.operators.trending import trending, trends_board
from pulserank.plans import adapters as A, oracle_parts as O
from pulserank.plans.catalog import listed, query, r6
from pulserank.session import materialise

_STOP = O.in_list(K.ANALYTICS_STOP_WORDS)


def _terms(token: str, where: str = "true") -> str:
    return f"""
titles AS (SELECT id, title FROM opp WHERE {where}),
toks AS (SELECT id, [t FOR t IN regexp_extract_all(lower(title), {O.quoted(token)}) IF t NOT IN {_STOP}] AS t FROM titles),
terms AS (
  SELECT id, unnest(t) AS topic FROM toks UNION ALL
  SELECT id, unnest([t[i] || ' ' || t[i + 1] FOR i IN range(1, len(t))]) FROM toks),
tf AS (SELECT id, topic, count(*) AS tf FROM terms GROUP BY ALL),
totals AS (SELECT topic, sum(tf) AS tf, count(*) AS df FROM tf GROUP BY 1),
n AS (SELECT count(*) AS n FROM titles)"""


_TFIDF = O.OPP + "," + _terms("[\\p{L}\\p{N}_]{2,}") + """,
top AS (SELECT topic, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM totals, n ORDER BY tf DESC, topic LIMIT 30),
weights AS (SELECT id, topic, tf.tf * idf AS w FROM tf JOIN top USING (topic)),
trend AS (SELECT topic, sum(w / l) AS score FROM weights JOIN (SELECT id, sqrt(sum(w * w)) AS l FROM weights GROUP BY id) USING (id) GROUP BY topic)"""


def _view(spark, sf):
    return analytics_view(A.opportunities(spark, sf).select("id", "title"))


@query("trending_tfidf", f"WITH {_TFIDF} SELECT topic, round(score, 6) AS score FROM trend")
def trending_tfidf(spark, sf):
    return trending(_view(spark, sf), 30).select("topic", r6("score"))


@query("trending_fallback", f"""WITH {O.OPP}, {_terms('[a-zA-Z][a-zA-Z0-9_+#.-]{1,}', "trim(title) <> ''")}
SELECT topic, round(score, 6) AS score FROM (
  SELECT topic, tf * (ln((1.0 + n) / (1.0 + df)) + 1.0) AS score FROM totals, n ORDER BY score DESC, topic LIMIT 30)""")
def trending_fallback(spark, sf):
    return trending(_view(spark, sf), 30, norm=None).select("topic", r6("score"))


_BOARD = _TFIDF + f""", board AS (SELECT topic, CAST(round(score) AS BIGINT) AS count,
  CASE WHEN cat = 'unknown' THEN 'General Tech' ELSE cat END AS category FROM (SELECT *, {O.topic_category('topic', "''")} AS cat FROM trend))"""


@query("trends_board", f"WITH {_BOARD} SELECT * FROM board")
def board(spark, sf):
    return trends_board(trending(_view(spark, sf), 30), A.TOPICS)


@query("trend_categories", f"WITH {_BOARD} SELECT category, CAST(sum(count) AS BIGINT) AS count FROM board GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 12")
def categories(spark, sf):
    return trend_categories(trends_board(trending(_view(spark, sf), 30), A.TOPICS))


@query("profile_terms", f"""WITH {O.PROFILES},
parts AS (
  SELECT user_id, 1 AS part, generate_subscripts(interests, 1) AS i, 0 AS j, unnest(interests) AS term FROM profiles UNION ALL
  SELECT user_id, 2, generate_subscripts(expertise, 1), 0, unnest(expertise) FROM profiles UNION ALL
  SELECT user_id, 3, generate_subscripts(preferred_domains, 1), 0, unnest(preferred_domains) FROM profiles UNION ALL
  SELECT user_id, 4, rn, 1, title FROM prof_history UNION ALL
  SELECT user_id, 4, rn, 2, domain FROM prof_history UNION ALL
  SELECT user_id, 4, rn, 3, source FROM prof_history),
firsts AS (
  SELECT user_id, part, i, j, {O.strip('term')} AS term FROM parts WHERE {O.clean('term')} <> ''
  QUALIFY row_number() OVER (PARTITION BY user_id, lower({O.strip('term')}) ORDER BY part, i, j) = 1)
SELECT user_id, string_agg(term, ' | ' ORDER BY part, i, j) AS terms, string_agg(term, ' ' ORDER BY part, i, j) AS profile_text,
  count(*) AS n FROM firsts GROUP BY user_id""")
def profile_terms(spark, sf):
    return P.profile_terms(A.profiles(spark, sf)).select(
        "user_id", listed("terms", "terms"), "profile_text", F.size("terms").cast("bigint").alias("n")
    )


def _preferences() -> str:
    extra = " UNION ALL ".join(
        f"SELECT {O.quoted(k)} AS k, {O.quoted(v)} AS v" for k, names in A.PREFERENCES.items() for v in names
    )
    return f"""
alias_rows AS ({extra}),
pref AS (
  SELECT user_id, trim(regexp_replace(lower(d), '[^a-z0-9]+', ' ', 'g')) AS term, replace(trim(regexp_replace(lower(d), '[^a-z0-9]+', ' ', 'g')), ' ', '_') AS k, true AS dom
  FROM (SELECT user_id, unnest(preferred_domains) AS d FROM profiles) UNION ALL
  SELECT user_id, trim(regexp_replace(lower(d), '[^a-z0-9]+', ' ', 'g')), NULL, false FROM (SELECT user_id, unnest(interests) AS d FROM profiles)),
uterms AS (
  SELECT DISTINCT user_id, term FROM (
    SELECT user_id, k AS term FROM pref WHERE dom UNION ALL SELECT user_id, v FROM pref JOIN alias_rows USING (k) WHERE dom UNION ALL
    SELECT user_id, term FROM pref WHERE NOT dom) WHERE term <> '')"""


PREFERENCES_SQL = _preferences()


@query("preference_terms", f"""WITH {O.PROFILES}, {PREFERENCES_SQL}
SELECT user_id, string_agg(term, ' | ' ORDER BY term) AS terms FROM uterms GROUP BY user_id""")
def preference_terms(spark, sf):
    users = A.profiles(spark, sf, history=False)
    return users.select(
        "user_id", listed(F.array_sort(P.preference_terms("preferred_domains", "interests", A.PREFERENCES)), "terms")
    )


_WORDS = "[a-z0-9+#.-]+"


def _tokens(c: str) -> str:
    return f"list_distinct([w FOR w IN regexp_extract_all(lower({c}), '{_WORDS}') IF length(w) > 2 AND w NOT IN {O.in_list(K.RANKER_STOP_WORDS)}])"


KEYWORD = O.PROFILES + f""",
kuser AS (
  SELECT user_id, list_concat(list_concat(interests, expertise), preferred_domains) AS terms FROM profiles),
kuser2 AS (SELECT *, {_tokens("array_to_string(terms, ' ')")} AS tokens FROM kuser),
krow AS (
  SELECT id, t, {_tokens('t')} AS tokens, quality_score, freshness_score, effort_score_normalized FROM (
    SELECT id, lower(concat_ws(' ', title, text, domain, domain_category, topic_category)) AS t,
      CASE WHEN max(e) OVER () = min(e) OVER () THEN 0.0 ELSE (e - min(e) OVER ()) / (max(e) OVER () - min(e) OVER ()) END AS quality_score,
      1.0 / (1.0 + a) AS freshness_score,
      1.0 - CASE WHEN max(w) OVER () = min(w) OVER () THEN 0.0 ELSE (w - min(w) OVER ()) / (max(w) OVER () - min(w) OVER ()) END AS effort_score_normalized
    FROM (SELECT *, CAST(score AS DOUBLE) + 2.0 * num_comments AS e, {O.days('created_utc')} AS a, CAST({O.words('text')} AS DOUBLE) AS w FROM classed))),
kmatch AS (
  SELECT u.user_id, r.id, least(1.0, 0.7::DOUBLE * (len([x FOR x IN u.terms IF contains(r.t, lower(x))]) / greatest(len(u.terms), 1))
    + 0.3::DOUBLE * (len(list_intersect(r.tokens, u.tokens)) / greatest(len(u.tokens), 1))) AS m, r.*, u.terms
  FROM kuser2 u, krow r),
kscore AS (
  SELECT *, 0.55::DOUBLE * m + 0.25::DOUBLE * quality_score + 0.10::DOUBLE * freshness_score + 0.10::DOUBLE * effort_score_normalized AS s FROM kmatch),
kbest AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY s DESC, id) AS rank FROM kscore
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY s DESC, id) <= 20)"""


def _rows(spark, sf):
    """Rows and profiles are stored tables, as they are outside this catalog. The rows of a document stand together, so its text packs well."""
    return materialise(snapshot_features(A.classified(spark, sf), A.REFERENCE_TS), "rows", compression="zstd")


def _users(spark, sf):
    return materialise(A.terms(A.profiles(spark, sf, history=False)), "profiles")


@query("keyword_match", f"""WITH {KEYWORD} SELECT user_id, id, round(m, 6) AS profile_match_score FROM kmatch WHERE m > 0
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY m DESC, id) <= 50""")
def keyword_match(spark, sf):
    found = keyword.keyword_match(_rows(spark, sf), _users(spark, sf), 50)
    return found.select("user_id", "id", r6("profile_match_score"))


@query("keyword_ranker", f"""WITH {KEYWORD}, reasons AS (
  SELECT *, list_concat(['profile match: ' || x FOR x IN [x FOR x IN terms IF contains(t, lower(x))][1:3]],
    [y FOR y IN [CASE WHEN quality_score >= 0.7 THEN 'strong community activity' END, CASE WHEN freshness_score >= 0.05 THEN 'recent enough to engage' END] IF y IS NOT NULL]) AS w FROM kbest)
SELECT r.user_id, r.id, r.rank, round(r.m, 6) AS profile_match_score, round(r.s, 6) AS recommendation_score,
  CASE WHEN len(r.w) = 0 THEN 'closest available match in ' || {O.TOPIC_LABEL} ELSE array_to_string(r.w[1:3], ' | ') END AS why
FROM reasons r JOIN classed c ON c.id = r.id""")
def keyword_ranker(spark, sf):
    users = _users(spark, sf)
    best = keyword.keyword_rank(_rows(spark, sf), users, 20).join(users, "user_id")
    return best.select(
        "user_id", "id", F.col("rank").cast("bigint").alias("rank"), r6("profile_match_score"), r6("recommendation_score"),
        listed(keyword.keyword_reasons(best), "why"),
    )


@query("good_first_issue", f"""WITH {O.CLASSED}, marked AS (
  SELECT *, source = 'github' AS own, source = 'github' OR ({' OR '.join(O._any(f"lower(coalesce({c}, ''))", K.FIRST_ISSUE_PHRASES) for c in ('title', 'text', 'topic_category', 'domain_category', 'domain'))}) AS wanted FROM classed)
SELECT id, source FROM marked WHERE wanted""")
def good_first_issue(spark, sf):
    return good_first_issues(A.classified(spark, sf)).select("id", "source")


@query("split_terms", """SELECT doc_id, array_to_string([x FOR x IN [trim(y, ' ' || chr(9) || chr(10)) FOR y IN regexp_split_to_array(substr(text, 1, length(text)), '[,;' || chr(10) || ']+')] IF x <> ''], '|') AS terms FROM documents""")
def split_terms(spark, sf):
    return A.table(spark, sf, "documents").select("doc_id", F.array_join(keyword.split_terms("text"), "|").alias("terms"))
