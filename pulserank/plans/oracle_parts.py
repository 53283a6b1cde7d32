"""Shared pieces of the SQL twins: common table expressions over the driver's tables."""
from __future__ import annotations

from pulserank.functions import constants as K
from pulserank.plans import adapters as A


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(c: str) -> str:
    return f"trim({c}, {quoted(K.WHITESPACE)})"


def clean(c: str) -> str:
    return f"coalesce({strip(c)}, '')"


def case(c: str, mapping: dict, default: str) -> str:
    whens = " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in mapping.items())
    return f"CASE {c} {whens} ELSE {default} END"


def host(url: str) -> str:
    authority = f"lower(regexp_extract({clean(url)}, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)', 1))"
    return f"nullif(regexp_replace({authority}, '^www\\.', ''), '')"


def in_list(values) -> str:
    return "(" + ", ".join(quoted(v) for v in values) + ")"


def first_label(columns, empty=K.EMPTY_LABELS, default="unknown") -> str:
    picks = [f"CASE WHEN {clean(c)} <> '' AND lower({clean(c)}) NOT IN {in_list(empty)} THEN {clean(c)} END" for c in columns]
    return f"coalesce({', '.join(picks)}, {quoted(default)})"


def domain_category(c: str, mapping=A.DOMAINS) -> str:
    exact = " ".join(f"WHEN lower({c}) = {quoted(k)} THEN {quoted(v)}" for k, v in mapping.items())
    suffix = " ".join(f"WHEN ends_with(lower({c}), {quoted(k)}) THEN {quoted(v)}" for k, v in mapping.items())
    return f"CASE WHEN coalesce({c}, '') = '' THEN 'unknown' {exact} {suffix} ELSE 'other' END"


def topic_category(title: str, text: str, vocab=A.TOPICS) -> str:
    content = f"lower(coalesce({title}, '') || ' ' || coalesce({text}, ''))"
    votes = {
        t: "(" + " + ".join(f"contains({content}, {quoted(k)})::INT" for k in words) + ")" for t, words in vocab.items()
    }
    best = f"greatest({', '.join(votes.values())})"
    whens = " ".join(f"WHEN {v} = {best} THEN {quoted(t)}" for t, v in votes.items())
    return f"CASE WHEN {best} = 0 THEN 'unknown' {whens} END"


def words(c: str) -> str:
    return f"len(regexp_extract_all({clean(c)}, {quoted('[^' + K.WHITESPACE + ']+')}))"


def r6(c: str) -> str:
    return f"round({c}, 6)"


def days(created: str, reference: str = f"TIMESTAMP '{A.REFERENCE_TS}'") -> str:
    return f"greatest(CAST(floor((epoch_us({reference}) - epoch_us({created})) / 86400000000) AS BIGINT), 0)"


_SOURCE = case("e.event_type", A.SOURCES, "e.event_type")
_TITLE = "regexp_extract(p.html, '<title>([^<]*)</title>', 1)"
_COMMENTS = """CAST(regexp_extract(e.props, '"k": (\\d+)', 1) AS BIGINT)"""

OPP = f"""
opp AS (
  SELECT CAST(e.event_id AS VARCHAR) AS id, {_SOURCE} AS source, {_TITLE} AS title, d.text AS text,
         CASE WHEN e.event_id % 4 = 0 THEN p.url ELSE p.url || '?item=' || e.event_id END AS url,
         CAST(floor(e.value) AS BIGINT) AS score, {_COMMENTS} AS num_comments, e.ts AS created_utc, d.lang AS lang,
         e.user_id AS user_id
  FROM events e JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents)
  JOIN pages p ON p.page_id = e.event_id % (SELECT count(*) FROM pages))"""

FEED = f"""
feed AS (
  SELECT e.event_id, CAST({_COMMENTS} AS VARCHAR) AS id, {_SOURCE} AS source, {_TITLE} AS title, '' AS text,
         CASE WHEN e.user_id % 4 = 0 THEN '' ELSE p.url END AS url, CAST(floor(e.value) AS BIGINT) AS score,
         {_COMMENTS} AS num_comments, e.ts AS created_utc, e.user_id, e.event_type
  FROM events e JOIN pages p ON p.page_id = e.event_id % (SELECT count(*) FROM pages))"""

STD = OPP + f""",
std AS (
  SELECT id, {clean('source')} AS source, {clean('title')} AS title, {clean('text')} AS text, {clean('url')} AS url,
         score, num_comments, created_utc, {host('url')} AS domain
  FROM opp)"""


def classed(source: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT *, {domain_category('domain')} AS domain_category, {topic_category('title', 'text')} AS topic_category
  FROM {source})"""


CLASSED = STD + "," + classed("std", "classed")


def dedup(source: str, name: str, empty_url: str = "keep") -> str:
    key = "lower(url)" if empty_url == "collapse" else "CASE WHEN url = '' THEN ' ' || source || '::' || id ELSE lower(url) END"
    return f"""
{name}_1 AS (
  SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY source || '::' || id
    ORDER BY score DESC, num_comments DESC, source, id, url, title, text, created_utc, domain) = 1),
{name} AS (
  SELECT * FROM {name}_1 QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY score DESC, num_comments DESC, source, id) = 1)"""


SNAP = STD + "," + dedup("std", "best") + "," + classed("best", "best_classed") + f""",
snap AS (
  SELECT id, source, title, text, url, score, num_comments, created_utc AS created_ts,
         strftime(created_utc, '%Y-%m-%dT%H:%M:%SZ') AS created_utc, domain, domain_category, topic_category,
         CAST(length(title) AS INT) AS title_length, CAST(coalesce({days('created_utc')}, 0) AS INT) AS age_days,
         CAST(score AS DOUBLE) + 2.0 * num_comments AS engagement_score,
         strftime(TIMESTAMP '{A.REFERENCE_TS}', '%Y-%m-%dT%H:%M:%SZ') AS snapshot_utc
  FROM best_classed)"""

ITEMS = f"""
items AS (
  SELECT coalesce(k.source || '::' || k.id, 'vec::' || v.vec_id) AS opportunity_id, v.embedding::DOUBLE[] AS embedding,
         v.label, CAST(v.vec_id AS VARCHAR) AS id
  FROM embeddings v LEFT JOIN (
    SELECT e.event_id, CAST(e.event_id AS VARCHAR) AS id, {_SOURCE} AS source FROM events e) k ON k.event_id = v.vec_id)"""


def centroids(source: str, key: str, name: str, vector: str = "embedding") -> str:
    return f"""
{name} AS (
  SELECT {key}, list(m ORDER BY i) AS embedding FROM (
    SELECT {key}, i, avg(x) AS m FROM (
      SELECT {key}, unnest({vector})::DOUBLE AS x, generate_subscripts({vector}, 1) AS i FROM {source})
    GROUP BY {key}, i)
  GROUP BY {key})"""


USERS = """
user_rows AS (SELECT 'user-' || label AS user_id, embedding FROM embeddings),""" + centroids("user_rows", "user_id", "users")

PAIRS = """
pairs AS (
  SELECT u.user_id, i.opportunity_id, list_distance(u.embedding, i.embedding) ^ 2 AS distance,
         list_inner_product(u.embedding, i.embedding) AS dot
  FROM users u, items i)"""


def knn(k: int, name: str = "knn", order: str = "distance, opportunity_id", source: str = "pairs") -> str:
    return f"""
{name} AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {order}) AS retrieval_rank
  FROM {source} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY {order}) <= {k})"""


CAND = SNAP + "," + ITEMS + "," + USERS + "," + PAIRS + "," + knn(A.TOP_K) + f""",
cand AS (
  SELECT s.*, k.user_id, k.opportunity_id, k.retrieval_rank, k.distance AS retrieval_distance,
         1.0 / (1.0 + greatest(k.distance, 0)) AS similarity
  FROM knn k JOIN snap s ON k.opportunity_id = s.source || '::' || s.id)"""


def scaled(c: str, by: str = "user_id") -> str:
    lo, hi = f"min({c}) OVER (PARTITION BY {by})", f"max({c}) OVER (PARTITION BY {by})"
    return f"CASE WHEN {hi} = {lo} THEN 0.0 ELSE ({c} - {lo}) / ({hi} - {lo}) END"


def _any(text: str, phrases) -> str:
    return "(" + " OR ".join(f"contains({text}, {quoted(p)})" for p in phrases) + ")"


_DOMAIN = "lower(CASE WHEN coalesce(domain, '') <> '' THEN domain ELSE coalesce(domain_category, '') END)"
BEGINNER = (
    "(" + _any(_DOMAIN, K.BEGINNER_DOMAINS) + " OR "
    + _any("lower(coalesce(title, '') || ' ' || coalesce(text, '') || ' ' || coalesce(topic_category, ''))", K.BEGINNER_PHRASES) + ")"
)

FEAT = CAND + f""",
feat AS (
  SELECT * EXCLUDE (engagement_score), ln(score + num_comments + 1.0) AS engagement_score,
         CAST(score AS DOUBLE) AS engagement_raw, CAST(num_comments AS DOUBLE) AS comments_raw,
         {days("date_trunc('second', created_ts)")} AS days_old,
         CASE WHEN {words('text')} > 300 THEN 'high' WHEN {words('text')} > 100 THEN 'medium' ELSE 'low' END AS effort,
         {first_label(('topic_category', 'domain_category', 'domain'))} AS diversity_domain
  FROM cand),
feat2 AS (
  SELECT *, 1.0 / (1.0 + days_old) AS freshness_score, comments_raw / greatest(days_old, 1) AS trend_score,
         CASE effort WHEN 'low' THEN 1.0 WHEN 'medium' THEN 0.6 ELSE 0.3 END::DOUBLE AS effort_score
  FROM feat)"""

SCORED = FEAT + f""",
norm AS (
  SELECT * EXCLUDE (engagement_score, freshness_score, trend_score), {scaled('engagement_score')} AS engagement_score,
         {scaled('freshness_score')} AS freshness_score, {scaled('trend_score')} AS trend_score
  FROM feat2),
scored AS (
  SELECT *, 0.45::DOUBLE * similarity + 0.20::DOUBLE * engagement_score + 0.15::DOUBLE * freshness_score
         + 0.10::DOUBLE * trend_score + 0.10::DOUBLE * effort_score
         + CASE WHEN {BEGINNER} THEN 0.10::DOUBLE ELSE 0.0::DOUBLE END AS final_score
  FROM norm)"""

SIMPLE = SCORED + """,
bonus AS (
  SELECT *, final_score + CASE WHEN row_number() OVER (PARTITION BY user_id, diversity_domain
           ORDER BY final_score DESC, retrieval_rank) = 1 THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END AS reranked_score
  FROM scored),
simple AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY reranked_score DESC, final_score DESC, retrieval_rank) AS rank
  FROM bonus)"""

_LABELS = ('topic_category', 'domain_category', 'domain')
DOMAIN_LABEL = f"trim(replace({first_label(_LABELS)}, '_', ' '))"
TOPIC_LABEL = f"replace({first_label(_LABELS, default='General Tech')}, '_', ' ')"
PAGE_LABEL = """CASE WHEN contains(lower(source), 'github') THEN 'GitHub issue or repository page'
  WHEN contains(lower(source), 'hacker') OR lower(source) = 'hn' THEN 'Hacker News discussion'
  WHEN contains(lower(source), 'reddit') THEN 'Reddit community thread'
  WHEN source <> '' THEN upper(substr(source, 1, 1)) || lower(substr(source, 2)) || ' page'
  ELSE 'Community page' END"""


def listed(source: str, value: str, name: str) -> str:
    return f"{name} AS (SELECT user_id, list({value} ORDER BY rn) AS {name} FROM {source} GROUP BY user_id)"


PROFILES = CLASSED + f""",
prof_rows AS (
  SELECT c.* EXCLUDE (text), o.lang, 'user-' || v.label AS user_id
  FROM classed c JOIN embeddings v ON v.vec_id = CAST(c.id AS BIGINT) % (SELECT count(*) FROM embeddings) JOIN opp o ON o.id = c.id),
prof_tokens AS (
  SELECT user_id, token, count(*) AS n FROM (
    SELECT user_id, unnest(regexp_extract_all(lower(title), '[\\p{{L}}\\p{{N}}_]{{3,}}')) AS token FROM prof_rows) GROUP BY ALL),
prof_tokens5 AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, token) AS rn FROM prof_tokens
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, token) <= 5),
prof_domains AS (SELECT user_id, domain_category, count(*) AS n FROM prof_rows GROUP BY ALL),
prof_domains2 AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, domain_category) AS rn FROM prof_domains
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, domain_category) <= 2),
prof_history AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY created_utc DESC, id) AS rn FROM prof_rows),
{listed('prof_tokens5', 'token', 'interests')},
expertise AS (SELECT user_id, list(lang ORDER BY lang) AS expertise FROM (SELECT DISTINCT user_id, lang FROM prof_rows) GROUP BY user_id),
{listed('prof_domains2', 'domain_category', 'preferred_domains')},
profiles AS (
  SELECT user_id, interests, expertise, preferred_domains
  FROM interests JOIN expertise USING (user_id) JOIN preferred_domains USING (user_id))"""

FEEDBACK = f"""
feedback AS (
  SELECT CAST(e.user_id AS VARCHAR) AS user_id, CAST(e.event_id % (SELECT count(*) FROM embeddings) AS VARCHAR) AS opportunity_id,
         {case('e.event_type', A.ACTIONS, 'NULL')} AS action, e.ts, e.event_id
  FROM events e)"""
