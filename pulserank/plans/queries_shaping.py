"""Queries over single rows and simple counts."""
from __future__ import annotations

from pyspark.sql import functions as F

from pulserank.functions import constants as K
from pulserank.functions.text import collapse_lines, word_count
from pulserank.functions.urls import url_host
from pulserank.operators.matching import gram_counts
from pulserank.operators import analytics, classify
from pulserank.operators.shaping import (
    analytics_view, board_defaults, embedding_text, page_label, prompt_pick, snapshot_features, standardize, topic_label,
    with_opportunity_id,
)
from pulserank.plans import adapters as A, oracle_parts as O
from pulserank.plans.catalog import query, r6


@query("active_communities", f"""WITH {O.CLASSED}
SELECT concat_ws('::', source, coalesce(CASE WHEN trim(domain) = '' THEN 'unknown' ELSE domain END)) AS community, count(*) AS post_count
FROM classed GROUP BY 1""")
def active_communities(spark, sf):
    return analytics.active_communities(analytics_view(A.with_domain(spark, sf)))


@query("category_distribution", f"WITH {O.CLASSED} SELECT topic_category AS category, count(*) AS count FROM classed GROUP BY 1")
def category_distribution(spark, sf):
    return analytics.category_distribution(analytics_view(A.classified(spark, sf)))


@query("domain_distribution", f"WITH {O.CLASSED} SELECT domain, count(*) AS count FROM classed GROUP BY 1")
def domain_distribution(spark, sf):
    return analytics.domain_distribution(analytics_view(A.with_domain(spark, sf)))


_DAILY = O.FEED + ", daily AS (SELECT CAST(created_utc AS DATE) AS day, count(*) AS count FROM feed GROUP BY 1)"
_WEEKLY = _DAILY + """, weekly AS (
  SELECT week, weekly_count, active_days, lag(weekly_count) OVER (ORDER BY week) AS prev_week_count FROM (
    SELECT CAST(date_trunc('week', day) AS DATE) AS week, CAST(sum(count) AS BIGINT) AS weekly_count, count(*) AS active_days
    FROM daily GROUP BY 1))"""
_WOW = """SELECT CAST(week AS VARCHAR) AS week, weekly_count, active_days, prev_week_count,
  weekly_count - prev_week_count AS wow_delta, round((weekly_count - prev_week_count) / prev_week_count * 100, 2) AS wow_pct_change
FROM weekly WHERE prev_week_count IS NOT NULL"""


@query("daily_volume", f"WITH {_DAILY} SELECT CAST(day AS VARCHAR) AS day, count FROM daily")
def daily_volume(spark, sf):
    return analytics.daily_volume(analytics_view(A.feed(spark, sf))).withColumn("day", F.col("day").cast("string"))


@query("weekly_volume_wow", f"WITH {_WEEKLY} {_WOW}")
def weekly_volume_wow(spark, sf):
    daily = analytics.daily_volume(analytics_view(A.feed(spark, sf)))
    return analytics.weekly_wow(daily).withColumn("week", F.col("week").cast("string"))


@query("last_weeks", f"WITH {_WEEKLY} {_WOW} ORDER BY weekly.week DESC LIMIT 3")
def last_weeks(spark, sf):
    daily = analytics.daily_volume(analytics_view(A.feed(spark, sf)))
    return analytics.last_weeks(analytics.weekly_wow(daily), 3).withColumn("week", F.col("week").cast("string"))


def _coverage_sql(column: str) -> str:
    return f"""WITH {O.CLASSED}, per AS (SELECT {column} AS category, count(*) AS count FROM classed GROUP BY 1),
total AS (SELECT sum(count) AS n, min(CASE WHEN category NOT IN ('unknown', 'other') THEN count END) AS least FROM per),
small AS (SELECT min(category) AS category FROM per, total WHERE count = least AND category NOT IN ('unknown', 'other'))
SELECT per.category, count, round(count / n, 6) AS share, per.category = 'unknown' AND count / n >= 0.5 AS unknown_warning,
  coalesce(per.category = small.category AND count / n < 0.05, false) AS low_coverage
FROM per, total, small"""


@query("domain_coverage", _coverage_sql("domain_category"))
def domain_coverage(spark, sf):
    return analytics.coverage(A.with_domain(spark, sf), "domain_category").withColumn("share", r6("share"))


@query("topic_coverage", _coverage_sql("topic_category"))
def topic_coverage(spark, sf):
    return analytics.coverage(A.classified(spark, sf), "topic_category").withColumn("share", r6("share"))


@query("standardize_opportunities", f"""WITH {O.OPP}
SELECT id, CASE WHEN num_comments % 5 = 0 THEN 'landed' ELSE {O.clean('source')} END AS source, {O.clean('title')} AS title,
  {O.clean('text')} AS text, CASE WHEN num_comments % 7 = 0 THEN '' ELSE {O.clean('url')} END AS url,
  CASE WHEN num_comments % 3 = 0 THEN 0 ELSE score END AS score, num_comments,
  CASE WHEN num_comments % 11 = 0 THEN NULL ELSE strftime(created_utc, '%Y-%m-%d %H:%M:%S') END AS created_utc,
  CASE WHEN num_comments % 7 = 0 THEN NULL ELSE {O.host('url')} END AS domain
FROM opp""")
def standardize_opportunities(spark, sf):
    raw = A.opportunities(spark, sf)
    k = F.col("num_comments")
    messy = raw.select(
        "id",
        F.when(k % 5 != 0, F.concat(F.lit(" "), "source", F.lit("\t"))).alias("source"),
        F.concat(F.lit("\n "), "title", F.lit(" ")).alias("title"),
        "text",
        F.when(k % 7 != 0, F.col("url")).alias("url"),
        F.when(k % 3 == 0, "n/a").otherwise(F.concat(F.col("score").cast("string"), F.lit(".7"))).alias("points"),
        k.cast("string").alias("comments"),
        F.when(k % 11 == 0, "not a time").otherwise(F.date_format("created_utc", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).alias("created_at"),
    )
    out = standardize(messy, "landed")
    return out.withColumn("created_utc", F.date_format("created_utc", "yyyy-MM-dd HH:mm:ss"))


@query("opportunity_ids", f"""WITH {O.OPP}, holes AS (
  SELECT id AS key, source, CASE WHEN num_comments % 2 = 0 THEN NULL ELSE id END AS id, CASE WHEN num_comments % 3 = 0 THEN '' ELSE url END AS url, title FROM opp)
SELECT key, CASE WHEN id IS NOT NULL THEN source || '::' || id WHEN url <> '' THEN source || '::' || substr(sha256({O.clean('url')}), 1, 16)
  ELSE source || '::' || substr(sha256(source || '|' || {O.clean('title')}), 1, 16) END AS opportunity_id
FROM holes""")
def opportunity_ids(spark, sf):
    k = F.col("num_comments")
    raw = A.opportunities(spark, sf).select(
        F.col("id").alias("key"), "source", F.when(k % 2 != 0, F.col("id")).alias("id"),
        F.when(k % 3 == 0, "").otherwise(F.col("url")).alias("url"), "title",
    )
    return with_opportunity_id(raw).select("key", "opportunity_id")


@query("url_hosts", f"SELECT page_id, {O.host('url')} AS host FROM pages")
def url_hosts(spark, sf):
    return A.table(spark, sf, "pages").select("page_id", url_host("url").alias("host"))


_BLANK, _BREAK = f"[{K.BLANKS}]+", f" ?[{K.LINE_BREAKS}][ {K.LINE_BREAKS}]*"


@query("embedding_texts", f"""WITH {O.CLASSED}, texts AS (
  SELECT id, 'Title: ' || title || chr(10) || 'Description: ' || text || chr(10) || 'Domain: '
    || {O.first_label(('topic_category', 'domain_category', 'domain'), K.EMPTY_LABELS_FOR_EMBEDDING)} || chr(10) || 'Source: ' || source AS t FROM classed)
SELECT id, trim(regexp_replace(regexp_replace({O.strip('t')}, {O.quoted(_BLANK)}, ' ', 'g'), {O.quoted(_BREAK)}, chr(10), 'g'), ' ' || chr(10)) AS embedding_text
FROM texts""")
def embedding_texts(spark, sf):
    rows = A.classified(spark, sf)
    return rows.select("id", collapse_lines(embedding_text(rows)).alias("embedding_text"))


@query("page_labels", f"WITH {O.CLASSED} SELECT id, {O.PAGE_LABEL} AS page, {O.TOPIC_LABEL} AS topic FROM classed")
def page_labels(spark, sf):
    rows = A.classified(spark, sf)
    return rows.select("id", page_label("source").alias("page"), topic_label(rows).alias("topic"))


@query("board_defaults", f"""WITH {O.OPP}
SELECT source || '::' || substr(sha256({O.clean('url')}), 1, 16) AS id, source AS platform, source, title, text, url,
  CAST(score AS DOUBLE) AS score, 'General Tech' AS topic_category, 'General Tech' AS domain_category FROM opp""")
def board(spark, sf):
    raw = A.opportunities(spark, sf).select(F.col("source").alias("platform"), "title", "text", "url", "score")
    out = board_defaults(raw)
    return out.select("id", "platform", "source", "title", "text", "url", "score", "topic_category", "domain_category")


@query("effort_bucket", f"""SELECT doc_id, {O.words('text')} AS words,
  CASE WHEN {O.words('text')} > 300 THEN 'high' WHEN {O.words('text')} > 100 THEN 'medium' ELSE 'low' END AS effort FROM documents""")
def effort_bucket(spark, sf):
    return A.table(spark, sf, "documents").select(
        "doc_id", word_count("text").cast("bigint").alias("words"), classify.effort("text").alias("effort")
    )


@query("classify_domain", f"WITH {O.STD} SELECT id, domain, {O.domain_category('domain')} AS domain_category FROM std")
def classify_domain(spark, sf):
    return A.with_domain(spark, sf).select("id", "domain", "domain_category")


@query("classify_domain_join", f"WITH {O.STD} SELECT id, domain, {O.domain_category('domain')} AS domain_category FROM std")
def classify_domain_join(spark, sf):
    mapping = spark.createDataFrame(
        [(known, category, i) for i, (known, category) in enumerate(A.DOMAINS.items())], "known string, category string, ord int"
    )
    rows = A.with_domain(spark, sf).drop("domain_category")
    return classify.domain_category_join(rows, mapping).select("id", "domain", "domain_category")


@query("classify_topic", f"WITH {O.STD} SELECT id, {O.topic_category('title', 'text')} AS topic_category FROM std")
def classify_topic(spark, sf):
    return A.classified(spark, sf).select("id", "topic_category")


def _word(blob: str, words) -> str:
    import re

    return f"regexp_matches({blob}, {O.quoted('(^|[^0-9A-Za-z_À-ɏ])(' + '|'.join(re.escape(w) for w in words) + ')($|[^0-9A-Za-z_À-ɏ])')})"


def _word_or_sign(topic: str, words) -> str:
    if topic != "Signs":
        return _word("lower(text)", words)
    return "(" + _word("lower(text)", words[:1]) + f" OR contains(lower(text), {O.quoted(words[1])}))"


_MATCHES = ", ".join(f"CASE WHEN {_word_or_sign(t, w)} THEN {O.quoted(t)} END" for t, w in A.WORD_TOPICS.items())
_MATCHED = f"matched AS (SELECT doc_id, list_filter_null AS topics FROM (SELECT doc_id, [x FOR x IN [{_MATCHES}] IF x IS NOT NULL] AS list_filter_null FROM documents))"



#: Over a thousand keywords by a rule: a letter before each common ending of a language.
_ENDINGS = {
    "English Prose": "tion ing the and her ent ter ous ble ght", "French Prose": "ment eau que les oir aux eur iez ais ont",
    "Spanish Prose": "ción aba ndo mos ada ero osa illo ante rse", "German Prose": "ung ich sch ein keit heit lich isch ert ten",
}
MANY_TOPICS = {topic: [x + e for e in ends.split() for x in "abcdefghijklmnopqrstuvwxyzäöüéàñ"] for topic, ends in _ENDINGS.items()}


@query("classify_topic_large", f"""WITH {O.OPP}, texts AS (
  SELECT DISTINCT title, text FROM opp), voted AS (SELECT *, {O.topic_category('title', 'text', MANY_TOPICS)} AS topic_category FROM texts)
SELECT id, topic_category FROM opp JOIN voted USING (title, text)""")
def classify_topic_large(spark, sf):
    """A vocabulary of 1,280 keywords, with anchors by the counts of a bounded sample."""
    rows = A.opportunities(spark, sf)
    counts = gram_counts(A.table(spark, sf, "documents"), F.lower("text"), ["doc_id"])
    return classify.topic_votes(rows, MANY_TOPICS, counts=counts).select("id", "topic_category")


@query("topic_match", f"WITH {_MATCHED} SELECT doc_id, array_to_string(topics, ' | ') AS topics FROM matched")
def topic_match(spark, sf):
    rows = A.table(spark, sf, "documents")
    return rows.select("doc_id", F.array_join(classify.topic_matches(F.lower("text"), A.WORD_TOPICS), " | ").alias("topics"))


@query("rarest_topic", f"""WITH {_MATCHED}, flat AS (SELECT doc_id, unnest(topics) AS topic, generate_subscripts(topics, 1) AS i FROM matched),
totals AS (SELECT topic, count(*) AS n FROM flat GROUP BY 1)
SELECT m.doc_id, (SELECT arg_min(f.topic, t.n * 100 + f.i) FROM flat f JOIN totals t USING (topic) WHERE f.doc_id = m.doc_id) AS topic FROM matched m""")
def rarest_topic(spark, sf):
    rows = A.table(spark, sf, "documents").select("doc_id", classify.topic_matches(F.lower("text"), A.WORD_TOPICS).alias("topics"))
    return classify.rarest_topic(rows).select("doc_id", "topic")


_TEMPLATES = {
    "user-1": ["As a learner: {title}", "What does {title} say about {topic}?"],
    "github": ["Patch {title}", "Review {title}", "Ask about {title}"],
    "reddit": ["Reply to {title}"],
    "other": ["Note on {title}", "Summary of {title}", "Why {topic}?", "More on {topic}"],
}


def _template_sql() -> str:
    def branch(texts) -> str:
        digit = "CAST(('0x' || substr(md5('7:' || id), 1, 12)) AS BIGINT)"
        items = "[" + ", ".join(O.quoted(t) for t in texts) + "]"
        return f"{items}[{digit} % {len(texts)} + 1]"

    return f"""CASE WHEN contains('user-' || user_id, 'user-1') THEN {branch(_TEMPLATES['user-1'])}
      WHEN contains(source, 'github') THEN {branch(_TEMPLATES['github'])}
      WHEN contains(source, 'reddit') THEN {branch(_TEMPLATES['reddit'])}
      ELSE {branch(_TEMPLATES['other'])} END"""


@query("prompt_pick", f"""WITH {O.OPP}, labelled AS (
  SELECT id, source, title, user_id, {O.topic_category('title', 'text')} AS topic_category FROM opp)
SELECT id, replace(replace({_template_sql()}, '{{topic}}', CASE WHEN topic_category = 'unknown' THEN 'General Tech' ELSE topic_category END), '{{title}}', title) AS writing_prompt
FROM labelled""")
def prompts(spark, sf):
    rows = classify.topic_votes(A.opportunities(spark, sf), A.TOPICS)
    picked = prompt_pick(rows, _TEMPLATES, F.concat(F.lit("user-"), F.col("user_id").cast("string")), seed=7)
    return picked.select("id", "writing_prompt")


@query("snapshot_features", f"""WITH {O.STD}
SELECT id, CAST(length(title) AS INT) AS title_length, CAST({O.days('created_utc')} AS INT) AS age_days,
  CAST(score AS DOUBLE) + 2.0 * num_comments AS engagement_score, strftime(created_utc, '%Y-%m-%dT%H:%M:%SZ') AS created_utc,
  strftime(TIMESTAMP '{A.REFERENCE_TS}', '%Y-%m-%dT%H:%M:%SZ') AS snapshot_utc FROM std""")
def features(spark, sf):
    rows = snapshot_features(A.with_domain(spark, sf), A.REFERENCE_TS)
    return rows.select("id", "title_length", "age_days", "engagement_score", "created_utc", "snapshot_utc")
