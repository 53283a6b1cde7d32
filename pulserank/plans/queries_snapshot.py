"""Queries over duplicates, the snapshot and its quality."""
from __future__ import annotations

from pyspark.sql import functions as F

from pulserank.functions import constants as K
from pulserank.operators import analytics, dedup
from pulserank.operators.quality import report, snapshot_rules
from pulserank.operators.shaping import standardize
from pulserank.plans import adapters as A, oracle_parts as O, snapshot as S
from pulserank.plans.catalog import query
from pulserank.session import materialise

_FEED_STD = O.FEED + f""",
fstd AS (
  SELECT event_id, id, {O.clean('source')} AS source, {O.clean('title')} AS title, '' AS text, {O.clean('url')} AS url, score, num_comments,
         created_utc, {O.host('url')} AS domain FROM feed)"""
_SHOWN = "source, id, score, num_comments, url, title"


def _feed(spark, sf):
    return standardize(A.feed(spark, sf).select(*K.RAW_COLUMNS[:-1]))


@query("dedup_source_id", f"WITH {_FEED_STD}, {O.dedup('fstd', 'best')} SELECT {_SHOWN} FROM best_1")
def dedup_source_id(spark, sf):
    return dedup.dedup_source_id(_feed(spark, sf)).select(*_SHOWN.split(", "))


@query("dedup_url", f"WITH {_FEED_STD}, {O.dedup('fstd', 'best')} SELECT {_SHOWN} FROM best")
def dedup_url(spark, sf):
    return dedup.deduplicate(_feed(spark, sf)).select(*_SHOWN.split(", "))


@query("dedup_url_collapse", f"WITH {_FEED_STD}, {O.dedup('fstd', 'best', 'collapse')} SELECT {_SHOWN} FROM best")
def dedup_url_collapse(spark, sf):
    return dedup.deduplicate(_feed(spark, sf), empty_url="collapse").select(*_SHOWN.split(", "))


@query("distinct_ids", f"""WITH {O.FEED} SELECT id, source, url FROM (SELECT id, source, url FROM feed)
QUALIFY row_number() OVER (PARTITION BY id ORDER BY source, url) = 1""")
def distinct_ids(spark, sf):
    return dedup.distinct_ids(A.feed(spark, sf).select("id", "source", "url"))


@query("union_sources", f"""WITH {O.OPP}, {O.FEED}, both_rows AS (
  SELECT source, score, lang FROM opp UNION ALL SELECT source, score, NULL FROM feed)
SELECT source, lang, count(*) AS n, CAST(sum(score) AS BIGINT) AS total FROM both_rows GROUP BY ALL""")
def union_sources(spark, sf):
    merged = S.union_sources([
        A.opportunities(spark, sf).select("source", "score", "lang"), A.feed(spark, sf).select("source", "score")
    ])
    return merged.groupBy("source", "lang").agg(F.count("*").alias("n"), F.sum("score").alias("total"))


def kept(spark, sf):
    """The rows of the snapshot before texts, categories and features, which keep the rows as they are."""
    return dedup.deduplicate(A.untexted(spark, sf))


def _snapshot(spark, sf):
    return S.snapshot([A.untexted(spark, sf)], A.REFERENCE_TS, A.TOPICS, A.DOMAINS, complete=lambda rows: A.with_text(rows, spark, sf))


@query("snapshot_build", f"WITH {O.SNAP} SELECT {', '.join(K.SNAPSHOT_COLUMNS)} FROM snap")
def snapshot_build(spark, sf):
    return _snapshot(spark, sf)


@query("snapshot_metadata", f"""WITH {O.SNAP}
SELECT 'row_counts' AS section, 'merged' AS key, count(*) AS rows FROM std UNION ALL
SELECT 'row_counts', 'raw_total', count(*) FROM std UNION ALL
SELECT 'row_counts', 'after_deduplication', count(*) FROM best UNION ALL
SELECT 'row_counts', 'final', count(*) FROM snap UNION ALL
SELECT 'deduplication', 'removed', (SELECT count(*) FROM std) - count(*) FROM best UNION ALL
SELECT 'domain_coverage', domain_category, count(*) FROM snap GROUP BY domain_category UNION ALL
SELECT 'topic_coverage', topic_category, count(*) FROM snap GROUP BY topic_category""")
def snapshot_metadata(spark, sf):
    _, meta = S.build(
        [A.untexted(spark, sf)], A.REFERENCE_TS, A.TOPICS, domains=A.DOMAINS, complete=lambda rows: A.with_text(rows, spark, sf)
    )
    parts = [
        meta.select(F.lit(name).alias("section"), F.explode(name).alias("key", "rows"))
        for name in ("row_counts", "domain_coverage", "topic_coverage")
    ]
    parts.append(meta.select(F.lit("deduplication").alias("section"), F.lit("removed").alias("key"), F.col("deduplication_count").alias("rows")))
    return S.union_sources(parts)


@query("quality_report", f"""WITH {_FEED_STD}
SELECT 'missing_id' AS rule, count(*) FILTER (id IS NULL) AS violations FROM fstd UNION ALL
SELECT 'empty_title', count(*) FILTER (title = '') FROM fstd UNION ALL
SELECT 'empty_url', count(*) FILTER (url = '') FROM fstd UNION ALL
SELECT 'duplicate_key', (SELECT count(*) FROM fstd) - count(*) FROM (SELECT DISTINCT source, id FROM fstd) UNION ALL
SELECT 'missing_columns', 6""")
def quality_report(spark, sf):
    rules = snapshot_rules() | {"empty_url": F.col("url") == ""}
    return report(_feed(spark, sf), rules, unique=("source", "id"), columns=K.SNAPSHOT_COLUMNS)


@query("stage_counts", f"""WITH {O.SNAP}
SELECT 'standardised' AS stage, count(*) AS rows FROM std UNION ALL
SELECT 'after_source_id', count(*) FROM best_1 UNION ALL SELECT 'after_url', count(*) FROM best""")
def stage_counts(spark, sf):
    """Of the rows after the first key only what the second one compares is stored."""
    raw = A.untexted(spark, sf)
    first = materialise(dedup.dedup_source_id(raw).select("source", "id", "url", "score", "num_comments"), "after-source-id", compression="zstd")
    return analytics.stage_counts({"standardised": raw, "after_source_id": first, "after_url": dedup.dedup_url(first)})
