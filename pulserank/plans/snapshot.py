"""Raw sources to one deduplicated, classified snapshot."""
from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from pulserank.functions import constants as K
from pulserank.operators.analytics import counts
from pulserank.operators.classify import domain_category, topic_votes
from pulserank.operators.dedup import deduplicate
from pulserank.operators.quality import report, snapshot_rules
from pulserank.operators.shaping import snapshot_features, union_sources
from pulserank.sources.sinks import metadata
from pulserank.session import scratch_path


def snapshot(
    frames: Sequence[DataFrame],
    reference_ts: str | Column,
    topics: Mapping[str, Sequence[str]],
    domains: Mapping[str, str] = K.DOMAIN_CATEGORIES,
    empty_url: str = "keep",
    watch: Callable[[DataFrame, str], DataFrame] = lambda df, stage: df,
    complete: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Union of standardised frames, without duplicates, classified, with features.

    Two shuffles, one per duplicate key; everything after them is narrow. ``complete`` gives the
    kept rows columns, such as long texts, that are stored elsewhere and need not pass the shuffles.
    """
    merged = watch(union_sources(frames), "merged")
    rows = watch(deduplicate(merged, empty_url), "after_deduplication")
    return finish(complete(rows), reference_ts, topics, domains).select(*K.SNAPSHOT_COLUMNS)


def finish(
    rows: DataFrame, reference_ts: str | Column, topics: Mapping[str, Sequence[str]], domains: Mapping[str, str] = K.DOMAIN_CATEGORIES
) -> DataFrame:
    """Categories and features of standardised rows, row by row."""
    rows = topic_votes(rows.withColumn("domain_category", domain_category("domain", domains)), topics)
    return snapshot_features(rows, reference_ts)


def build(
    frames: Sequence[DataFrame],
    reference_ts: str,
    topics: Mapping[str, Sequence[str]],
    path: str | None = None,
    strict: bool = False,
    files: Sequence[str] = (),
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Write the snapshot once and return it with its metadata row.

    Stage counts are observed while the snapshot is written; coverage reads the written
    table, one column each. Texts that neighbouring rows repeat are packed.
    """
    seen: dict[str, Observation] = {}

    def watch(df: DataFrame, stage: str) -> DataFrame:
        seen[stage] = Observation(stage)
        return df.observe(seen[stage], F.count(F.lit(1)).alias("rows"))

    spark = frames[0].sparkSession
    path = path or scratch_path(spark, "snapshot")
    planned = snapshot(frames, reference_ts, topics, watch=watch, **options)
    planned.write.option("compression", "zstd").parquet(path)
    written = spark.read.schema(planned.schema).parquet(path)
    if strict:
        report(written, snapshot_rules(), unique=("source", "id"), columns=K.SNAPSHOT_COLUMNS, strict=True)
    rows = {"merged": seen["merged"].get["rows"], "after_deduplication": seen["after_deduplication"].get["rows"]}
    rows = {"raw_total": rows["merged"], **rows, "final": rows["after_deduplication"]}
    coverage = {
        "domain_coverage": counts(written, "domain_category", "category", ordered=False),
        "topic_coverage": counts(written, "topic_category", "category", ordered=False),
    }
    return written, metadata(rows, coverage, spark, list(files), path, reference_ts)
