"""Data quality: named rules, counted in one pass."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pulserank.functions import constants as K
from pulserank.functions.text import clean

_ISO = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"


def report(
    df: DataFrame,
    rules: Mapping[str, Column],
    unique: Sequence[str] = (),
    columns: Sequence[str] = (),
    strict: bool = False,
) -> DataFrame:
    """Number of rows that break each rule, as ``rule, violations``.

    A rule is a condition that is true for bad rows.  ``unique`` adds a rule for repeated
    keys, ``columns`` one for absent columns.  ``strict`` raises if anything is broken.
    """
    named = {f"_{i}": name for i, name in enumerate([*rules, *(["duplicate_key"] if unique else [])])}
    broken = [F.count_if(F.coalesce(bad, F.lit(False))).alias(c) for c, bad in zip(named, rules.values())]
    if unique:  # rules are counted per key and added up, so rows are read once
        last = f"_{len(rules)}"
        per_key = df.groupBy(*unique).agg(*broken, (F.count("*") - 1).alias(last))
        counted = per_key.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in named])
    else:
        counted = df.agg(*broken)
    rows = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(c).alias("violations")) for c, name in named.items()])
    out = counted.select(F.explode(rows).alias("r")).select("r.rule", "r.violations")
    missing = [c for c in columns if c not in df.columns]
    if columns:
        line = df.sparkSession.range(1).select(
            F.lit("missing_columns").alias("rule"), F.lit(len(missing)).cast("bigint").alias("violations")
        )
        out = out.unionByName(line)
    if strict:
        bad = {r["rule"]: r["violations"] for r in out.where("violations > 0").collect()}
        if bad:
            raise ValueError(f"quality rules broken: {bad}")
    return out


def _blank(name: str) -> Column:
    return clean(name) == ""


def snapshot_rules() -> dict[str, Column]:
    return {"missing_id": F.col("id").isNull(), "empty_title": _blank("title")}


def archive_rules(topics: Sequence[str]) -> dict[str, Column]:
    """Rules of flat archive records."""
    return {
        "wrong_source": ~F.col("source").eqNullSafe("github"),
        "wrong_domain": ~F.col("domain").eqNullSafe("github.com"),
        "missing_id": _blank("id"),
        "missing_text_field": F.array_contains(
            F.array(*[F.col(c).isNull() for c in ("event_type", "repo_name", "actor_login", "title", "text", "url", "created_utc", "topic")]), True
        ),
        "empty_title": _blank("title"),
        "bad_repo": _blank("repo_name") | ~F.coalesce(F.contains("repo_name", F.lit("/")), F.lit(False)),
        "counts_not_null": F.col("score").isNotNull() | F.col("num_comments").isNotNull(),
        "bad_time": ~F.coalesce(F.rlike("created_utc", F.lit(_ISO)), F.lit(False)),
        "unknown_topic": ~F.coalesce(F.col("topic").isin(*topics), F.lit(False)),
    }


def hit_rules() -> dict[str, Column]:
    """Rules of flat search-hit records."""
    return {
        "wrong_source": ~F.col("source").eqNullSafe("hackernews"),
        "missing_id": _blank("id"),
        "missing_text_field": F.array_contains(
            F.array(*[F.col(c).isNull() for c in ("title", "text", "url", "created_utc")]), True
        ),
        "empty_title": _blank("title"),
        "wrong_url": ~F.col("url").eqNullSafe(F.concat(F.lit(K.ITEM_PAGE), F.col("id"))),
        "missing_count": F.col("score").isNull() | F.col("num_comments").isNull(),
        "bad_time": ~F.coalesce(F.rlike("created_utc", F.lit(_ISO)), F.lit(False)),
    }


def label_rules() -> dict[str, Column]:
    return {
        "missing_user": _blank("user_id"),
        "missing_opportunity": _blank("opportunity_id"),
        "unknown_interaction": F.col("interaction").isNull() | ~F.lower(clean("interaction")).isin(*K.RELEVANCE),
        "grade_out_of_range": F.col("relevance_label").isNull() | ~F.col("relevance_label").between(0, 3),
    }


def vector_rules(id_column: str, dim: int, column: str = "embedding") -> dict[str, Column]:
    """Rules of embedding records: identifier, vector, dimension."""
    return {
        "missing_id": _blank(id_column),
        "empty_vector": F.col(column).isNull() | (F.size(column) == 0),
        "wrong_dimension": F.size(column) != dim,
        "null_component": F.exists(column, lambda x: x.isNull()),
        "not_finite": F.exists(column, lambda x: F.isnan(x) | (F.abs(x) == F.lit(float("inf")))),
    }
