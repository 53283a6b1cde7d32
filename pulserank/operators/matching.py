"""Which phrases of a dictionary occur in a text, for dictionaries of any size.

Texts leave the JVM as Arrow batches, and a task matches a batch with the whole dictionary by array operations
(:class:`pulserank.functions.kernels.PhraseIndex`); what returns are the places of the phrases. The dictionary travels with the function;
callers with unbounded dictionaries pass them in measured blocks.
"""
from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pulserank.functions import kernels
from pulserank.operators.sampling import bounded_sample


def constant(values: list, kind: str) -> Column:
    """A nested list as one constant of the plan."""
    return F.from_json(F.lit(json.dumps(values)), kind)


def gram_counts(df: DataFrame, text: Column, key: Sequence[str], rows: int = 2000) -> dict[bytes, int]:
    """In how many rows of a bounded sample each gram of three letters a-z, digits or blanks occurs; it steers the choice of anchors only."""
    sample = bounded_sample(df.select(*key, text.alias("_text")), key, rows)
    grams = F.array_distinct(F.regexp_extract_all(F.col("_text"), F.lit("(?=([a-z0-9 ]{3}))"), F.lit(1)))
    counted = sample.select(F.explode(grams).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
    return {r.gram.encode(): r.n for r in counted.collect()}  # at most 37^3 rows


def phrase_places(text: Column, phrases: Sequence[str], bordered: Sequence[bool] | None = None, counts: Mapping[bytes, int] | None = None) -> Column:
    """Ascending places (from 0) of the phrases that are substrings of ``text``; null has none.

    ``phrases`` are distinct and not empty; the ``bordered`` ones count as whole words only. ``counts`` are those of :func:`gram_counts`.
    """
    if not phrases:
        return F.array().cast("array<int>")
    phrases = list(phrases)

    @F.arrow_udf("array<int>")
    def places(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = kernels.PhraseIndex(phrases, bordered, counts)
        for batch in batches:
            yield index.places(batch)

    return places(text)


def words_of(text: Column) -> Column:
    """:func:`pulserank.functions.text.word_count` in Arrow batches, which is faster on long texts."""

    @F.arrow_udf("bigint")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield kernels.word_counts(batch)

    return counted(text)


def substring_hits(text: Column, phrases: Sequence[str], counts: Mapping[bytes, int] | None = None) -> Column:
    """Distinct phrases that are substrings of ``text``, in dictionary order."""
    phrases = list(dict.fromkeys(p for p in phrases if p))
    if not phrases:
        return F.array().cast("array<string>")
    every = constant(phrases, "array<string>")
    return F.transform(phrase_places(text, phrases, counts=counts), lambda i: F.get(every, i))


def phrase_list(df: DataFrame, column: str, max_bytes: int) -> list[str] | None:
    """Distinct values of a phrase column if they stay below ``max_bytes``, else None.

    Size and count are checked on the cluster first; nothing larger reaches the driver.
    """
    distinct = df.select(F.col(column).alias("p")).where(F.col("p").isNotNull() & (F.col("p") != "")).distinct().persist()
    try:
        size = distinct.agg(F.coalesce(F.sum(F.octet_length("p") + 8), F.lit(0)).alias("bytes")).first()["bytes"]
        return None if size > max_bytes else sorted(row["p"] for row in distinct.collect())
    finally:
        distinct.unpersist()


def vocabulary(path: str) -> dict[str, list[str]]:
    """A topic vocabulary ``{topic: [keyword, ...]}`` from a JSON file on the driver."""
    with open(path, encoding="utf-8") as handle:
        return {str(topic): [str(k) for k in keywords] for topic, keywords in json.load(handle).items()}
