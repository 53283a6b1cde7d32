"""Balanced samples: a fixed number of rows per topic."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pulserank.operators.dedup import distinct_ids, top_n


def shuffled(id_column: str, seed: int) -> list[Column]:
    """A pseudo random total order that depends on seed and id only."""
    return [F.asc(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_column).cast("string")))), F.asc(id_column)]


def quota_sample(
    df: DataFrame, n: int, seed: int = 42, topic: str = "topic", id_column: str = "id", topics: Sequence[str] | None = None
) -> DataFrame:
    """Up to ``n`` rows per topic in shuffled order; an id counts once over all topics."""
    if topics is not None:
        df = df.where(F.col(topic).isin(*topics))
    once = distinct_ids(df, id_column)
    return top_n(once, [topic], shuffled(id_column, seed), n, rank="_place").drop("_place")


def fill_quota(
    sample: DataFrame, extra: DataFrame, n: int, seed: int = 42, topic: str = "topic", id_column: str = "id"
) -> DataFrame:
    """The sample plus unseen rows of ``extra`` for topics that are short of ``n``."""
    have = sample.groupBy(topic).agg(F.count("*").alias("_have"))
    unseen = distinct_ids(extra.join(sample.select(id_column), id_column, "left_anti"), id_column)
    placed = top_n(unseen, [topic], shuffled(id_column, seed), n, rank="_place")
    wanted = placed.join(have, topic, "left").where(F.col("_place") <= n - F.coalesce("_have", F.lit(0)))
    return sample.unionByName(wanted.select(*sample.columns))


def bounded_sample(df: DataFrame, key: Sequence[str], n: int) -> DataFrame:
    """At most ``n`` rows, those with the smallest hash of ``key``.

    A threshold on the hash leaves about 1.2 n rows of all tasks together, and only those are sorted: what is gathered does not grow with
    the number of partitions. Rows of one key share a hash; pass distinct rows if repeats must not fill the sample.
    """
    total = df.count()
    code = F.xxhash64(*key)
    if total > n:
        share = min(1.0, 1.2 * (n + 100) / total)
        df = df.where(F.pmod(code, F.lit(1 << 40)) < int(share * (1 << 40)))
    return df.orderBy(F.pmod(code, F.lit(1 << 40)), *key).limit(n)
