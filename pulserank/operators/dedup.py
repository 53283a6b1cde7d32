"""Keep the best rows of a key."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from pulserank.functions.text import clean, col

# Up to this many rows per key Spark prunes each map task's rows before the shuffle
# (spark.sql.optimizer.windowGroupLimitThreshold).
_PRUNED_BY_SPARK = 1000


def top_n(
    df: DataFrame,
    keys: Sequence[str | Column],
    order: Sequence[Column],
    n: int,
    rank: str = "rank",
    salts: int = 64,
) -> DataFrame:
    """First ``n`` rows of every key by a total ``order``, with their rank from 1.

    ``row_number() <= n`` is pruned inside each map task before the shuffle, so a key
    that holds a third of all rows sends at most ``n`` rows per task.  Spark does that
    up to 1000 rows; beyond it the same cut first runs over salted parts of the key.
    """
    keys = [col(k) for k in keys]
    if n > _PRUNED_BY_SPARK:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c, t in df.dtypes if not t.startswith(("map", "variant"))]), F.lit(salts))
        first = Window.partitionBy(*keys, salt).orderBy(*order)
        df = df.withColumn(rank, F.row_number().over(first)).where(F.col(rank) <= n).drop(rank)
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def keep_best(df: DataFrame, key: Column, order: Sequence[Column]) -> DataFrame:
    """One row per key, the first by ``order``."""
    return top_n(df.withColumn("_key", key), ["_key"], order, 1, rank="_rank").drop("_key", "_rank")


def best_first(df: DataFrame) -> list[Column]:
    """Score, then comments, both descending; ties by source and id."""
    return [F.desc("score"), F.desc("num_comments"), F.asc("source"), F.asc("id")]


def dedup_source_id(df: DataFrame) -> DataFrame:
    """Keep the row with most engagement of every ``source::id``.

    Rows that tie on everything in the order are told apart by their other columns.
    """
    rest = [F.asc(c) for c in ("url", "title", "text", "created_utc", "domain") if c in df.columns]
    return keep_best(df, F.concat_ws("::", clean("source"), clean("id")), best_first(df) + rest)


def dedup_url(df: DataFrame, empty_url: str = "keep") -> DataFrame:
    """Keep the row with most engagement of every url, compared in lower case.

    ``empty_url='keep'`` leaves rows without a url alone.  ``'collapse'`` treats the
    empty url as one url, which keeps a single row of all of them.
    """
    if empty_url not in ("keep", "collapse"):
        raise ValueError("empty_url is 'keep' or 'collapse'")
    url = clean(F.lower("url"))
    own = F.concat_ws("::", clean("source"), clean("id"))
    key = url if empty_url == "collapse" else F.when(url == "", F.concat(F.lit(" "), own)).otherwise(url)
    return keep_best(df, key, best_first(df))


def deduplicate(df: DataFrame, empty_url: str = "keep") -> DataFrame:
    """By ``source::id`` first; by url among the survivors."""
    return dedup_url(dedup_source_id(df), empty_url)


def distinct_ids(df: DataFrame, id_column: str = "id", order: Sequence[Column] | None = None) -> DataFrame:
    """One row per id; by default the first in column order, so the choice does not depend on the input order."""
    if order is None:
        order = [F.asc(c) for c, t in df.dtypes if c != id_column and not t.startswith(("map", "variant"))]
    return keep_best(df, F.col(id_column), order or [F.asc(id_column)])
