"""Helpers of the operators: batches, byte words, written tables."""
from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from pulserank.session import materialise, shared_folder

__all__ = ["SPACE", "arrow_batches", "chosen_rows", "column_free", "lower_bytes", "materialise", "pieces", "read", "shared_folder", "tables_of"]

#: The white space of the contracts: space and the control characters 9 to 13.
SPACE = " \t\n\x0b\x0c\r"
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_bytes(text: str | None) -> bytes:
    """UTF-8 with A-Z lowered; null is empty, a lone surrogate becomes ``?``."""
    return (text or "").encode("utf-8", "replace").translate(_LOWER)


def column_free(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores in front as it takes to clash with no column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def pieces(batches: Iterator[pa.RecordBatch], text: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of about ``limit`` bytes of ``text``: what a step holds is bounded."""
    for batch in batches:
        size = max(1, batch.column(text).nbytes)
        step = max(1, min(batch.num_rows, batch.num_rows * limit // size))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


@contextmanager
def arrow_batches(spark: SparkSession, limit: int) -> Iterator[None]:
    """Jobs run inside get Arrow batches of about ``limit`` bytes; Spark's own bound is 10,000 rows or 64 MB, held by JVM and worker alike."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(limit))
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def tables_of(df: DataFrame, names: list[str], defaults: dict[str, str]) -> DataFrame:
    """``df`` with columns ``names`` only, absent ones as typed nulls."""
    return df.select(*(F.col(f"`{n}`") if n in df.columns else F.lit(None).cast(defaults[n]).alias(n) for n in names))


def chosen_rows(rows: DataFrame, ids: DataFrame, key: str, how: str, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """``rows`` joined ``how`` (left_semi or left_anti) with the distinct values ``ids`` of their column ``key``.

    The ids are written and measured. Up to ``broadcast_bytes`` they travel to the rows, which stay where they are with their texts;
    beyond that both sides are shuffled.
    """
    ids = materialise(ids.select(key).distinct(), "chosen-ids")
    size = ids.agg(F.coalesce(F.sum(F.octet_length(F.col(key).cast("string")) + 32), F.lit(0))).first()[0]
    return rows.join(F.broadcast(ids) if size <= broadcast_bytes else ids, key, how)
