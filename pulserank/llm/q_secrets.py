"""op7: secrets in documents."""
from __future__ import annotations

from pyspark.sql import functions as F

from pulserank.llm.common import read
from pulserank.llm.secrets import BASE_KINDS, GUESS, find_secrets, joined_spans


def _count(kind):
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")


def op7_secrets(spark, sf_dir):
    rows = find_secrets(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["kind"] != GUESS)
    return rows.select("doc_id", *map(_count, BASE_KINDS), F.sha2(joined_spans(base), 256).alias("base_sha256"), joined_spans(F.col("spans")).alias("spans"))
