"""op9: personal data in documents."""
from __future__ import annotations

from pyspark.sql import functions as F

from pulserank.llm.common import read
from pulserank.llm.pii import KINDS, find_pii, joined_spans


def _count(kind):
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")


def op9_pii(spark, sf_dir):
    rows = find_pii(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", *map(_count, KINDS), F.sha2(joined_spans(F.col("base")), 256).alias("base_sha256"), joined_spans(F.col("spans")).alias("spans"))
