"""op3: licence notices in documents."""
from __future__ import annotations

from pyspark.sql import functions as F

from pulserank.llm.common import read
from pulserank.llm.licenses import background, fit, scan_licenses


def op3_licenses(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rows = scan_licenses(docs, fit(background(docs)))
    families = F.array_sort(F.array_distinct(F.transform("notices", lambda n: n["family"])))
    spans = F.array_join(F.transform("notices", lambda n: F.concat_ws(":", n["family"], n["start"].cast("string"), n["end"].cast("string"))), ",")
    return rows.select("doc_id", F.size("notices").cast("bigint").alias("n_notices"), F.array_join(families, ",").alias("families"), spans.alias("spans"))
