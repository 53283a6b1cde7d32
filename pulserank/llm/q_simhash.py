"""op5: documents by SimHash group."""
from __future__ import annotations

from pyspark.sql import functions as F

from pulserank.llm.common import read
from pulserank.llm.simhash import near_groups


def op5_simhash(spark, sf_dir):
    rows = near_groups(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
