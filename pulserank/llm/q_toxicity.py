"""op10: toxicity of documents."""
from __future__ import annotations

from pyspark.sql import functions as F

from pulserank.llm.common import read
from pulserank.llm.toxicity import held_out, score, train


def op10_toxicity(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, train(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
