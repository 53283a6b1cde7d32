"""The corpus pipeline: stages of (name, function of (spark, docs, sf_dir)) over ``documents``.

Each stage's result is written as Parquet below ``spark.checkpoint.dir`` and reread, so a lost executor
costs a task of one stage and no stage is computed twice. Rows without an id pass every stage that decides by
id; a null text is an empty one. Columns other than those of ``documents`` are dropped.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pulserank.llm import bpe_automaton, toxicity as tox
from pulserank.llm.common import chosen_rows, materialise, read
from pulserank.llm.line_runs import dedup_lines
from pulserank.llm.near_copies import similar_groups
from pulserank.llm.q_decontaminate import marked

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: No SQL expresses the stages; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents with a score of 0.5 or more; the machine learns from ``labels``."""
    docs = docs.select(*COLUMNS)
    machine = tox.train(docs, read(spark, sf_dir, "labels"))
    return tox.score(docs, machine).where(F.col("score") < 0.5).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that at least 3 documents share, except in one of them; keeps every document."""
    return dedup_lines(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies: texts linked by a similarity of 0.8 or more.

    Similarity is Jaccard's, over sets of five-word shingles. Rows of one id count as one document.
    """
    docs = docs.select(*COLUMNS)
    groups = materialise(similar_groups(docs), "near-rows")
    kept = chosen_rows(docs, groups.where(F.col("doc_id") != F.col("component_id")), "doc_id", "left_anti").select(*COLUMNS)
    repeated = groups.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if repeated.isEmpty():
        return kept
    others = [c for c in COLUMNS if c != "doc_id"]
    one = kept.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*others)).alias("row"))
    return kept.join(repeated, "doc_id", "left_anti").select(*COLUMNS).unionByName(one.select("doc_id", "row.*"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold 10 consecutive words of a benchmark item."""
    docs = docs.select(*COLUMNS)
    found = marked(docs, read(spark, sf_dir, "benchmark"))
    return chosen_rows(docs, found.where(F.size("spans") > 0), "doc_id", "left_anti").select(*COLUMNS)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the token ids and of the decoded text."""
    return bpe_automaton.digests(bpe_automaton.round_trip(docs.select("doc_id", "text")))


STAGES = [
    ("toxicity", toxicity), ("line_dedup", line_dedup), ("simhash_dedup", near_dedup),
    ("decontaminate", decontaminate), ("bpe", bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
