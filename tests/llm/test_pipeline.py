"""The pipeline against a plain version, and the registered queries."""
import random

import brute
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from pulserank.llm import bpe_automaton, catalog

WORDS = ["river", "stone", "mill", "tide", "silver", "under", "old", "kept", "north", "ñandú", "gate", "lamp"]
SHARED = "This very line stands in many of the documents below."
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ed", "ing"]) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(tmp_path_factory, spark):
    folder = str(tmp_path_factory.mktemp("corpus"))
    items = [(1, prose(900, 30)), (2, prose(901, 14))]
    texts = {}
    for i in range(260):
        texts[i] = prose(i, 20 + i % 40) + (f"\n{SHARED}\n{prose(i + 5000, 9)}" if i % 9 == 0 else "")
        if i % 5 == 0:
            texts[i] += " grubwort " + prose(i + 7000, 3) + " grubwort"
    texts |= {300: texts[1], 301: texts[2], 302: texts[1], 303: prose(3, 30) + " " + items[0][1], 304: items[1][1].upper(), 305: None, 306: "", 307: "one more short text"}
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in texts.items()]
    spark.createDataFrame(rows, DOC_SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int("grubwort" in (t or ""))) for i, t in texts.items() if i < 240]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, texts, items


def test_pipeline(spark, corpus):
    from tokenizers import Tokenizer

    folder, texts, items = corpus
    library = Tokenizer.from_file(bpe_automaton.default_path())
    docs = {i: t for i, t in texts.items() if "grubwort" not in (t or "")}
    docs = {i: t for i, (_, _, t) in brute.dedup_lines(docs).items()}
    _, groups = brute.simhash_groups(docs)
    docs = {i: t for i, t in docs.items() if groups[i] == i}
    docs = {i: t for i, t in docs.items() if not brute.contamination(t, items)[1]}
    want = {}
    for i, t in docs.items():
        ids = library.encode(t, add_special_tokens=False).ids
        want[i] = (len(ids), brute.sha(",".join(map(str, ids))), brute.sha(t))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, folder).collect()}
    assert got == want
    assert got[302][0] > 0 and got[1][0] == 0 and not {300, 301, 303, 304, 305, 306} & set(got)


def test_stages_take_awkward_rows(spark, corpus):
    folder = corpus[0]
    odd = spark.createDataFrame(
        [(None, "a text of nobody", None, None, None), (1, None, None, "s", 3), (1, None, None, "s", 3), (2, "x " * 4000, "en", None, 1)], DOC_SCHEMA
    ).withColumn("score", F.lit("mine")).withColumn("fingerprint", F.lit(1)).withColumn("ids", F.lit(2))
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, folder)
            assert out.columns == corpus_pipeline.COLUMNS
            rows = sorted((r.doc_id or 0) for r in out.collect())
            assert rows == ([] if docs is not odd else [0, 1, 2] if name == "simhash_dedup" else [0, 1, 1, 2])
        assert corpus_pipeline.bpe(spark, docs, folder).count() == (4 if docs is odd else 0)


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash_dedup", "decontaminate", "bpe"]


def test_every_query_is_registered():
    names = entry.queries()
    assert {n for n in names if n[:2] == "op" and n[2].isdigit()} == set(catalog.QUERIES) and "pipeline" in names
    assert {int(n[2:].split("_")[0]) for n in catalog.QUERIES} == set(range(1, 11))


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_queries_without_sql_return_a_row_per_document(spark, name):
    rows = catalog.QUERIES[name](spark, "/root/testdata/sf0.001").select("doc_id").collect()
    assert sorted(r.doc_id for r in rows) == list(range(200))


def test_texts_stay_where_they_are(spark, corpus):
    """Rows are chosen by ids that travel to them, whatever Spark knows of the sizes; many ids give the same rows by a shuffle."""
    from pulserank.llm.common import chosen_rows, read

    folder, before = corpus[0], spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    docs = read(spark, folder, "documents")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for stage in (corpus_pipeline.decontaminate, corpus_pipeline.near_dedup):
            plan = stage(spark, docs, folder)._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
        ids = spark.createDataFrame([(1,), (1,), (7,), (None,), (999,)], "doc_id long")
        for how in ("left_semi", "left_anti"):
            few, many = (sorted(r.doc_id for r in chosen_rows(docs, ids, "doc_id", how, limit).collect()) for limit in (64 << 20, 0))
            assert few == many == sorted(r.doc_id for r in docs.join(ids, "doc_id", how).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
