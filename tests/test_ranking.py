"""Ranking, quality and vectors against brute force."""
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulserank.operators import evaluation, feedback, neighbors, ranking, sampling


def greedy_mmr(rows, lam, top_n):
    left, picked, seen = list(rows), [], set()
    while left and len(picked) < top_n:
        best = max(left, key=lambda r: (lam * r[2] - (1 - lam) * (r[1] in seen), -r[0]))
        left.remove(best)
        picked.append(best[0])
        seen.add(best[1])
    return picked


@pytest.mark.parametrize("lam", [0.0, 0.5, 0.7, 1.0])
def test_mmr_is_greedy(spark, lam):
    rng = random.Random(int(lam * 10))
    lists = {f"u{u}": [(i, rng.choice("abc"), rng.choice([0.1, 0.2, 0.5, 0.9])) for i in range(1, 13)] for u in range(20)}
    rows = [(u, f"o{i}", i, d, s) for u, items in lists.items() for i, d, s in items]
    df = spark.createDataFrame(rows, "user_id string, opportunity_id string, retrieval_rank int, diversity_domain string, final_score double")
    got = {}
    for r in ranking.rerank(df, "mmr", lam=lam, top_n=8).orderBy("user_id", "rank").collect():
        got.setdefault(r["user_id"], []).append(r["retrieval_rank"])
    assert got == {u: greedy_mmr(items, lam, 8) for u, items in lists.items()}


def test_simple_bonus(spark):
    df = spark.createDataFrame(
        [("u", 1, "a", 0.50), ("u", 2, "a", 0.49), ("u", 3, "b", 0.46)], "user_id string, retrieval_rank int, diversity_domain string, final_score double"
    )
    rows = ranking.rerank(df, "simple").orderBy("rank").collect()
    assert [(r["retrieval_rank"], round(r["reranked_score"], 2)) for r in rows] == [(1, 0.55), (3, 0.51), (2, 0.49)]


def dcg(gains, k):
    return sum(g / math.log2(i + 2) for i, g in enumerate(gains[:k]))


def test_ndcg_averages_ties(spark):
    pool = [(3, 0.9), (0, 0.5), (2, 0.5), (1, 0.5), (2, 0.1)]
    df = spark.createDataFrame([("u", str(i), g, s) for i, (g, s) in enumerate(pool)] + [("z", "1", 0, 0.3), ("z", "2", 0, 0.2)],
                               "user_id string, opportunity_id string, label int, score double")
    orders = [p for p in itertools.permutations(pool) if all(a[1] >= b[1] for a, b in zip(p, p[1:]))]
    want = np.mean([dcg([g for g, _ in p], 3) for p in orders]) / dcg(sorted((g for g, _ in pool), reverse=True), 3)
    got = {r["user_id"]: r["ndcg"] for r in evaluation.ndcg(df, "label", "score", k=3).collect()}
    assert got["u"] == pytest.approx(want) and got["z"] == 0.0


def vectors(spark, rng, n, dim, name, prefix):
    data = rng.standard_normal((n, dim)).astype("float32")
    rows = [(f"{prefix}{i:03d}", v.tolist()) for i, v in enumerate(data)]
    return data.astype(float), spark.createDataFrame(rows, f"{name} string, embedding array<float>").repartition(3)


def test_knn_against_brute_force(spark):
    rng = np.random.default_rng(1)
    items, corpus = vectors(spark, rng, 300, 8, "opportunity_id", "o")
    copies = spark.createDataFrame([(f"p{i:03d}", items[7].tolist()) for i in range(40)], "opportunity_id string, embedding array<float>")
    corpus, items = corpus.union(copies), np.vstack([items, np.repeat(items[7:8], 40, axis=0)])
    names = [f"o{i:03d}" for i in range(300)] + [f"p{i:03d}" for i in range(40)]
    queries, users = vectors(spark, rng, 5, 8, "user_id", "u")
    queries = np.vstack([queries, items[7]])
    users = users.union(spark.createDataFrame([("u005", items[7].tolist())], "user_id string, embedding array<float>"))
    want = {}
    for u, q in enumerate(queries):
        distance = ((items - q) ** 2).sum(axis=1)
        want[f"u{u:03d}"] = [names[i] for i in sorted(range(len(names)), key=lambda i: (distance[i], names[i]))[:25]]
    for options in ({"method": "broadcast"}, {"method": "grid", "block_rows": 60}, {"max_broadcast_bytes": 10, "block_rows": 50}):
        got = {}
        for r in neighbors.knn(users, corpus, 25, **options).orderBy("user_id", "retrieval_rank").collect():
            got.setdefault(r["user_id"], []).append(r["opportunity_id"])
        assert got == want
    near = neighbors.knn_lsh(users, corpus, 25, dim=8, width=4.0, tables=6, bits=2, block_rows=30)
    assert near.groupBy("user_id").count().where("count > 25").count() == 0
    found = neighbors.recall(near, neighbors.knn(users, corpus, 25)).agg(F.avg("recall")).first()[0]
    assert found > 0.6


def test_dimension_mismatch_fails(spark):
    users = spark.createDataFrame([("u", [1.0, 2.0])], "user_id string, embedding array<float>")
    corpus = spark.createDataFrame([("o", [1.0, 2.0, 3.0])], "opportunity_id string, embedding array<float>")
    with pytest.raises(Exception, match="dimension"):
        neighbors.knn(users, corpus, 1).collect()


@pytest.mark.parametrize("options", [{}, {"method": "grid", "block_rows": 40}, {"bins": 2}])
def test_cutoffs_are_exact_quantiles(spark, options):
    rng = np.random.default_rng(2)
    items, corpus = vectors(spark, rng, 150, 6, "opportunity_id", "o")
    queries, users = vectors(spark, rng, 4, 6, "user_id", "u")
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    got = feedback.similarity_cutoffs(users, corpus, normalize=True, **options).orderBy("user_id").collect()
    for row, q in zip(got, unit(queries)):
        assert row["cutoffs"] == pytest.approx([np.quantile(unit(items) @ q, p) for p in (0.95, 0.85, 0.70)])


def test_fold_equals_loop(spark):
    rng = np.random.default_rng(3)
    items, corpus = vectors(spark, rng, 20, 4, "opportunity_id", "o")
    starts, users = vectors(spark, rng, 3, 4, "user_id", "u")
    acts = [(f"u{rng.integers(3):03d}", f"o{rng.integers(20):03d}", ["engage", "bookmark", "skip", "view"][rng.integers(4)], int(rng.integers(30)), i) for i in range(200)]
    events = spark.createDataFrame(acts, "user_id string, opportunity_id string, action string, s int, event_id bigint").withColumn("ts", F.timestamp_seconds("s"))
    unit = lambda v: v / np.linalg.norm(v)
    want = {f"u{i:03d}": unit(v) for i, v in enumerate(starts)}
    for u, o, action, _, _ in sorted(acts, key=lambda a: (a[3], a[4])):
        if action in feedback.K.FEEDBACK_WEIGHTS:
            a, b = feedback.K.FEEDBACK_WEIGHTS[action]
            want[u] = unit(a * want[u] + b * unit(items[int(o[1:])]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {r["user_id"]: r["embedding"] for r in feedback.fold(users, events, corpus).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert set(got) == set(want)
    for u in want:
        assert got[u] == pytest.approx(want[u])


def test_quota(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") < 90, "big").otherwise("small").alias("topic"))
    sample = sampling.quota_sample(df.union(df), 20)
    assert {r["topic"]: r["count"] for r in sample.groupBy("topic").count().collect()} == {"big": 20, "small": 10}
    extra = spark.range(95, 130).select(F.col("id").cast("string").alias("id"), F.lit("small").alias("topic"))
    filled = sampling.fill_quota(sample.select("id", "topic"), extra, 20)
    assert filled.where("topic = 'small'").select("id").distinct().count() == 20


def test_minmax_range_and_no_row_python(spark):
    df = spark.createDataFrame([("u", float(i)) for i in range(5)] + [("v", 1.0)], "user_id string, engagement_score double")
    rows = ranking.minmax(df).collect()
    assert all(0.0 <= r["engagement_score"] <= 1.0 for r in rows)
    assert "BatchEvalPython" not in ranking.minmax(df)._jdf.queryExecution().executedPlan().toString()
