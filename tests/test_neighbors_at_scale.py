"""Nearest items of many users: skipped blocks, stored inverted files."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from pulserank.operators import ann, blocks, neighbors as N
from pulserank.operators.sampling import bounded_sample

K = 7


def clustered(n, seed, dim=16, groups=12):
    rng = np.random.default_rng(seed)
    centers = np.random.default_rng(99).normal(0, 4, (groups, dim))
    return centers[rng.integers(groups, size=n)] + rng.normal(0, 0.3, (n, dim))


@pytest.fixture(scope="module")
def items(spark):
    rows = [(f"i{i}", v.tolist()) for i, v in enumerate(clustered(3000, 1))]
    bad = [(None, rows[0][1]), ("nan", [float("nan")] * 16), ("null", None), ("hole", [None] * 16), ("inf", [float("inf")] * 16)]
    return spark.createDataFrame(rows + bad, "opportunity_id string, embedding array<double>").repartition(6).cache()


@pytest.fixture(scope="module")
def users(spark):
    rows = [(f"u{i}", v.tolist()) for i, v in enumerate(clustered(500, 2))]
    return spark.createDataFrame(rows + [(None, rows[0][1]), ("void", None)], "user_id string, embedding array<double>").cache()


@pytest.fixture(scope="module")
def exact(users, items):
    return N.knn(users, items, K)


def shown(df, value="retrieval_distance"):
    return sorted((r.user_id, r.retrieval_rank, r.opportunity_id, round(r[value], 9)) for r in df.collect())


@pytest.mark.parametrize("metric, value", [("l2", "retrieval_distance"), ("dot", "score")])
def test_blocks_equal_the_scan(users, items, metric, value):
    got = blocks.knn_blocks(users, items, K, metric, max_users=150, pivots=12, block_rows=64)
    assert shown(got, value) == shown(N.knn(users, items, K, metric), value)


def test_blocks_of_normalised_vectors(users, items):
    got = blocks.knn_blocks(users, items, 3, normalize=True, pivots=5, block_rows=100)
    assert shown(got) == shown(N.knn(users, items, 3, normalize=True))


def test_most_blocks_are_skipped(users, items):
    """Counted: pairs of a user and a block that the bound of the first pass spares the second one."""
    rows = blocks.block_partials(users, items, K, pivots=12, block_rows=64).where("user_id IS NULL").agg(F.sum("seen"), F.sum("skipped")).first()
    assert rows[1] > 5 * rows[0] > 0


def test_no_item_is_shuffled(users, items):
    plan = blocks.block_partials(users, items, K, pivots=4)._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "MapInArrow" in plan


def test_auto_takes_blocks_for_many_users(users, items, exact):
    got = N.knn(users, items, K, max_users=100)
    assert shown(got) == shown(exact)


def test_blocks_without_items_or_users(users, items):
    assert blocks.knn_blocks(users, items.limit(0), K).collect() == []
    assert blocks.knn_blocks(users.limit(0), items, K).collect() == []
    few = N.knn(users, items.limit(3).where("opportunity_id LIKE 'i%'"), 5, max_users=10)
    assert few.groupBy("user_id").count().agg(F.max("count")).first()[0] <= 3


def test_index_finds_nearly_all_with_exact_distances(spark, users, items, exact):
    index = ann.build_index(items, cells=30, parts=8, part_rows=50, buckets=5)
    assert index.parts.max() > 1
    found = ann.search(users, index, K, probes=4, refine=6, max_users=200).cache()
    known = {(r.user_id, r.opportunity_id): r.retrieval_distance for r in N.knn(users, items, 3000).collect()}
    rows = found.collect()
    assert all(abs(known[r.user_id, r.opportunity_id] - r.retrieval_distance) < 1e-9 for r in rows)
    assert found.groupBy("user_id").count().where(F.col("count") != K).isEmpty()
    assert N.recall(found, exact).where("recall < 0.9").isEmpty()
    again = ann.open_index(spark, index.path)
    assert shown(ann.search(users, again, K, probes=4, refine=6)) == shown(found)
    ann.close_index(spark, index)
    ann.close_index(spark, again)


def test_tuned_effort_reaches_its_recall(spark, items):
    """Users far from every item: all items are about equally near, so more cells and finalists are needed."""
    rng = np.random.default_rng(5)
    who = spark.createDataFrame([(f"u{i}", rng.normal(0, 1, 16).tolist()) for i in range(60)], "user_id string, embedding array<double>")
    index, true = ann.build_index(items, cells=30, parts=4, buckets=4), N.knn(who, items, K).cache()
    sample = who.where("user_id < 'u3'")
    probes, refine = ann.tune(sample, index, true.join(sample.select("user_id"), "user_id"), K)
    rows = N.recall(ann.search(who, index, K, probes, refine), true)
    assert rows.where("user_id < 'u3' AND recall < 0.9").isEmpty() and rows.agg(F.avg("recall")).first()[0] >= 0.9
    ann.close_index(spark, index)


def test_many_users_list_no_finalists(users, items, exact, monkeypatch):
    """Users beyond the limit travel to the index, here in several rounds; what they find is at least as near as with routed users."""
    index = ann.build_index(items, cells=30, parts=8, part_rows=50, buckets=5)
    routed = shown(ann.search(users, index, K, probes=4, refine=6))
    monkeypatch.setattr(ann, "_ROUTED", 0, raising=False)
    monkeypatch.setattr(ann, "_SHIPPED", 8 * 16 * 200, raising=False)
    monkeypatch.setattr(ann, "finalists", lambda *a: pytest.fail("finalists are listed"))
    found = ann.search(users, index, K, probes=4, refine=6).cache()
    near = shown(found)
    assert len(near) == len(routed) and all(a[:2] == b[:2] and a[3] <= b[3] for a, b in zip(near, routed))
    assert N.recall(found, exact).where("recall < 0.9").isEmpty()
    assert shown(ann.search(users, index, K, probes=30, refine=500)) == shown(exact)
    few, best = shown(ann.search(users, index, K, probes=1, refine=500)), {r[:2]: r[3] for r in shown(exact)}
    assert few != shown(exact) and all(r[3] >= best[r[:2]] - 1e-9 for r in few)
    ann.close_index(users.sparkSession, index)


def test_tuning_counts_in_one_pass(users, items, exact, monkeypatch):
    """The finalists that the tuned effort asks for hold enough neighbours of each user, a quarter of them does not."""
    index = ann.build_index(items, cells=30, parts=4, buckets=4)
    listed, asked = ann.finalists, ann.tune(users, index, exact, K)
    monkeypatch.setattr(ann, "_ROUTED", 0, raising=False)
    monkeypatch.setattr(ann, "finalists", lambda *a: pytest.fail("finalists are listed"))
    probes, refine = ann.tune(users, index, exact, K)
    assert (probes, refine) == asked

    def worst(n):
        hits = exact.join(listed(users.where("user_id LIKE 'u%'"), index, n, probes).select("user_id", "opportunity_id", F.lit(1).alias("hit")), ["user_id", "opportunity_id"], "left")
        return hits.groupBy("user_id").agg((F.count("hit") / F.count("*")).alias("r")).agg(F.min("r")).first()[0]

    assert worst(refine * K) >= 0.95
    assert refine == 4 or worst(refine * K // 4) < 0.95
    ann.close_index(users.sparkSession, index)


def test_codes_are_not_shuffled(spark, users, items):
    index = ann.build_index(items, cells=10, parts=4, buckets=4)
    plan = ann.finalists(users.where("user_id LIKE 'u%'"), index, 20, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(cell") == 1, plan
    ann.close_index(spark, index)


def test_index_of_equal_vectors(spark):
    same = spark.createDataFrame([(f"i{i}", [1.0, 2.0, 3.0]) for i in range(40)], "opportunity_id string, embedding array<double>")
    who = spark.createDataFrame([("u", [1.0, 2.0, 4.0])], "user_id string, embedding array<double>")
    index = ann.build_index(same, cells=4, parts=2, part_rows=16, buckets=2)
    rows = ann.search(who, index, 5).collect()
    assert [round(r.retrieval_distance, 9) for r in rows] == [1.0] * 5
    ann.close_index(spark, index)


def test_bounded_sample(spark):
    rows = spark.range(20_000).repartition(40)
    assert bounded_sample(rows, ["id"], 300).count() == 300
    assert bounded_sample(rows, ["id"], 50_000).count() == 20_000
    first = {r.id for r in bounded_sample(rows, ["id"], 300).collect()}
    assert first == {r.id for r in bounded_sample(rows.coalesce(3), ["id"], 300).collect()}


def test_tuning_sees_every_event_user(spark, monkeypatch):
    """1,500 users, most of them outside any sample of 256."""
    from pulserank.plans import queries_retrieval as Q

    class Seen(Exception):
        pass

    def stop(users, index, exact, k):
        raise Seen(users.count(), exact.select("user_id").distinct().count())

    monkeypatch.setattr(Q.ann, "tune", stop)
    with pytest.raises(Seen) as seen:
        Q.ann_event_users(spark, "/root/testdata/sf0.1")
    assert seen.value.args == (1500, 1500)


@pytest.mark.parametrize("metric", ["l2", "dot"])
@pytest.mark.parametrize("waiting", [50, 10**6])
def test_finalists_are_not_cut_after_every_block(monkeypatch, metric, waiting):
    """Whole numbers, so that many items are equally near and ids decide; chunks of few users, so that cuts fall inside a block."""
    rng = np.random.default_rng(3)
    asked, vectors = rng.integers(-2, 3, (70, 4)).astype(float), rng.integers(-2, 3, (900, 4)).astype(float)
    ids, cuts, cut = np.array([f"i{j}" for j in rng.permutation(900)]), [], N._TopK._cut
    monkeypatch.setattr(N, "_CELLS", 500)
    monkeypatch.setattr(N, "_WAITING", waiting, raising=False)
    monkeypatch.setattr(N._TopK, "_cut", lambda task: cuts.append(1) or cut(task))
    task = N._TopK([f"u{i}" for i in range(70)], asked, 7, metric)
    for start in range(0, 900, 37):
        task.add(vectors[start:start + 37], ids[start:start + 37])
    got = task.table().to_pydict()
    want = []
    for i, user in enumerate(asked):
        far = ((user - vectors) ** 2).sum(1) if metric == "l2" else -(user * vectors).sum(1)
        want += [(f"u{i}", *pair) for pair in sorted(zip(far, ids))[:7]]
    assert sorted(zip(got["user_id"], got["distance"], got["opportunity_id"])) == sorted(want)
    assert len(cuts) == 1 if waiting > 50 else len(cuts) > 1
