"""Nearest items for every user: exact and approximate top-k over vectors.

The corpus is never collected and never crossed with the users: a task multiplies a
block of user vectors with a block of item vectors and hands on at most k rows per user.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType

from pulserank.functions.vectors import similarity_from_distance
from pulserank.operators.dedup import keep_best, top_n
from pulserank.operators.shaping import with_opportunity_id

_OUT = "user_id string, opportunity_id string, distance double"
_CELLS = 4_000_000  # entries of one distance block in memory
_KEPT = 2_000_000  # finalists that one task keeps for all its users
_WAITING = 1_000_000  # finalists that wait before they are cut


def _matrix(column: pa.ChunkedArray | pa.Array, normalize: bool) -> np.ndarray:
    rows = len(column)
    if rows == 0:
        return np.zeros((0, 0))
    sizes = pc.min_max(pc.list_value_length(column))
    if sizes["min"] != sizes["max"]:
        raise ValueError("vectors differ in dimension")
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    values = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in chunks]).astype("float64")
    matrix = values.reshape(rows, -1)
    if normalize:
        length = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
        length[length == 0] = 1.0
        matrix = matrix / length
    return matrix


class _TopK:
    """The best k (distance, id) pairs per user seen so far by one task.

    Finalists are collected and cut to k per user when they have doubled, not after every block of items, so the
    work besides the distances does not grow with the number of blocks. ``bound`` are distances known to be enough.
    """

    def __init__(self, names: list[str], queries: np.ndarray, k: int, metric: str, bound: np.ndarray | None = None):
        self.names, self.queries, self.k, self.metric = names, queries, k, metric
        self.squares = (queries * queries).sum(axis=1)
        self.bound = np.full(len(queries), np.inf) if bound is None else bound.copy()
        self.user = np.zeros(0, dtype=np.int64)
        self.item = np.zeros(0, dtype=np.int64)  # places in ids
        self.distance = np.zeros(0)
        self.ids = np.zeros(0, dtype="U1")
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.fresh: list[np.ndarray] = []
        self.n_fresh = self.n_waiting = self.newest = 0

    def add(self, items: np.ndarray, ids: np.ndarray, chosen: np.ndarray | None = None) -> None:
        """Compare ``items`` with all users, or with those at the places ``chosen``."""
        if not len(items) or not len(self.queries):
            return
        if items.shape[1] != self.queries.shape[1]:
            raise ValueError(f"dimension {items.shape[1]} does not match {self.queries.shape[1]}")
        step = max(1, _CELLS // len(items))
        own = (items * items).sum(axis=1)
        chosen = np.arange(len(self.queries)) if chosen is None else chosen
        at = len(self.ids) + self.n_fresh
        self.fresh.append(ids)
        self.n_fresh += len(ids)
        self.newest = len(ids)
        for start in range(0, len(chosen), step):
            here = chosen[start : start + step]
            rough = self.queries[here] @ items.T
            if self.metric == "l2":
                rough *= -2
                rough += own[None, :]
                rough += self.squares[here, None]
            else:
                np.negative(rough, out=rough)
            # The slack covers the rounding of the block product; exact values decide below.
            limit = self._slack(self.bound[here], own)
            hit = rough <= limit[:, None]
            many = np.flatnonzero(hit.sum(axis=1) > 2 * self.k)
            if len(many):
                part = rough[many]
                limit = np.minimum(limit[many], self._slack(np.partition(part, self.k - 1, axis=1)[:, self.k - 1], own))
                hit[many] = part <= limit[:, None]
                self.bound[here[many]] = np.minimum(self.bound[here[many]], limit)
            u, r = np.nonzero(hit)
            users = here[u]
            exact = np.empty(len(u))
            for first in range(0, len(u), 100_000):
                part = slice(first, first + 100_000)
                a, b = self.queries[users[part]], items[r[part]]
                exact[part] = ((a - b) ** 2).sum(axis=1) if self.metric == "l2" else -(a * b).sum(axis=1)
            self.waiting.append((users, at + r, exact))
            self.n_waiting += len(u)
            if self.n_waiting > max(len(self.user), _WAITING):
                at -= self._cut()
        self.newest = 0

    @staticmethod
    def _slack(limit: np.ndarray, own: np.ndarray) -> np.ndarray:
        return limit + 1e-9 * (1.0 + np.abs(np.where(np.isfinite(limit), limit, 0.0)) + own.max())

    def _cut(self) -> int:
        """Leaves k finalists per user. The block of ids that is being added stays whole; returned is by how much its place moves."""
        user, item, distance = (np.concatenate([old, *new]) for old, new in zip((self.user, self.item, self.distance), zip(*self.waiting) if self.waiting else ((), (), ())))
        ids = np.concatenate([self.ids, *self.fresh]) if self.fresh else self.ids
        order = np.lexsort((distance, user))
        user, item, distance = user[order], item[order], distance[order]
        same = np.flatnonzero((user[1:] == user[:-1]) & (distance[1:] == distance[:-1]))
        if len(same):  # ids are compared among equal distances only
            tied = np.union1d(same, same + 1)
            item[tied] = item[tied][np.lexsort((ids[item[tied]], distance[tied], user[tied]))]
        place = np.arange(len(user)) - np.searchsorted(user, user, side="left")
        keep = place < self.k
        self.user, item, self.distance = user[keep], item[keep], distance[keep]
        full = place[keep] == self.k - 1
        ends = self.user[full]
        self.bound[ends] = np.minimum(self.bound[ends], self.distance[full])
        used = np.union1d(item, np.arange(len(ids) - self.newest, len(ids)))
        self.ids, self.item = ids[used], np.searchsorted(used, item)
        self.waiting, self.fresh, self.n_fresh, self.n_waiting = [], [], 0, 0
        return len(ids) - len(used)

    def table(self) -> pa.Table:
        self._cut()
        return pa.table({
            "user_id": pa.array(self.names, pa.string()).take(pa.array(self.user)),
            "opportunity_id": pa.array(self.ids[self.item].tolist(), pa.string()),
            "distance": pa.array(self.distance, pa.float64()),
        })


def _ids(column) -> np.ndarray:
    values = column.to_pylist()
    return np.array(values, dtype=str) if values else np.zeros(0, dtype="U1")


def scan_pairs(
    queries: DataFrame,
    corpus: DataFrame,
    worker,
    schema: str,
    normalize: bool = False,
    method: str = "auto",
    max_broadcast_bytes: int = 64 << 20,
    block_rows: int = 8192,
    max_users: int = 100_000,
    carry: str | None = None,
) -> DataFrame:
    """Run ``worker`` over all (user, item) vector pairs without ever listing them.

    ``worker(names, vectors)`` is built once per task from user vectors (with ``carry``,
    a column of ``queries``, its values are a third argument); it is fed with
    ``add(items, ids)`` and asked for its ``table()`` at the end, so a task hands on a
    summary only.  ``method='broadcast'`` ships the users to the corpus tasks;
    ``'grid'`` lets bounded blocks of both sides meet and has no limit on either side;
    ``'auto'`` measures the users and takes the first form below ``max_broadcast_bytes``
    and ``max_users``; the latter also limits a block of users, and with it the memory of
    the worker.
    """
    if method not in ("auto", "broadcast", "grid"):
        raise ValueError("method is 'auto', 'broadcast' or 'grid'")
    left, right = _vectors(queries, "user_id", carry), _vectors(corpus, "opportunity_id")
    if method != "grid" and (shipped := _shipped(left, right, worker, schema, normalize, carry, max_broadcast_bytes, max_users)) is not None:
        return shipped
    left, right = _grid(left, right, left.count(), right.count(), min(block_rows, max_users), block_rows)
    return _meet_blocks(left, right, ["qb", "cb"], worker, schema, normalize, carry)


def _shipped(users: DataFrame, corpus: DataFrame, worker, schema: str, normalize: bool, carry: str | None, max_bytes: int, max_users: int) -> DataFrame | None:
    """The scan with all users in a broadcast, or None if their measured size is above the limits."""
    users.persist()
    try:
        size = users.agg(F.coalesce(F.sum(F.size("embedding") * 8 + 64), F.lit(0)).alias("bytes"), F.count("*").alias("rows")).first()
        if size["bytes"] <= max_bytes and size["rows"] <= max_users:
            return _ship_users(users, corpus, worker, schema, normalize, carry)
        return None
    finally:
        users.unpersist()


def _users(table: pa.Table, normalize: bool, carry: str | None) -> tuple:
    names, vectors = table["user_id"].to_pylist(), _matrix(table["embedding"], normalize)
    return (names, vectors) if carry is None else (names, vectors, table[carry].to_pylist())


def _ship_users(queries: DataFrame, corpus: DataFrame, worker, schema: str, normalize: bool, carry: str | None) -> DataFrame:
    """Users travel to the corpus, which stays where it is read."""
    shipped = corpus.sparkSession.sparkContext.broadcast(_users(queries.toArrow(), normalize, carry))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = worker(*shipped.value)
        for batch in batches:
            task.add(_matrix(batch["embedding"], normalize), _ids(batch["opportunity_id"]))
        yield from task.table().to_batches()

    return corpus.mapInArrow(scan, schema)


def _meet_blocks(queries: DataFrame, corpus: DataFrame, keys: list[str], worker, schema: str, normalize: bool, carry: str | None = None) -> DataFrame:
    """Blocks of users meet blocks of items that carry the same keys."""

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        task = worker(*_users(left, normalize, carry))
        task.add(_matrix(right["embedding"], normalize), _ids(right["opportunity_id"]))
        return task.table()

    return queries.groupBy(*keys).cogroup(corpus.groupBy(*keys)).applyInArrow(meet, schema)


def _grid(queries: DataFrame, corpus: DataFrame, n_queries: int, n_items: int, user_rows: int, item_rows: int):
    """Every block of users against every block of items, both of bounded size."""
    rows, columns = max(1, math.ceil(n_queries / user_rows)), max(1, math.ceil(n_items / item_rows))

    def block(name: str, n: int) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(n)).cast("int")

    def all_of(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = queries.withColumn("qb", block("user_id", rows)).withColumn("cb", all_of(columns))
    right = corpus.withColumn("cb", block("opportunity_id", columns)).withColumn("qb", all_of(rows))
    return left, right


def finite(embedding: str | Column) -> Column:
    """Vectors with nothing but finite components; others have no distance to anything."""
    vector = F.col(embedding) if isinstance(embedding, str) else embedding
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & good, F.lit(False))


def _vectors(df: DataFrame, id_column: str, carry: str | None = None) -> DataFrame:
    return df.select(
        F.col(id_column).cast("string").alias(id_column), F.col("embedding"), *([carry] if carry else [])
    ).where(F.col(id_column).isNotNull() & finite("embedding"))


def knn(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    metric: str = "l2",
    normalize: bool = False,
    method: str = "auto",
    max_broadcast_bytes: int = 64 << 20,
    block_rows: int = 8192,
    max_users: int | None = None,
) -> DataFrame:
    """The ``k`` nearest items of every user: ``user_id, opportunity_id, retrieval_rank, retrieval_distance``.

    ``queries`` has ``user_id, embedding`` and ``corpus`` ``opportunity_id, embedding``.
    Rows without an id and vectors with null, NaN or infinite components take no part;
    ``quality.vector_rules`` counts them.
    ``metric='l2'`` ranks by squared distance, ``'dot'`` by inner product (reported as
    ``score``, larger first).  Ties go to the smaller id.  Distances are computed in
    double precision.
    ``'auto'`` and ``'broadcast'`` measure the users and broadcast them if they are at most ``max_broadcast_bytes`` and ``max_users`` (by default
    2,000,000 / k). Beyond that it is ``'blocks'``, which leaves the corpus where it is and takes any number of users
    (:func:`pulserank.operators.blocks.knn_blocks`). ``'grid'`` is the one of :func:`scan_pairs`.
    """
    if metric not in ("l2", "dot"):
        raise ValueError("metric is 'l2' or 'dot'")
    if method not in ("auto", "broadcast", "blocks", "grid"):
        raise ValueError("method is 'auto', 'broadcast', 'blocks' or 'grid'")
    max_users, worker = max_users or max(1, _KEPT // max(k, 1)), partial(_TopK, k=k, metric=metric)
    if method == "grid":
        partials = scan_pairs(queries, corpus, worker, _OUT, normalize, method, max_broadcast_bytes, block_rows, max_users)
        return _finish(partials, k, metric)
    partials = None
    if method != "blocks":
        partials = _shipped(
            _vectors(queries, "user_id"), _vectors(corpus, "opportunity_id"), worker, _OUT, normalize, None, max_broadcast_bytes, max_users
        )
    if partials is None:
        from pulserank.operators.blocks import knn_blocks

        return knn_blocks(queries, corpus, k, metric, normalize, max_users=max_users)
    return _finish(partials, k, metric)


def _finish(partials: DataFrame, k: int, metric: str) -> DataFrame:
    best = top_n(partials, ["user_id"], [F.asc("distance"), F.asc("opportunity_id")], k, rank="retrieval_rank")
    rank = F.col("retrieval_rank").cast("bigint").alias("retrieval_rank")
    value = F.col("distance").alias("retrieval_distance") if metric == "l2" else (-F.col("distance")).alias("score")
    return best.select("user_id", "opportunity_id", rank, value)


def lsh_buckets(embedding: str | Column, dim: int, width: float, tables: int, bits: int, seed: int = 0) -> Column:
    """One bucket number per hash table: random projections cut into steps of ``width``."""

    @F.pandas_udf(ArrayType(LongType()))
    def buckets(values):
        rng = np.random.default_rng(seed)
        planes = rng.standard_normal((tables * bits, dim))
        shifts = rng.uniform(0.0, width, tables * bits)
        mixers = rng.integers(1, 2**31 - 1, size=bits, dtype=np.int64)
        matrix = np.stack(values.to_numpy()).astype("float64") if len(values) else np.zeros((0, dim))
        cells = np.floor((matrix @ planes.T + shifts) / width).astype(np.int64).reshape(len(values), tables, bits)
        return type(values)(list((cells * mixers).sum(axis=2)), dtype=object)

    return buckets(embedding)


def knn_lsh(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    dim: int,
    width: float,
    tables: int = 8,
    bits: int = 4,
    seed: int = 0,
    block_rows: int = 8192,
) -> DataFrame:
    """Approximate :func:`knn` by squared distance: items that share a bucket with the user in one table.

    A bucket with more than ``block_rows`` items (or users) is split into parts of that
    size, and each part hands on at most ``k`` rows per user: no bucket lists its pairs.
    """
    left, right = _vectors(queries, "user_id"), _vectors(corpus, "opportunity_id")

    def hashed(df: DataFrame) -> DataFrame:
        codes = lsh_buckets("embedding", dim, width, tables, bits, seed)
        return df.select("*", F.posexplode(codes).alias("table", "bucket"))

    keys = ["table", "bucket"]
    left, right = hashed(left), hashed(right)

    def parts(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.ceil(F.count("*") / F.lit(block_rows)).cast("int").alias(name))

    # Only buckets that hold users matter.
    sizes = parts(left, "qn").join(parts(right, "cn"), keys)

    def part_of(name: str, n: str) -> Column:
        return F.pmod(F.xxhash64(name), F.col(n)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = left.join(sizes, keys).withColumn("qs", part_of("user_id", "qn")).withColumn("cs", every("cn"))
    right = right.join(sizes, keys).withColumn("cs", part_of("opportunity_id", "cn")).withColumn("qs", every("qn"))
    names = keys + ["qs", "cs"]
    partials = _meet_blocks(
        left.select("user_id", "embedding", *names),
        right.select("opportunity_id", "embedding", *names),
        names, partial(_TopK, k=k, metric="l2"), _OUT, False,
    )
    once = partials.groupBy("user_id", "opportunity_id").agg(F.min("distance").alias("distance"))
    return _finish(once, k, "l2")


def recall(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact neighbours that the approximate search found, per user."""
    found = approximate.select("user_id", "opportunity_id", F.lit(1).alias("found"))
    return (
        exact.join(found, ["user_id", "opportunity_id"], "left")
        .groupBy("user_id")
        .agg((F.count("found") / F.count("*")).alias("recall"))
    )


def join_candidates(neighbors: DataFrame, snapshot: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """Neighbours with their snapshot rows and similarity; unmatched ones are dropped, ranks stay.

    If several snapshot rows carry one identifier, the first by ``order`` is taken.
    Popular items repeat on the neighbour side; adaptive execution splits them.
    """
    rows = with_opportunity_id(snapshot)
    rows = rows.join(neighbors.select("opportunity_id").distinct(), "opportunity_id", "left_semi")  # the rest is never sorted
    wanted = order or [F.desc_nulls_last(c) for c in ("score", "num_comments") if c in rows.columns]
    rows = keep_best(rows, F.col("opportunity_id"), wanted + [F.asc(c) for c in ("title", "url") if c in rows.columns] or [F.asc("opportunity_id")])
    return neighbors.join(rows.drop("user_id"), "opportunity_id").withColumn(
        "similarity", similarity_from_distance("retrieval_distance")
    )
