"""Exact nearest items of many users: bounded blocks of items, skipped where a bound proves them useless.

The corpus is read once and written as blocks, one row each: vectors of one task that lie nearest to the same pivot, with their
centre, radius and norms. No item is shuffled. Users alone are replicated, as broadcasts of bounded size.
A broadcast of users meets the blocks in two passes. The first one looks into the blocks of each user's
nearest pivots and gives the distance of the k-th item found so far. That bound travels back to the tasks of the second pass, which skip
a block for a user if no vector in the ball around its centre can be nearer. Tasks tighten the bounds with what they find themselves.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pulserank.operators.neighbors import _TopK, _finish, _matrix, _vectors
from pulserank.operators.sampling import bounded_sample
from pulserank.session import materialise

BLOCKS = "pivot int, center array<double>, radius double, least_norm double, most_norm double, ids array<string>, vectors binary"
_PARTIALS = "user_id string, opportunity_id string, distance double, seen bigint, skipped bigint"
_BUFFER = 65_536  # vectors a task holds until it cuts them into blocks


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(squares, 0.0))


def pick_pivots(corpus: DataFrame, pivots: int = 64, sample_rows: int = 4096, normalize: bool = False) -> np.ndarray:
    """Vectors far from each other, chosen one after another from a bounded sample."""
    sample = _matrix(bounded_sample(corpus.select("opportunity_id", "embedding"), ["opportunity_id"], sample_rows).toArrow()["embedding"], normalize)
    if not len(sample):
        return np.zeros((0, 0))
    sample = sample[np.lexsort(sample.T[::-1])]
    chosen = [0]
    far = _distances(sample, sample[:1])[:, 0]
    while len(chosen) < pivots and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, _distances(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


def write_blocks(corpus: DataFrame, pivots: np.ndarray, block_rows: int = 1024, normalize: bool = False) -> DataFrame:
    """``corpus`` (opportunity_id, embedding) as blocks, written once below the shared folder."""

    def cut(ids: list[str], vectors: np.ndarray) -> Iterator[pa.RecordBatch]:
        near = _distances(vectors, pivots).argmin(1)
        order = np.argsort(near, kind="stable")
        rows = []
        for pivot in np.unique(near):
            own = order[near[order] == pivot]
            for at in range(0, len(own), block_rows):
                part = vectors[own[at:at + block_rows]]
                center = part.mean(0)
                norms = np.sqrt((part * part).sum(1))
                rows.append({
                    "pivot": int(pivot), "center": center, "radius": float(np.sqrt(((part - center) ** 2).sum(1)).max()), "least_norm": norms.min(),
                    "most_norm": norms.max(), "ids": [ids[i] for i in own[at:at + block_rows]], "vectors": part.astype("<f8").tobytes(),
                })
        fields = [
            ("pivot", pa.int32()), ("center", pa.list_(pa.float64())), ("radius", pa.float64()), ("least_norm", pa.float64()),
            ("most_norm", pa.float64()), ("ids", pa.list_(pa.string())), ("vectors", pa.binary()),
        ]
        yield from pa.Table.from_pylist(rows, pa.schema(fields)).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held = [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch["embedding"], normalize)
            if vectors.shape[1] != pivots.shape[1]:
                raise ValueError("vectors differ in dimension")
            ids += batch["opportunity_id"].to_pylist()
            held.append(vectors)
            if len(ids) >= _BUFFER:
                yield from cut(ids, np.concatenate(held))
                ids, held = [], []
        if ids:
            yield from cut(ids, np.concatenate(held))

    return materialise(corpus.mapInArrow(run, BLOCKS), "vector-blocks")


def _nearest_possible(
    users: np.ndarray, squares: np.ndarray, center: np.ndarray, radius: float, norms: tuple[float, float], metric: str
) -> np.ndarray:
    """The least distance that a vector of the block can have to each user, in the measure of ``_TopK``."""
    length, product = np.sqrt(squares), users @ center
    if metric == "dot":
        return -np.minimum(product + length * radius, length * norms[1])
    gap = np.sqrt(np.maximum(squares - 2 * product + center @ center, 0.0)) - radius
    gap = np.maximum(gap, np.maximum(norms[0] - length, length - norms[1]))
    return np.maximum(gap, 0.0) ** 2


def scan_blocks(
    blocks: DataFrame, names: list[str], users: np.ndarray, k: int, metric: str, home: np.ndarray | None, away: np.ndarray | None, bounds: np.ndarray | None,
) -> DataFrame:
    """At most ``k`` items per user and task, and a row without a user that counts the (block, user) pairs looked into and skipped.

    ``home`` (users x pivots) chooses the blocks to look into, ``away`` those to leave out; ``bounds`` are the distances to beat.
    """
    shared = blocks.sparkSession.sparkContext.broadcast((names, users, home, away, bounds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, users, home, away, bounds = shared.value
        task = _TopK(names, users, k, metric, bounds)
        seen = skipped = 0
        for batch in batches:
            for row in batch.to_pylist():
                chosen = np.ones(len(names), bool) if home is None else home[:, row["pivot"]].copy()
                if away is not None:
                    chosen &= ~away[:, row["pivot"]]
                chosen = np.flatnonzero(chosen)
                if not len(chosen):
                    continue
                least = _nearest_possible(users[chosen], task.squares[chosen], np.array(row["center"]), row["radius"], (row["least_norm"], row["most_norm"]), metric)
                best = task.bound[chosen]
                useful = least <= best + 1e-9 * (1 + np.abs(np.where(np.isfinite(best), best, 0.0)) + row["most_norm"] ** 2)
                seen, skipped = seen + int(useful.sum()), skipped + int((~useful).sum())
                if useful.any():
                    task.add(np.frombuffer(row["vectors"], "<f8").reshape(len(row["ids"]), -1), np.array(row["ids"], dtype=str), chosen[useful])
        table = task.table()
        for name, value in (("seen", seen), ("skipped", skipped)):
            table = table.append_column(name, pa.array([0] * len(table), pa.int64()))
        yield from table.to_batches()
        yield pa.RecordBatch.from_pydict(
            {"user_id": [None], "opportunity_id": [None], "distance": [None], "seen": [seen], "skipped": [skipped]}, schema=table.schema
        )

    return blocks.mapInArrow(run, _PARTIALS)


def block_partials(
    queries: DataFrame, corpus: DataFrame, k: int, metric: str = "l2", normalize: bool = False, max_users: int = 20_000,
    pivots: int = 64, block_rows: int = 1024, first: int = 2,
) -> DataFrame:
    """All rows of both passes of :func:`scan_blocks`, for users in broadcasts of at most ``max_users``.

    Users are read in blocks by a hash of their id; a pass hands on k rows per user and task, and one bound per user of the
    broadcast returns to the driver.
    """
    left = materialise(_vectors(queries, "user_id"), "block-users")
    right = _vectors(corpus, "opportunity_id")
    spark, centers = queries.sparkSession, pick_pivots(right, pivots, normalize=normalize)
    n_users = left.count()
    if not len(centers) or not n_users:
        return spark.createDataFrame([], _PARTIALS)
    blocks = write_blocks(right, centers, block_rows, normalize)
    passes, every = math.ceil(1.25 * n_users / max_users), None
    for number in range(passes):
        part = left if passes == 1 else left.where(F.pmod(F.xxhash64("user_id"), F.lit(passes)) == number)
        table = part.toArrow()
        if not len(table):
            continue
        names, users = table["user_id"].to_pylist(), _matrix(table["embedding"], normalize)
        if users.shape[1] != centers.shape[1]:
            raise ValueError(f"dimension {centers.shape[1]} does not match {users.shape[1]}")
        order = np.argsort(_distances(users, centers) if metric == "l2" else -(users @ centers.T), axis=1)[:, :first]
        home = np.zeros((len(names), len(centers)), bool)
        np.put_along_axis(home, order, True, axis=1)
        near = materialise(scan_blocks(blocks, names, users, k, metric, home, None, None), "block-near")
        found = _finish(near.where("user_id IS NOT NULL").select("user_id", "opportunity_id", "distance"), k, "l2").where(F.col("retrieval_rank") == k)
        place = {name: i for i, name in enumerate(names)}
        bounds = np.full(len(names), np.inf)
        for row in found.select("user_id", "retrieval_distance").collect():
            bounds[place[row.user_id]] = row.retrieval_distance
        both = near.unionByName(scan_blocks(blocks, names, users, k, metric, None, home, bounds))
        every = both if every is None else every.unionByName(both)
    return spark.createDataFrame([], _PARTIALS) if every is None else every


def knn_blocks(queries: DataFrame, corpus: DataFrame, k: int, metric: str = "l2", normalize: bool = False, **options) -> DataFrame:
    """:func:`pulserank.operators.neighbors.knn` for any number of users; ``options`` are those of :func:`block_partials`.

    User ids are taken to be distinct.
    """
    partials = block_partials(queries, corpus, k, metric, normalize, **options)
    return _finish(partials.where("user_id IS NOT NULL").select("user_id", "opportunity_id", "distance"), k, metric)
