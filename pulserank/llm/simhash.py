"""SimHash fingerprints, and groups of fingerprints within a few bits, found with BK-trees.

**Routing.** Two fingerprints that differ in at most r bits agree on one of r + 1 blocks of bits. So
each distinct fingerprint goes to r + 1 shards, one per block and value, and every link lies inside
a shard. A shard with more than ``shard_rows`` fingerprints is split the same way by its remaining
bits, again and again; the fourth level leaves at most 14 free bits, so no shard can hold more than
16,384 fingerprints, whatever the data. Trees of all shards together grow with the corpus, so a tree
is not sent everywhere: it is built in the task that its shard's fingerprints were shuffled to.

**Trees.** A shard is a BK-tree: a child hangs on its parent by the integer Hamming distance between
them, one child per distance. A search at distance d from a node follows only the edges from d - r to
d + r. The trees of a task are built and searched together, level by level, in numpy.

A task reports each linked fingerprint with one representative of its local group, a row each, so a
large group of near copies costs as many rows as members, not as pairs. Components join the groups.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from pulserank.llm.common import column_free, lower_bytes, materialise, pieces
from pulserank.llm.components import components

LEVELS = 4


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """A bit is 1 if it is set in over half of the hashes of the text's word shingles; no words: 0."""
    return fingerprint_of(shingle_hashes(lower_bytes(text).split(), words, seed))


def shingle_hashes(tokens: list[bytes], words: int, seed: int) -> np.ndarray:
    """The hashes of the runs of ``words`` tokens; fewer tokens are one run, none give no hash."""
    if not tokens:
        return np.empty(0, np.uint64)
    size = min(words, len(tokens))
    digest = xxhash.xxh64_intdigest
    shingles = map(b" ".join, zip(*(tokens[i:] for i in range(size))))
    return np.fromiter((digest(s, seed) for s in shingles), "<u8", len(tokens) - size + 1)


def fingerprint_of(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half of the hashes; no hashes: 0."""
    ones, total, step = np.zeros(64, np.int64), len(hashes), 1 << 16
    for start in range(0, total, step):  # long texts in blocks
        ones += _bit_counts(hashes[start:start + step])
    return sum(1 << i for i in range(64) if 2 * ones[i] > total)


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(hashes.view(np.uint8).reshape(len(hashes), 8), axis=1, bitorder="little")
    return np.add.reduce(bits, axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, text: str = "text", words: int = 3, seed: int = 42) -> DataFrame:
    """``docs`` with ``fingerprint`` (long, the unsigned bits); clash: the new name starts with an underscore."""
    name = column_free(docs, "fingerprint")

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(rows, text):
            prints = np.array([fingerprint(t, words, seed) for t in part.column(text).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(prints.view(np.int64))], [*part.schema.names, name])

    return docs.mapInArrow(batches, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


class BKForest:
    """The BK-trees of several shards. ``shard``: increasing codes; a tree's root is its shard's first value."""

    def __init__(self, values: np.ndarray, shard: np.ndarray):
        self.values = values
        n = len(values)
        self.root = np.searchsorted(shard, shard)
        self.child = np.full((n, 65), -1, np.int32)
        open_ = np.flatnonzero(self.root != np.arange(n))
        at = self.root[open_]
        while len(open_):
            edge = np.bitwise_count(values[open_] ^ values[at]).astype(np.int64)
            there = self.child[at, edge]
            free = there < 0
            # of the values that want the same free edge the first gets it
            _, first = np.unique(at[free] * 65 + edge[free], return_index=True)
            placed = np.flatnonzero(free)[first]
            self.child[at[placed], edge[placed]] = open_[placed]
            at = self.child[at, edge]
            moved = at != open_
            open_, at = open_[moved], at[moved]

    def near(self, queries: np.ndarray, radius: int, limit: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, found) places of values within ``radius``, each search in its own tree."""
        stack = [(queries, self.root[queries])]
        while stack:
            query, node = stack.pop()
            if len(query) > limit:  # bounds what is held at once
                half = len(query) // 2
                stack += [(query[:half], node[:half]), (query[half:], node[half:])]
                continue
            distance = np.bitwise_count(self.values[query] ^ self.values[node]).astype(np.int64)
            hit = distance <= radius
            if hit.any():
                yield query[hit], node[hit]
            for shift in range(-radius, radius + 1):
                edge = distance + shift
                fits = (edge >= 0) & (edge <= 64)
                q, child = query[fits], self.child[node[fits], edge[fits]]
                below = child >= 0
                if below.any():
                    stack.append((q[below], child[below].astype(np.int64)))


def local_groups(values: np.ndarray, shard: np.ndarray, radius: int) -> np.ndarray:
    """For each place the smallest place its links reach inside its shard."""
    forest = BKForest(values, shard)
    group = np.arange(len(values))
    for start in range(0, len(values), 1024):
        for query, found in forest.near(np.arange(start, min(start + 1024, len(values))), radius):
            while True:
                a, b = group[query], group[found]
                apart = a != b
                if not apart.any():
                    break
                low, high = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
                np.minimum.at(group, high, low)
                while True:  # every place points at the root of its group
                    up = group[group]
                    if (up == group).all():
                        break
                    group = up
    return group


def _blocks(free: list[int], parts: int) -> list[list[int]]:
    return [list(map(int, b)) for b in np.array_split(free, parts)]


def _mask(bits: list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >= 1 << 63 else value


def _routed(rows: DataFrame, level: int, radius: int) -> DataFrame:
    """Rows (value, shard, fixed) once per block of the bits that are not fixed; fixed names the blocks so far."""
    out = None
    paths = [()]
    for _ in range(level):
        paths = [(*p, i) for p in paths for i in range(radius + 1)]
    for path in paths:
        free = list(range(64))
        for i in path:
            taken = set(_blocks(free, radius + 1)[i])
            free = [b for b in free if b not in taken]
        name = "".join(map(str, path))
        mine = rows.where(F.col("fixed") == name)
        options = [
            F.struct(F.xxhash64("shard", F.lit(i), F.col("value").bitwiseAND(F.lit(_mask(b)))).alias("shard"), F.lit(name + str(i)).alias("fixed"))
            for i, b in enumerate(_blocks(free, radius + 1))
        ]
        part = mine.select("value", F.explode(F.array(*options)).alias("s")).select("value", "s.shard", "s.fixed")
        out = part if out is None else out.unionByName(part)
    return out


def near_links(values: DataFrame, radius: int = 2, shard_rows: int = 1024, task_rows: int = 50_000) -> DataFrame:
    """(a, b): links that join exactly the distinct ``value``s (long) within ``radius`` bits of each other.

    A value has a link to one representative per shard, not to every neighbour. A shard's code is a hash;
    two shards that share one are searched together, which finds the same links.
    """
    n = values.count()
    tasks = max(1, -(-n * (radius + 1) // task_rows))
    rows = values.select("value", F.lit(0).cast("long").alias("shard"), F.lit("").alias("fixed"))
    found = []
    for level in range(LEVELS):
        rows = materialise(_routed(rows, level, radius), f"shards-{level}")
        sizes = rows.groupBy("shard").agg(F.count("*").alias("n"))
        large = sizes.where(F.col("n") > shard_rows).select("shard") if level + 1 < LEVELS else None
        if large is not None and large.isEmpty():
            large = None
        shared = sizes.where((F.col("n") > 1) & (F.col("n") <= (shard_rows if large is not None else 1 << 62))).select("shard")
        small = rows.join(shared, "shard", "left_semi")
        found.append(_searched(small, radius, tasks))
        if large is None:
            break
        rows = rows.join(large, "shard", "left_semi")
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return links


def _searched(rows: DataFrame, radius: int, tasks: int) -> DataFrame:
    def search(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates().sort_values(["shard", "value"])
        values = frame["value"].to_numpy()
        group = local_groups(values.view(np.uint64), frame["shard"].to_numpy(), radius)
        linked = group != np.arange(len(group))
        return pd.DataFrame({"a": values[linked], "b": values[group[linked]]})

    task = F.pmod(F.xxhash64("shard"), F.lit(tasks)).alias("task")
    return rows.select("value", "shard", task).groupBy("task").applyInPandas(lambda f: search(f[["shard", "value"]]), "a long, b long")


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = 2, words: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fingerprint, component_id): each row's fingerprint (long) and the smallest id its links reach.

    Equal fingerprints are linked, others at ``radius`` or fewer bits; so texts without words, null ones among them, share
    fingerprint 0. A row without an id keeps its component's smallest id, or null if no row of it has one. Repeated rows
    stay repeated. Other columns are not returned. An empty table gives an empty result.
    """
    narrow = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    prints = materialise(fingerprints(narrow, words=words, seed=seed).select("doc_id", "fingerprint"), "fingerprints")
    classes = materialise(prints.groupBy(F.col("fingerprint").alias("value")).agg(F.min("doc_id").alias("first")), "classes")
    nodes = components(near_links(classes.select("value"), radius))
    grouped = classes.join(nodes, classes.value == nodes.node, "left").select("value", F.coalesce("component", "value").alias("component"), "first")
    least = grouped.groupBy("component").agg(F.min("first").alias("component_id"))
    by_print = materialise(grouped.join(least, "component").select("value", "component_id"), "groups")
    return prints.join(by_print, prints.fingerprint == by_print.value).select("doc_id", "fingerprint", "component_id")
