"""Groups of texts whose sets of word shingles have a Jaccard similarity of at least a bound.

**Candidates.** Equal sets are one class. Classes whose SimHash fingerprints are linked by the BK-trees of
``simhash``, or that share one of BANDS bands of ROWS minimum hashes, fall into one loose cluster. SimHash alone would not do:
at similarity 0.8 about 10 of 64 bits differ, and a search that wide visits nearly all nodes. At
0.8 two classes share no band with probability (1 - 0.8 ** 6) ** 40, about 5 in a million; above it less.

**Check.** In a cluster every pair is compared by the sets themselves. Clusters above ``block`` classes are cut into blocks,
and each pair of blocks is a task of its own, so a large group of near copies is dealt out. A task reports
each linked class with one representative, not the pairs. Components join the groups.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from pulserank.llm.common import chosen_rows, lower_bytes, materialise, pieces
from pulserank.llm.components import components
from pulserank.llm.simhash import fingerprint_of, near_links, shingle_hashes

BANDS, ROWS = 40, 6
_RNG = np.random.default_rng(11)
_XOR = _RNG.integers(0, 1 << 64, BANDS * ROWS, np.uint64)
_TIMES = _RNG.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """A hash per band of the minimum hashes of the distinct ``shingles``; none without shingles."""
    if not len(shingles):
        return np.empty(0, np.int64)
    least = np.full(BANDS * ROWS, (1 << 64) - 1, np.uint64)
    for start in range(0, len(shingles), 2048):  # long texts in blocks
        part = shingles[start:start + 2048]
        np.minimum(least, ((part[:, None] ^ _XOR) * _TIMES).min(axis=0), out=least)
    bands = least.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(b.tobytes(), i) for i, b in enumerate(bands)], np.uint64).view(np.int64)


def _signed(shingles: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes())).view(np.int64))


def _signatures(docs: DataFrame, words: int, seed: int) -> DataFrame:
    """(doc_id, row_key, value, fingerprint, bands) of rows (doc_id, row_key, text); ``value`` stands for the set."""
    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(rows, "text"):
            values, prints, bands = [], [], []
            for text in part.column("text").to_pylist():
                hashes = shingle_hashes(lower_bytes(text).split(), words, seed)
                shingles = np.unique(hashes)
                values.append(_signed(shingles))
                prints.append(fingerprint_of(hashes))
                bands.append(band_keys(shingles))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("row_key"), pa.array(values, pa.int64()), pa.array(np.array(prints, np.uint64).view(np.int64)), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "row_key", "value", "fingerprint", "bands"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(batches, f"doc_id {kind}, row_key long, value long, fingerprint long, bands array<long>")


def _shingles(docs: DataFrame, words: int, seed: int) -> DataFrame:
    """(value, shingles) of rows with ``text``; the shingles as the bytes of their sorted 64-bit hashes."""
    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(rows, "text", 1 << 20):
            sets = [np.unique(shingle_hashes(lower_bytes(t).split(), words, seed)) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(list(map(_signed, sets)), pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["value", "shingles"])

    return docs.select("text").mapInArrow(batches, "value long, shingles binary")


def linked(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """For each set the first set that its links reach; pairs of one group are not compared again."""
    group = np.arange(len(sets))
    sizes = np.array([len(s) for s in sets])
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1] if sets else np.empty(0, np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.lexsort((owner, codes))  # the owners of each shingle stand together
    owners, starts = owner[order], np.searchsorted(codes[order], np.arange(codes.max() + 2 if len(codes) else 1))
    many, at = np.diff(starts), np.concatenate([[0], np.cumsum(sizes)])
    for i in range(1, len(sets)):
        mine = codes[at[i]:at[i + 1]]
        mine = mine[many[mine] > 1]
        common = np.zeros(len(sets), np.int64)
        for start in range(0, len(mine), 1024):
            c = mine[start:start + 1024]
            ends = np.cumsum(many[c])
            common += np.bincount(owners[np.arange(ends[-1]) + np.repeat(starts[c] + many[c] - ends, many[c])], minlength=len(sets))
        common = common[:i]
        hit = np.flatnonzero(common >= similarity * (sizes[i] + sizes[:i] - common) - 1e-9)
        for root in np.unique(group[hit]):
            low, high = sorted((root, group[i]))
            if low != high:
                group[group == high] = low
    return group


def _checked(members: DataFrame, similarity: float, tasks: int, block: int) -> DataFrame:
    """(a, b): links inside the clusters of rows (value, cluster, shingles)."""
    sized = members.join(F.broadcast(members.groupBy("cluster").count().where(F.col("count") > block)), "cluster", "left")
    parts = F.coalesce(F.ceil(F.col("count") / block), F.lit(1)).cast("int")
    mine = F.pmod(F.xxhash64("value"), F.col("parts")).cast("int")
    pairs = F.expr("transform(sequence(0, parts - 1), o -> struct(least(mine, o) AS i, greatest(mine, o) AS j))")
    dealt = sized.withColumn("parts", parts).withColumn("mine", mine).select("value", "cluster", "shingles", F.explode(pairs).alias("p"))
    dealt = dealt.select("value", "shingles", F.xxhash64("cluster", "p.i", "p.j").alias("part")).withColumn("task", F.pmod("part", F.lit(tasks)))

    def check(frame: pd.DataFrame) -> pd.DataFrame:
        out_a, out_b = [], []
        for _, rows in frame.sort_values(["part", "value"]).groupby("part", sort=False):
            values = rows["value"].to_numpy()
            group = linked([np.frombuffer(s, np.uint64) for s in rows["shingles"]], similarity)
            apart = group != np.arange(len(group))
            out_a.append(values[apart])
            out_b.append(values[group[apart]])
        return pd.DataFrame({"a": np.concatenate(out_a), "b": np.concatenate(out_b)})

    return dealt.groupBy("task").applyInPandas(lambda f: check(f[["value", "shingles", "part"]]), "a long, b long")


def similar_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = 0.8, words: int = 5, seed: int = 42,
    radius: int = 2, block: int = 256, task_rows: int = 500,
) -> DataFrame:
    """(doc_id, component_id): each row and the smallest id that links of ``similarity`` or more reach.

    Texts of fewer than ``words`` words are one shingle; texts without words, null ones among them, are equal. A row without an id
    keeps its component's smallest id, or null if no row of it has one. Repeated rows stay repeated. Other columns are
    not returned. An empty table gives an empty result.
    """
    body = F.col(f"`{text}`")
    narrow = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(F.col(f"`{doc_id}`"), body).alias("row_key"), body.alias("text"))
    prints = materialise(_signatures(narrow, words, seed), "near-signatures")
    classes = materialise(
        prints.groupBy("value").agg(F.min("doc_id").alias("first"), F.min("row_key").alias("row_key"), F.min("fingerprint").alias("fingerprint")), "near-classes"
    )
    by_band = prints.select("value", F.explode("bands").alias("band"))
    least = by_band.groupBy("band").agg(F.min("value").alias("b"), F.max("value").alias("top")).where("b <> top").select("band", "b")
    loose = by_band.join(least, "band").where("value <> b").select(F.col("value").alias("a"), "b")
    by_print = classes.groupBy("fingerprint").agg(F.min("value").alias("b"))
    loose = loose.unionByName(classes.join(by_print, "fingerprint").where("value <> b").select(F.col("value").alias("a"), "b"))
    bits = near_links(by_print.select(F.col("fingerprint").alias("value")), radius)
    ends = [by_print.select(F.col("fingerprint").alias(c), F.col("b").alias(f"v{c}")) for c in "ab"]
    loose = loose.unionByName(bits.join(ends[0], "a").join(ends[1], "b").select(F.col("va").alias("a"), F.col("vb").alias("b")))
    clusters = components(loose).select(F.col("node").alias("value"), F.col("component").alias("cluster"))
    wanted = materialise(clusters.join(classes, "value").select("value", "cluster", "row_key"), "near-clusters")
    texts = chosen_rows(narrow, wanted, "row_key", "left_semi")
    members = materialise(_shingles(texts, words, seed).join(wanted, "value").select("value", "cluster", "shingles").dropDuplicates(["value"]), "near-sets")
    links = _checked(members, similarity, max(1, -(-members.count() // task_rows)), block)
    nodes = components(links)
    grouped = classes.join(nodes, classes.value == nodes.node, "left").select("value", F.coalesce("component", "value").alias("component"), "first")
    smallest = grouped.groupBy("component").agg(F.min("first").alias("component_id"))
    by_value = materialise(grouped.join(smallest, "component").select("value", "component_id"), "near-groups")
    return prints.select("doc_id", "value").join(by_value, "value").select("doc_id", "component_id")
