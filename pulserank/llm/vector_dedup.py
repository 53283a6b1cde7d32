"""Near-duplicate vectors: spherical k-means cells, cosine products in blocks, one vector per group.

Equal vectors of a label are one class. Spherical k-means (fitted on a bounded sample of the classes)
gives each class a home cell. Two unit vectors with cosine t are at most sqrt(2 - 2t) apart, so a class may have a
link into another cell only if it lies that near to the plane between both centres; there it asks as
well. So no link is lost and only classes near borders are copied. In a cell, only classes of one label
are compared, as products of blocks of at most ``block_rows`` rows: a large cell or label is a grid
of blocks, never a task. Blocks report numbers of links and one representative per local group,
so a dense group costs rows by its members, not by its pairs.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F, types as T

from pulserank.llm.common import materialise
from pulserank.llm.components import components

SAMPLE_ROWS, CELL_ROWS, MAX_CELLS = 20_000, 2_000, 1_024


def usable(vector: Column) -> Column:
    """Neither null, empty nor zero, and all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(column: pa.Array) -> np.ndarray:
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # no over- or underflow of squares
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def centres(classes: DataFrame, rows: int, sample_rows: int = SAMPLE_ROWS, cell_rows: int = CELL_ROWS) -> np.ndarray:
    """Unit centres of spherical k-means over the ``sample_rows`` classes with the smallest hash of their id."""
    cells = max(1, min(MAX_CELLS, rows // cell_rows))
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    sample = classes.orderBy(F.xxhash64("node")).limit(sample_rows).withColumn("__length", length)
    sample = sample.where(F.col("__length").between(1e-100, 1e100))
    unit = sample.select(array_to_vector(F.transform("vector", lambda x: x.cast("double") / F.col("__length"))).alias("features"))
    if cells == 1 or unit.isEmpty():
        return np.zeros((0, 0))
    model = KMeans(k=cells, distanceMeasure="cosine", maxIter=8, initMode="random", seed=11).fit(unit)
    found = np.array(model.clusterCenters())
    return found / np.linalg.norm(found, axis=1, keepdims=True)


def assigned(classes: DataFrame, centre: np.ndarray, cosine: float) -> DataFrame:
    """``classes`` with ``cell`` and ``home``: a row for the home cell and one for each cell that is near."""
    reach = np.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-9

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apart = np.sqrt(np.maximum(2 - 2 * centre @ centre.T, 0)) if len(centre) else None
        for batch in rows:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                if not len(centre):
                    cell, which = np.zeros(part.num_rows, np.int32), np.arange(part.num_rows)
                    home = np.ones(part.num_rows, bool)
                else:
                    product = _unit(part.column("vector")) @ centre.T
                    best = product.argmax(axis=1)
                    gap = product[np.arange(len(best)), best][:, None] - product
                    which, cell = np.nonzero(gap <= reach * apart[best])
                    home = cell == best[which]
                    cell = cell.astype(np.int32)
                picked = part.take(pa.array(which))
                yield pa.RecordBatch.from_arrays([*picked.columns, pa.array(cell, pa.int32()), pa.array(home)], [*part.schema.names, "cell", "home"])

    fields = [*classes.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("home", T.BooleanType())]
    return classes.mapInArrow(batches, T.StructType(fields))


def _tiles(rows: DataFrame, block_rows: int) -> DataFrame:
    """Rows of each (label, cell) dealt to a grid: all rows ask (side 0), those at home answer (side 1)."""
    group = ["label", "cell"]
    size = rows.groupBy(*group).agg(F.count("*").alias("q"), F.count(F.when(F.col("home"), 1)).alias("t")).where("t > 0 AND q > 1")
    blocks = size.select(*group, F.ceil(F.col("q") / block_rows).alias("nq"), F.ceil(F.col("t") / block_rows).alias("nt"))
    dealt = rows.join(blocks, group)
    code = F.xxhash64("node")

    def side(number: int, own: str, other: str, names: tuple[str, str]) -> DataFrame:
        mine = dealt if number == 0 else dealt.where("home")
        return mine.select(
            *group, "node", "n", "vector", F.pmod(code, own).alias(names[0]), F.lit(number).alias("side"),
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other) - 1)).alias(names[1]),
        )

    # by tile: both sides are partitioned by (label, cell), which would keep a large cell's tiles in one task
    return side(0, "nq", "nt", ("qb", "tb")).unionByName(side(1, "nt", "nq", ("tb", "qb"))).repartition(*group, "qb", "tb")


def _tile_links(table: pa.Table, cosine: float) -> pa.Table:
    side = table.column("side").to_numpy()
    node, n = table.column("node").to_numpy(), table.column("n").to_numpy()
    unit = _unit(table.column("vector").combine_chunks())
    ask, answer = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    hit = unit[ask] @ unit[answer].T >= cosine
    hit &= node[ask][:, None] != node[answer][None, :]
    links = hit @ n[answer]
    i, j = np.nonzero(hit)
    names, place = np.unique(np.concatenate([node[ask], node[answer]]), return_inverse=True)
    a, b = place[:len(ask)][i], place[len(ask):][j]
    group = np.arange(len(names))
    while len(a):
        low, high = np.minimum(group[a], group[b]), np.maximum(group[a], group[b])
        differ = low != high
        if not differ.any():
            break
        np.minimum.at(group, high[differ], low[differ])
        while (group[group] != group).any():
            group = group[group]
    counts = np.zeros(len(names), np.int64)
    np.add.at(counts, place[:len(ask)], links)
    held = (counts > 0) | (group != np.arange(len(names)))
    return pa.table({"node": names[held], "links": counts[held], "root": names[group[held]]})


def vector_groups(
    rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = 0.98, block_rows: int = 2048,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept): a row per row of ``rows``.

    Rows with equal labels whose cosine is at least ``cosine`` are linked. A null label or id, and vectors that are null,
    empty, zero or hold null or non-finite components link with nothing; vectors of different lengths are not compared.
    ``component_id`` is the smallest id that links reach; ``kept`` marks one row per group (rows without an id stay).
    Repeated rows link like other equal rows. Other columns are ignored. An empty table gives an empty result.
    """
    own = rows.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{vector}`").alias("vector"), F.col(f"`{label}`").alias("label"))
    good = usable(F.col("vector")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    valid = own.where(good)
    classes = materialise(valid.groupBy("label", "vector").agg(F.count("*").alias("n"), F.min("vec_id").alias("node")), "vector-classes")
    found = None
    for size, in classes.select(F.size("vector")).distinct().collect():
        part = classes.where(F.size("vector") == size)
        near = materialise(assigned(part, centres(part, part.count()), cosine), "vector-cells")
        tiles = _tiles(near, block_rows).groupBy("label", "cell", "qb", "tb")
        links = tiles.applyInArrow(lambda t: _tile_links(t, cosine), "node long, links long, root long")
        found = links if found is None else found.unionByName(links)
    if found is None:
        found = rows.sparkSession.createDataFrame([], "node long, links long, root long")
    found = materialise(found, "vector-links")
    groups = components(found.select("node", "root"), "node", "root")
    known = found.groupBy("node").agg(F.sum("links").alias("links")).join(groups, "node", "left").select("node", "links", "component")
    copies = classes.where("n > 1").select(F.col("label").alias("__label"), F.col("vector").alias("__vector"), F.col("node").alias("first"), "n")
    same = good & (F.col("label") == F.col("__label")) & (F.col("vector") == F.col("__vector"))
    named = own.join(copies, same, "left").select("vec_id", F.coalesce("first", "vec_id").alias("first"), F.coalesce("n", F.lit(1)).alias("n"), good.alias("good"))
    joined = named.join(known, (F.col("first") == F.col("node")) & F.col("good"), "left")
    component = F.coalesce("component", "first")
    return joined.select(
        "vec_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
