"""Approximate nearest items: a stored inverted file over cells with product-quantised residuals.

The index of a corpus is a bucketed table. Every item lies in the cell of its nearest centre; what is left of its vector after the centre is cut
into parts, and each part is coded by the nearest of up to 256 entries of a codebook, a byte per part. Cells above ``part_rows`` items are
dealt into parts. Centres and codebooks are learned on a bounded sample; every item is indexed.

A search sends each user to the cells of its nearest centres. Few users meet the codes there by co-grouping on the bucketed
columns, so codes are not shuffled; a task sums looked-up part distances and hands on the best few items per user. The vectors of these
finalists are then fetched and compared exactly, so every reported distance is exact and only membership is approximate.

Many users travel to the index instead, in broadcasts of bounded size, and no finalist is listed. A first pass over the codes leaves a few
places of each user's looked-up distances per task, from which a bound follows below which the best finalists lie; a second pass compares
what lies below it exactly and hands on at most k items per user.
"""
from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from collections.abc import Iterator
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pulserank.functions.text import let
from pulserank.functions.vectors import squared_distance
from pulserank.operators.dedup import top_n
from pulserank.operators.neighbors import _finish, _matrix, _vectors
from pulserank.operators.sampling import bounded_sample
from pulserank.session import materialise, scratch_path

SAMPLE_ROWS = 20_000
_LOOKED_UP = 2_000_000  # distances one task holds at a time
_ROUTED = 4_000_000  # finalists of all tasks together up to which users are sent to their cells
_HELD = 32_768  # items a task holds at a time while all users pass by
_SHIPPED = 64 << 20  # bytes of user vectors in one broadcast
_SHOWN = 4  # items per task and user whose exact distances the first pass leaves


def _nearest(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    out = np.empty(len(rows), np.int64)
    step = max(1, 8_000_000 // max(1, len(centers)))
    squares = (centers * centers).sum(1)
    for at in range(0, len(rows), step):
        out[at:at + step] = (squares - 2 * rows[at:at + step] @ centers.T).argmin(1)
    return out


def kmeans(rows: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Centres of a bounded sample by Lloyd's rounds; a centre without rows moves to a row."""
    rng = np.random.default_rng(seed)
    rows = rows[rng.permutation(len(rows))]
    centers = np.unique(rows, axis=0)
    centers = centers[rng.permutation(len(centers))[:k]]
    for _ in range(rounds):
        near = _nearest(rows, centers)
        counts = np.bincount(near, minlength=len(centers))
        sums = np.zeros_like(centers)
        np.add.at(sums, near, rows)
        centers = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], rows[rng.integers(len(rows), size=len(centers))])
    return centers


@dataclass
class Codebook:
    """``centers`` of the cells, and per part of a vector its (start, end) and the entries of its book."""

    centers: np.ndarray
    cuts: list[tuple[int, int]]
    books: list[np.ndarray]

    def encode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cell = _nearest(vectors, self.centers)
        rest = vectors - self.centers[cell]
        return cell, np.stack([_nearest(rest[:, a:b], book) for (a, b), book in zip(self.cuts, self.books)], axis=1).astype(np.uint8)

    def tables(self, users: np.ndarray, cell: int) -> np.ndarray:
        """(users, parts, 256): squared distances of the users' parts to every entry, seen from a cell."""
        rest = users - self.centers[cell]
        out = np.full((len(users), len(self.cuts), 256), np.inf)
        for i, ((a, b), book) in enumerate(zip(self.cuts, self.books)):
            part = rest[:, a:b]
            out[:, i, : len(book)] = (part * part).sum(1)[:, None] + (book * book).sum(1) - 2 * part @ book.T
        return out


@dataclass
class Index:
    """A stored index: the bucketed table, the folder it lies in, its codebook and the parts of every cell."""

    table: str
    path: str
    book: Codebook
    parts: np.ndarray
    buckets: int


def train(corpus: DataFrame, cells: int, parts: int = 16, sample_rows: int = SAMPLE_ROWS, seed: int = 3) -> Codebook:
    sample = _matrix(bounded_sample(corpus.select("opportunity_id", "embedding"), ["opportunity_id"], sample_rows).toArrow()["embedding"], False)
    if not len(sample):
        raise ValueError("nothing to index")
    centers = kmeans(sample, max(1, cells), seed)
    rest = sample - centers[_nearest(sample, centers)]
    edges = np.linspace(0, sample.shape[1], min(parts, sample.shape[1]) + 1).astype(int)
    cuts = [(int(a), int(b)) for a, b in zip(edges, edges[1:])]
    return Codebook(centers, cuts, [kmeans(rest[:, a:b], 256, seed + i + 1) for i, (a, b) in enumerate(cuts)])


def build_index(
    corpus: DataFrame, cells: int | None = None, parts: int = 16, part_rows: int = 65_536, buckets: int | None = None, sample_rows: int = SAMPLE_ROWS, seed: int = 3,
    path: str | None = None,
) -> Index:
    """The index of (opportunity_id, embedding), written below ``path`` (by default the shared folder).

    ``cells`` is the square root of the number of items by default, 4096 at most; ``buckets`` the number of files. Rows without an id and
    vectors with null or infinite components are left out.
    """
    spark = corpus.sparkSession
    rows = _vectors(corpus, "opportunity_id")
    n = rows.count()
    book = train(rows, cells or max(1, min(4096, round(n ** 0.5))), parts, sample_rows, seed)
    shared = spark.sparkContext.broadcast(book)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell, codes = shared.value.encode(_matrix(batch["embedding"], False))
                columns = [*batch.columns, pa.array(cell.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["opportunity_id", "embedding", "cell", "code"])

    kind = dict(rows.dtypes)["embedding"]
    coded = materialise(rows.mapInArrow(code, f"opportunity_id string, embedding {kind}, cell int, code binary"), "ann-codes")
    sizes = coded.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(part_rows)).cast("int").alias("parts"))
    per_cell = np.zeros(len(book.centers), np.int64)
    for row in sizes.collect():  # at most one row per centre
        per_cell[row.cell] = row.parts
    dealt = coded.join(F.broadcast(sizes), "cell").withColumn("part", F.pmod(F.xxhash64("opportunity_id"), F.col("parts")).cast("int")).drop("parts")
    path = path or scratch_path(spark, "ann-index")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    _store(dealt, book, per_cell, path, buckets)
    return open_index(spark, path)


def _store(rows: DataFrame, book: Codebook, per_cell: np.ndarray, path: str, buckets: int) -> None:
    spark, name = rows.sparkSession, _free_name()
    rows.repartition(buckets, "cell", "part").write.format("parquet").option("path", f"{path}/items").bucketBy(buckets, "cell", "part").sortBy("cell", "part").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay
    vectors = [("center", 0, 0, book.centers), *(("book", a, b, v) for (a, b), v in zip(book.cuts, book.books))]
    parts = [(kind, a, b, i, int(per_cell[i]) if kind == "center" else 0, buckets, row.tolist()) for kind, a, b, v in vectors for i, row in enumerate(v)]
    spark.createDataFrame(parts, "kind string, start int, end int, place int, parts int, buckets int, vector array<double>").coalesce(1).write.parquet(f"{path}/book")


def _free_name() -> str:
    return f"ann_{uuid.uuid4().hex}"


def open_index(spark: SparkSession, path: str) -> Index:
    """A stored index, in this or another session. Its table is one more name in the catalog until :func:`close_index`."""
    rows = sorted(spark.read.parquet(f"{path}/book").collect(), key=lambda r: (r.kind, r.start, r.place))
    centers = [r for r in rows if r.kind == "center"]
    cuts = sorted({(r.start, r.end) for r in rows if r.kind == "book"})
    book = Codebook(np.array([r.vector for r in centers]), cuts, [np.array([r.vector for r in rows if r.kind == "book" and r.start == a]) for a, _ in cuts])
    name, buckets = _free_name(), centers[0].buckets
    columns = ", ".join(f"{n} {t}" for n, t in spark.read.parquet(f"{path}/items").dtypes)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (cell, part) SORTED BY (cell, part) INTO {buckets} BUCKETS LOCATION '{path}/items'")
    return Index(name, path, book, np.array([r.parts for r in centers]), buckets)


def close_index(spark: SparkSession, index: Index) -> None:
    """Takes the index' name out of the catalog; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {index.table}")


def _routes(users: DataFrame, index: Index, probes: int) -> DataFrame:
    """A row per user and part of each of the ``probes`` nearest cells that hold items."""
    shared = users.sparkSession.sparkContext.broadcast((index.book.centers, index.parts))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centers, parts = shared.value
        filled = np.flatnonzero(parts)
        squares = (centers[filled] ** 2).sum(1)
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch["embedding"], False)
            if vectors.shape[1] != centers.shape[1]:
                raise ValueError(f"dimension {centers.shape[1]} does not match {vectors.shape[1]}")
            near = filled[np.argsort(squares - 2 * vectors @ centers[filled].T, axis=1)[:, :probes]]
            each = parts[near]
            row = np.repeat(np.arange(len(vectors)), each.sum(1))
            cell = np.repeat(near.ravel(), each.ravel())
            starts = np.cumsum(each.ravel()) - each.ravel()
            part = np.arange(len(cell)) - np.repeat(starts, each.ravel())
            taken = batch.select(["user_id", "embedding"]).take(pa.array(row))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(cell.astype(np.int32)), pa.array(part.astype(np.int32))], ["user_id", "embedding", "cell", "part"])

    return users.mapInArrow(route, f"user_id string, embedding {dict(users.dtypes)['embedding']}, cell int, part int")


def finalists(users: DataFrame, index: Index, n: int, probes: int) -> DataFrame:
    """(user_id, opportunity_id, cell, part, distance): the best ``n`` items per user by looked-up distance."""
    shared = users.sparkSession.sparkContext.broadcast(index.book)

    def look_up(key: tuple, asking: pa.Table, held: pa.Table) -> pa.Table:
        book, cell, part = shared.value, key[0].as_py(), key[1].as_py()
        out = {"user_id": [], "opportunity_id": [], "distance": []}
        if len(asking) and len(held):
            codes = np.frombuffer(b"".join(held["code"].to_pylist()), np.uint8).reshape(len(held), -1)
            vectors, step = _matrix(asking["embedding"], False), max(1, _LOOKED_UP // len(held))
            for at in range(0, len(vectors), step):
                tables = book.tables(vectors[at:at + step], cell)
                distance = sum(tables[:, i, :][:, codes[:, i]] for i in range(codes.shape[1]))
                best = np.argpartition(distance, n - 1, axis=1)[:, :n] if len(held) > n else np.broadcast_to(np.arange(len(held)), distance.shape)
                rows = np.repeat(np.arange(len(best)), best.shape[1])
                out["user_id"].append(asking["user_id"].slice(at, step).combine_chunks().take(pa.array(rows)))
                out["opportunity_id"].append(held["opportunity_id"].combine_chunks().take(pa.array(best.ravel())))
                out["distance"].append(pa.array(np.take_along_axis(distance, best, 1).ravel()))
        kinds = {"user_id": pa.string(), "opportunity_id": pa.string(), "distance": pa.float64()}
        columns = {k: pa.chunked_array(out[k], t) for k, t in kinds.items()}
        size = len(columns["distance"])
        return pa.table({**columns, "cell": pa.array([cell] * size, pa.int32()), "part": pa.array([part] * size, pa.int32())})

    codes = users.sparkSession.table(index.table).select("opportunity_id", "code", "cell", "part")
    found = _routes(users, index, probes).groupBy("cell", "part").cogroup(codes.groupBy("cell", "part")).applyInArrow(
        look_up, "user_id string, opportunity_id string, distance double, cell int, part int"
    )
    return top_n(found, ["user_id"], [F.asc("distance"), F.asc("opportunity_id")], n)


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of a task in tables of about ``_HELD`` rows, each sorted by cell."""
    waiting, rows = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, _HELD):
            waiting.append(batch.slice(at, _HELD))
            rows += waiting[-1].num_rows
            if rows >= _HELD:
                yield pa.Table.from_batches(waiting).sort_by("cell")
                waiting, rows = [], 0
    if rows:
        yield pa.Table.from_batches(waiting).sort_by("cell")


def _looked_up(book: Codebook, filled: np.ndarray, probes: int, held: pa.Table, users: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Blocks of users with the looked-up distances to all ``held`` items; infinite where a user does not ask in the item's cell.

    The sum of the part distances of a code is the distance to the vector that the code stands for.
    """
    cell = held["cell"].to_numpy().astype(np.int64)
    codes = np.frombuffer(b"".join(held["code"].to_pylist()), np.uint8).reshape(len(cell), -1)
    means = book.centers[cell]
    for i, ((a, b), entries) in enumerate(zip(book.cuts, book.books)):
        means[:, a:b] += entries[codes[:, i]]
    squares = (means * means).sum(1)
    right = np.hstack([means, np.ones((len(means), 1)), squares[:, None]]).T
    runs = np.flatnonzero(np.diff(cell, prepend=-1))
    centers = book.centers[filled]
    norms, column = (centers * centers).sum(1), np.searchsorted(filled, cell[runs])
    step = max(1, _LOOKED_UP // max(len(cell), len(filled)))
    for at in range(0, len(users), step):
        some = users[at:at + step]
        own = (some * some).sum(1)
        left, asked = np.hstack([-2 * some, own[:, None], np.ones((len(some), 1))]), None
        if probes < len(filled):
            far = norms - 2 * some @ centers.T
            last = np.partition(far, probes - 1, axis=1)[:, probes - 1:probes]
            asked = far <= last + 1e-9 * (1 + np.abs(last) + own[:, None])
        if asked is None or asked.mean() > 0.5:
            out = left @ right
            if asked is not None:
                for start, stop, c in zip(runs, [*runs[1:], len(cell)], column):
                    out[~asked[:, c], start:stop] = np.inf
        else:
            out = np.full((len(some), len(cell)), np.inf)
            for start, stop, c in zip(runs, [*runs[1:], len(cell)], column):
                who = np.flatnonzero(asked[:, c])
                if len(who):
                    out[who, start:stop] = left[who] @ right[:, start:stop]
        yield slice(at, at + len(some)), out


def _slack(distance: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """``distance`` and what two ways to compute it may differ by."""
    return distance + 1e-9 * (1 + np.abs(np.where(np.isfinite(distance), distance, 0.0)) + squares)


def _scan(index: Index, spark: SparkSession, columns: list[str], schema: str, probes: int, shared: tuple, work) -> DataFrame:
    """``work(held, place, distance, *shared)`` for every block of the users ``shared[0]`` and the items that a task holds."""
    sent = spark.sparkContext.broadcast((index.book, np.flatnonzero(index.parts), shared))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, filled, shared = sent.value
        for held in _held(batches):
            for place, distance in _looked_up(book, filled, probes, held, shared[0]):
                yield work(held, place, distance, *shared)

    return spark.table(index.table).select("cell", "code", *columns).mapInArrow(run, schema)


def _differences(users: np.ndarray, items: np.ndarray) -> np.ndarray:
    return ((users - items) ** 2).sum(-1)


def _bounds(index: Index, spark: SparkSession, users: np.ndarray, n: int, k: int, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """Per user a looked-up distance that at least ``n`` items reach, and an exact one that ``k`` of these reach; infinite if there are fewer.

    A task leaves the looked-up distances at the places 1, 4, 16 and so on up to ``n``; each stands for as many items as lie between it and the place
    before. Of its ``_SHOWN`` nearest items it leaves the exact distances too.
    """
    ranks = sorted({*(4 ** i for i in range(32) if 4 ** i < n), n})

    def work(held, place, distance, users):
        size = distance.shape[1]
        at = np.array([r for r in ranks if r < size] + ([size] if size <= n else []))
        reached, rest = np.empty((len(distance), len(at))), distance
        for i in range(len(at) - 1, -1, -1):
            rest = np.partition(rest, at[i] - 1, axis=1)[:, :at[i]]
            reached[:, i] = rest[:, -1]
        shown = min(_SHOWN, size)
        near = np.argpartition(distance, shown - 1, axis=1)[:, :shown]
        vectors = _matrix(held["embedding"].take(pa.array(near.ravel())), False).reshape(len(near), shown, -1)
        exact = _differences(users[place][:, None, :], vectors)
        lists = [reached, np.broadcast_to(np.diff(at, prepend=0).astype(float), reached.shape), np.take_along_axis(distance, near, 1), exact]
        return pa.RecordBatch.from_arrays([pa.array(np.arange(place.start, place.stop, dtype=np.int32)), *map(_lists, lists)], ["place", "reached", "items", "near", "exact"])

    kinds = "place int, reached array<double>, items array<double>, near array<double>, exact array<double>"
    left = _scan(index, spark, ["embedding"], kinds, probes, (users,), work)
    steps, pairs = (F.array_sort(F.flatten(F.collect_list(F.arrays_zip(*x)))) for x in (("reached", "items"), ("exact", "near")))
    start = F.struct(F.lit(0.0).alias("items"), F.lit(float("inf")).alias("bound"))
    bound = F.aggregate(
        "steps", start, lambda s, x: F.struct((s["items"] + x["items"]).alias("items"), F.when(s["items"] < n, x["reached"]).otherwise(s["bound"]).alias("bound")),
        lambda s: F.when(s["items"] < n, float("inf")).otherwise(s["bound"]),
    )
    found = left.groupBy("place").agg(steps.alias("steps"), pairs.alias("pairs")).select("place", "pairs", bound.alias("bound"))
    inside = F.filter("pairs", lambda p: p["near"] <= F.col("bound"))
    rows = found.select("place", "bound", F.coalesce(F.get(inside, F.lit(k - 1))["exact"], F.lit(float("inf"))).alias("exact")).toArrow()
    looked, exact = np.full(len(users), np.inf), np.full(len(users), np.inf)
    looked[rows["place"].to_numpy()], exact[rows["place"].to_numpy()] = rows["bound"].to_numpy(), rows["exact"].to_numpy()
    return looked, exact


def _lists(rows: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), pa.array(np.ascontiguousarray(rows).ravel()))


def _search_all(left: DataFrame, index: Index, n: int, k: int, probes: int) -> DataFrame:
    """The best ``k`` by exact distance of at least ``n`` finalists per user, found in two passes over the index."""
    spark, table = left.sparkSession, left.toArrow()
    users = _matrix(table["embedding"], False)
    if users.shape[1] != index.book.centers.shape[1]:
        raise ValueError(f"dimension {index.book.centers.shape[1]} does not match {users.shape[1]}")
    looked, exact = _bounds(index, spark, users, n, k, probes)

    def work(held, place, distance, users, names, looked, exact):
        some, items = users[place], _matrix(held["embedding"], False)
        own, squares = (some * some).sum(1), (items * items).sum(1)
        slack = own + squares.max()
        hit = distance <= np.minimum(_slack(looked[place], slack), np.finfo(float).max)[:, None]
        rough = np.hstack([-2 * some, own[:, None], np.ones((len(some), 1))]) @ np.hstack([items, np.ones((len(items), 1)), squares[:, None]]).T
        hit &= rough <= _slack(exact[place], slack)[:, None]
        many = np.flatnonzero(hit.sum(1) > 2 * k)
        if len(many):
            part = np.where(hit[many], rough[many], np.inf)
            hit[many] &= part <= _slack(np.partition(part, k - 1, axis=1)[:, k - 1], slack[many])[:, None]
        user, item = np.divmod(np.flatnonzero(hit), hit.shape[1])
        true = np.concatenate([np.zeros(0), *(_differences(some[user[i:i + 50_000]], items[item[i:i + 50_000]]) for i in range(0, len(user), 50_000))])
        ids = held["opportunity_id"].take(pa.array(item))
        order = np.lexsort((np.array(ids.to_pylist(), dtype=str), true, user))
        user, true = user[order], true[order]
        first = np.arange(len(user)) - np.searchsorted(user, user) < k
        columns = [names.take(pa.array(user[first] + place.start)), ids.take(pa.array(order[first])), pa.array(true[first])]
        return pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns], ["user_id", "opportunity_id", "distance"])

    shared = (users, table["user_id"].combine_chunks(), looked, exact)
    return _finish(_scan(index, spark, ["opportunity_id", "embedding"], "user_id string, opportunity_id string, distance double", probes, shared, work), k, "l2")


def search(queries: DataFrame, index: Index, k: int, probes: int | None = None, refine: int = 10, max_users: int = 100_000) -> DataFrame:
    """Approximate :func:`pulserank.operators.neighbors.knn` by squared distance, with exact distances.

    A user looks into the ``probes`` nearest cells (by default an eighth of them, 8 at least), and at least the best ``refine * k`` items by code are compared
    exactly. Users ask in rounds of about ``max_users``. If the tasks of a round would list more than ``_ROUTED`` finalists, the users of the round, ``_SHIPPED``
    bytes of vectors at most, travel to the index and meet it in two passes.
    """
    spark = queries.sparkSession
    left = materialise(_vectors(queries, "user_id"), "ann-users")
    probes = probes or max(8, len(index.book.centers) // 8)
    every = None
    for users, whole in _rounds(left, index, max_users, probes, refine * k):
        if whole:
            found = _search_all(users, index, refine * k, k, probes)
        else:
            best = finalists(users, index, refine * k, probes).select("user_id", "opportunity_id", "cell", "part")
            vectors = spark.table(index.table).select("cell", "part", "opportunity_id", F.col("embedding").alias("vector"))
            pairs = best.join(vectors, ["cell", "part", "opportunity_id"]).join(users, "user_id")
            exact = pairs.select("user_id", "opportunity_id", squared_distance("embedding", "vector").alias("distance"))
            found = _finish(exact, k, "l2")
        found = materialise(found, "ann-found")
        every = found if every is None else every.unionByName(found)
    return every


def _rounds(users: DataFrame, index: Index, max_users: int, probes: int, n: int) -> list[tuple[DataFrame, bool]]:
    """The users in rounds, and whether a round's finalists are too many to be listed."""
    count, items = users.count(), users.sparkSession.table(index.table).count()
    whole = min(count, max_users) * min(items, probes * n) > _ROUTED
    if whole:
        max_users = max(1, min(max_users, _SHIPPED // (8 * index.book.centers.shape[1])))
    n = -(-count // max_users) or 1
    return [(users if n == 1 else users.where(F.pmod(F.xxhash64("user_id"), F.lit(n)) == i), whole) for i in range(n)]


def tune(queries: DataFrame, index: Index, exact: DataFrame, k: int, target: float = 0.95, max_users: int = 100_000) -> tuple[int, int]:
    """(probes, refine) with which each of ``queries`` finds at least ``target`` of its exact neighbours.

    ``exact`` are their true neighbours (user_id, opportunity_id). What holds for a sample need not hold for a user outside it, so pass all users
    if each of them must reach the target. The number of cells follows from the places of the neighbours' cells; ``refine`` grows by four until the
    finalists hold enough of them, at most to all items. Where finalists are too many to be listed, one pass over the codes counts for every user the items
    that are looked up no farther than enough of its neighbours.
    """
    spark = queries.sparkSession
    users, items = _vectors(queries, "user_id"), spark.table(index.table).select("opportunity_id", "cell", "code")
    wanted = exact.select("user_id", "opportunity_id").join(items, "opportunity_id").groupBy("user_id").agg(F.collect_list("cell").alias("cells"), F.collect_list("code").alias("codes"))
    sent = spark.sparkContext.broadcast((index.book, np.flatnonzero(index.parts)))

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per user the places of its neighbours' cells and their looked-up distances."""
        book, filled = sent.value
        centers = book.centers[filled]
        squares = (centers ** 2).sum(1)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                vectors, sizes = _matrix(batch["embedding"], False), pc.list_value_length(batch["cells"]).to_numpy()
                user, cell = np.repeat(np.arange(len(vectors)), sizes), batch["cells"].flatten().to_numpy().astype(np.int64)
                codes = np.frombuffer(b"".join(batch["codes"].flatten().to_pylist()), np.uint8).reshape(len(cell), -1)
                places = np.argsort(np.argsort(squares - 2 * vectors @ centers.T, axis=1), axis=1)
                rest, distance = vectors[user] - book.centers[cell], np.zeros(len(cell))
                for i, ((a, b), entries) in enumerate(zip(book.cuts, book.books)):
                    distance += _differences(rest[:, a:b], entries[codes[:, i]])
                starts = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                near = pa.ListArray.from_arrays(starts, pa.array(places[user, np.searchsorted(filled, cell)].astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch["user_id"], batch["embedding"], near, pa.ListArray.from_arrays(starts, pa.array(distance))], ["user_id", "embedding", "places", "looked"])

    kind = dict(users.dtypes)["embedding"]
    own = materialise(
        wanted.join(users, "user_id").select("user_id", "embedding", "cells", "codes").mapInArrow(neighbours, f"user_id string, embedding {kind}, places array<int>, looked array<double>"),
        "ann-own",
    )

    def enough(values: Column) -> Column:
        return let(values, lambda v: F.element_at(F.array_sort(v), F.ceil(F.lit(target) * F.size(v)).cast("int")))

    last = own.groupBy("user_id").agg(F.flatten(F.collect_list("places")).alias("places")).agg(F.max(enough(F.col("places")))).first()[0]
    if last is None:
        return 1, 1
    probes, n_items, refine = last + 1, items.count(), 4

    def worst(part: DataFrame) -> float:
        found = finalists(part, index, refine * k, probes).select("user_id", "opportunity_id", F.lit(1).alias("hit"))
        hits = exact.join(part.select("user_id"), "user_id", "left_semi").join(found, ["user_id", "opportunity_id"], "left")
        share = hits.groupBy("user_id").agg((F.count("hit") / F.count("*")).alias("r")).agg(F.min("r")).first()[0]
        return 1.0 if share is None else share

    while refine * k < n_items:
        rounds = _rounds(users, index, max_users, probes, refine * k)
        if any(whole for _, whole in rounds):
            break
        if all(worst(part) >= target for part, _ in rounds):
            return probes, refine
        refine *= 4
    if refine * k >= n_items:
        return probes, refine
    inside = F.zip_with("places", "looked", lambda p, d: F.when(p < probes, d).otherwise(float("inf")))
    # Rows of one user list the same neighbours; a neighbour is as far as from the nearest of them.
    nearest = F.transform(F.col("lists")[0], lambda d, i: F.array_min(F.transform("lists", lambda x: F.get(x, i))))
    limits = own.groupBy("user_id").agg(F.collect_list(inside).alias("lists")).select("user_id", enough(nearest).alias("limit"))
    asking = own.select("user_id", "embedding").join(limits, "user_id")

    def count(held, place, distance, users, limit):
        near = distance <= _slack(limit[place], (users[place] ** 2).sum(1))[:, None]
        return pa.RecordBatch.from_arrays([pa.array(np.arange(place.start, place.stop, dtype=np.int32)), pa.array(near.sum(1))], ["place", "items"])

    needed = 0
    for part, _ in _rounds(asking, index, min(max_users, max(1, _SHIPPED // (8 * index.book.centers.shape[1]))), probes, n_items):
        table = part.toArrow()
        if len(table):
            counted = _scan(index, spark, [], "place int, items bigint", probes, (_matrix(table["embedding"], False), table["limit"].to_numpy()), count)
            rows = counted.groupBy("place").agg(F.sum("items").alias("items")).toArrow()
            each = pa.table({"user_id": table["user_id"].take(rows["place"]), "items": rows["items"]}).group_by("user_id").aggregate([("items", "sum")])
            needed = max(needed, pc.max(each["items_sum"]).as_py())
    while refine * k < min(n_items, needed):
        refine *= 4
    return probes, refine
