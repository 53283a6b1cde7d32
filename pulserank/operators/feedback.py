"""Learning from feedback: user vectors, preference vectors, grades."""
from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from pulserank.functions import constants as K
from pulserank.functions.vectors import blend, unit
from pulserank.operators.analytics import pivot_counts
from pulserank.operators.dedup import top_n
from pulserank.operators.neighbors import knn, scan_pairs
from pulserank.session import materialise


def apply_feedback(vector: np.ndarray, item: np.ndarray, own: float, other: float) -> np.ndarray:
    """One update step: weighted sum, back to length one."""
    moved = own * vector + other * item
    length = np.sqrt((moved * moved).sum())
    return moved / length if length > 0 else moved


def feedback_steps(events: DataFrame, items: DataFrame, weights: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Events with the vector of their item and the two weights; other actions and unknown items drop out."""
    table = F.create_map(*[x for a, (u, i) in weights.items() for x in (
        F.lit(a), F.struct(F.lit(float(u)).alias("own"), F.lit(float(i)).alias("other"))
    )])
    return (
        events.where(F.col("action").isin(*weights))
        .join(items.select("opportunity_id", F.col("embedding").alias("item")), "opportunity_id")
        .withColumn("_w", table[F.col("action")])
        .select("user_id", "ts", "event_id", F.col("_w.own").alias("own"), F.col("_w.other").alias("other"), "item")
    )


def fold(
    users: DataFrame,
    events: DataFrame,
    items: DataFrame,
    weights: Mapping[str, tuple[float, float]] = K.FEEDBACK_WEIGHTS,
    normalize: bool = True,
) -> DataFrame:
    """User vectors after all feedback, in order of (ts, event_id): ``user_id, embedding, events``.

    Each step scales back to length one, so the steps of one user cannot be reordered or
    combined.  Users are independent.  The rows of a partition are sorted by user and
    time and read as a stream that holds a single vector: the longest history needs no
    more memory than the shortest.
    """
    start = unit("embedding") if normalize else F.col("embedding").cast("array<double>")
    none = F.lit(None)
    first = users.select(
        "user_id", F.lit(0).alias("kind"), none.cast("timestamp").alias("ts"), none.cast("bigint").alias("event_id"),
        F.lit(0.0).alias("own"), F.lit(0.0).alias("other"), start.alias("v"),
    )
    vector = unit("embedding") if normalize else F.col("embedding").cast("array<double>")
    steps = feedback_steps(events, items.select("opportunity_id", vector.alias("embedding")), weights)
    steps = steps.select(
        "user_id", F.lit(1).alias("kind"), F.col("ts").cast("timestamp"), F.col("event_id").cast("bigint"), "own", "other",
        F.col("item").alias("v"),
    )
    ordered = first.unionByName(steps).repartition("user_id").sortWithinPartitions("user_id", "kind", "ts", "event_id")
    return ordered.select("user_id", "kind", "own", "other", "v").mapInArrow(
        _fold_stream, "user_id string, embedding array<double>, events bigint"
    )


def _fold_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    user, vector, seen = None, None, 0
    schema = pa.schema([("user_id", pa.string()), ("embedding", pa.list_(pa.float64())), ("events", pa.int64())])

    def emit(rows):
        names, vectors, numbers = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([v.tolist() for v in vectors], pa.list_(pa.float64())), pa.array(numbers, pa.int64())],
            schema=schema,
        )

    for batch in batches:
        done = []
        names, kinds = batch["user_id"].to_pylist(), batch["kind"].to_pylist()
        own, other = batch["own"].to_pylist(), batch["other"].to_pylist()
        offsets = batch["v"].offsets.to_numpy()
        values = batch["v"].values.to_numpy(zero_copy_only=False)
        for i, name in enumerate(names):
            item = values[offsets[i] : offsets[i + 1]]
            if kinds[i] == 0:
                if vector is not None:
                    done.append((user, vector, seen))
                user, vector, seen = name, item.copy(), 0
            elif name == user and vector is not None:
                vector = apply_feedback(vector, item, own[i], other[i])
                seen += 1
        if done:
            yield emit(done)
    if vector is not None:
        yield emit([(user, vector, seen)])


def centroid(df: DataFrame, by: str | Sequence[str], column: str = "embedding") -> DataFrame:
    """Mean vector per group; partial sums are combined on the map side."""
    keys = [by] if isinstance(by, str) else list(by)
    mean = Summarizer.mean(array_to_vector(F.col(column).cast("array<double>")))
    return df.groupBy(*keys).agg(mean.alias("_m")).select(*keys, vector_to_array("_m").alias("embedding"))


def preference(
    users: DataFrame,
    items: DataFrame,
    shift: float = 0.75,
    seed: int = 42,
    skip: int = 25,
    stop: int = 125,
    sample: int = 25,
) -> DataFrame:
    """Preference vector near each user: a blend with the centroid of items the user is fairly close to.

    Of the items ranked ``skip + 1`` to ``stop`` by inner product a seeded hash picks
    ``sample``.  Fewer than ``skip + 1`` items leave the last one as the pool.
    """
    near = knn(users, items, stop, metric="dot")
    size = F.count("*").over(Window.partitionBy("user_id"))
    pool = near.withColumn("_n", size).where(F.col("retrieval_rank") > F.least(F.lit(skip), F.col("_n") - 1))
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("user_id"), F.col("opportunity_id")))
    chosen = top_n(pool, ["user_id"], [order.asc(), F.asc("opportunity_id")], sample, rank="_place")
    vectors = items.select(F.col("opportunity_id").cast("string").alias("opportunity_id"), "embedding")
    middle = centroid(chosen.select("user_id", "opportunity_id").join(vectors, "opportunity_id"), "user_id")
    base = users.select(F.col("user_id").cast("string").alias("user_id"), F.col("embedding").alias("_u"))
    mixed = blend("_u", 1.0 - shift, unit("embedding"), shift)
    return base.join(middle, "user_id").select("user_id", unit(mixed).alias("embedding"))


class _Histogram:
    """Counts of similarity bins per user in one task."""

    def __init__(self, names: list[str], queries: np.ndarray, bins: int):
        self.names, self.queries, self.bins = names, queries, bins
        self.counts = np.zeros((len(names), bins), dtype=np.int64)

    def add(self, items: np.ndarray, ids: np.ndarray) -> None:
        for similarity, user in _similarities(self.queries, items):
            self.counts[user] += np.bincount(_bin(similarity, self.bins), minlength=self.bins)

    def table(self) -> pa.Table:
        user, place = np.nonzero(self.counts)
        return pa.table({
            "user_id": pa.array([self.names[i] for i in user], pa.string()),
            "bin": pa.array(place, pa.int32()),
            "n": pa.array(self.counts[user, place], pa.int64()),
        })


class _BinValues:
    """Distinct similarities, with their counts, inside the bins that hold a wanted rank."""

    def __init__(self, names: list[str], queries: np.ndarray, wanted: list[list[int]], bins: int):
        self.names, self.queries, self.bins = names, queries, bins
        self.wanted = [np.isin(np.arange(bins), places) for places in wanted]
        self.found: list[list[np.ndarray]] = [[] for _ in names]

    def add(self, items: np.ndarray, ids: np.ndarray) -> None:
        for similarity, user in _similarities(self.queries, items):
            self.found[user].append(similarity[self.wanted[user][_bin(similarity, self.bins)]])

    def table(self) -> pa.Table:
        users, values, counts = [], [], []
        for name, parts in zip(self.names, self.found):
            value, n = np.unique(np.concatenate(parts) if parts else np.zeros(0), return_counts=True)
            users += [name] * len(value)
            values.append(value)
            counts.append(n)
        return pa.table({
            "user_id": pa.array(users, pa.string()),
            "value": pa.array(np.concatenate(values) if values else np.zeros(0), pa.float64()),
            "n": pa.array(np.concatenate(counts) if counts else np.zeros(0, dtype=np.int64), pa.int64()),
        })


def _similarities(queries: np.ndarray, items: np.ndarray):
    # Row by row: both passes must see the very same floating point values.
    for user in range(len(queries)):
        yield (items * queries[user]).sum(axis=1), user


def _bin(similarity: np.ndarray, bins: int) -> np.ndarray:
    return np.clip(((similarity + 1.0) * (bins / 2.0)).astype(np.int64), 0, bins - 1)


def similarity_cutoffs(
    users: DataFrame, items: DataFrame, probabilities: Sequence[float] = tuple(p for _, p in K.QUANTILE_GRADES), bins: int = 4096, **scan
) -> DataFrame:
    """Exact quantiles of the inner product of every user with all items: ``user_id, cutoffs``.

    The pairs are never listed.  A first pass counts similarities into bins, a second
    one returns the values of the few bins that hold a wanted rank; the rank is then
    found inside them.  Linear interpolation between neighbouring ranks.
    """
    scan.setdefault("max_users", max(1, (64 << 20) // (8 * bins)))  # bin counts of one task: 64 MB
    hist = scan_pairs(users, items, partial(_Histogram, bins=bins), "user_id string, bin int, n bigint", **scan)
    hist = hist.groupBy("user_id", "bin").agg(F.sum("n").alias("n"))
    by_user = Window.partitionBy("user_id")
    up_to = F.sum("n").over(by_user.orderBy("bin"))
    bounds = hist.withColumns({"last": up_to, "total": F.sum("n").over(by_user)}).withColumn("first", F.col("last") - F.col("n"))
    ranks = [(F.col("total") - 1) * F.lit(float(p)) for p in probabilities]
    holds = F.lit(False)
    for rank in ranks:
        for edge in (F.floor(rank), F.ceil(rank)):
            holds = holds | ((edge >= F.col("first")) & (edge < F.col("last")))
    # At most two bins per user and quantile; written once because both sides below read them.
    offsets = materialise(bounds.where(holds).select("user_id", "bin", "first", "total"), "cutoff-bins")
    places = offsets.groupBy("user_id").agg(F.collect_set("bin").alias("places"))
    asked = users.select(F.col("user_id").cast("string").alias("user_id"), "embedding").join(places, "user_id")
    values = scan_pairs(
        asked, items, partial(_BinValues, bins=bins), "user_id string, value double, n bigint", carry="places", **scan
    )
    bin_of = F.least(F.greatest(F.floor((F.col("value") + 1.0) * (bins / 2.0)), F.lit(0)), F.lit(bins - 1)).cast("int")
    inside = Window.partitionBy("user_id", "bin").orderBy("value")
    placed = (
        values.groupBy("user_id", "value").agg(F.sum("n").alias("n"))
        .withColumn("bin", bin_of)
        .join(offsets, ["user_id", "bin"])
        .withColumn("upto", F.col("first") + F.sum("n").over(inside))
        .withColumn("from", F.col("upto") - F.col("n"))
    )

    def at(edge: Column) -> Column:
        return F.max(F.when((edge >= F.col("from")) & (edge < F.col("upto")), F.col("value")))

    aggregates = []
    for i, rank in enumerate(ranks):
        aggregates += [at(F.floor(rank)).alias(f"lo{i}"), at(F.ceil(rank)).alias(f"hi{i}"),
                       F.max(rank - F.floor(rank)).alias(f"f{i}")]
    cut = [F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * F.col(f"f{i}") for i in range(len(ranks))]
    return placed.groupBy("user_id").agg(*aggregates).select("user_id", F.array(*cut).alias("cutoffs"))


def grade(similarity: str | Column, cutoffs: str | Column = "cutoffs", grades: Sequence[int] = tuple(g for g, _ in K.QUANTILE_GRADES)) -> Column:
    """Grade of a similarity by the user's cutoffs, highest first; below all of them 0."""
    value = F.col(similarity) if isinstance(similarity, str) else similarity
    bounds = F.col(cutoffs) if isinstance(cutoffs, str) else cutoffs
    result = F.lit(0)
    for i in reversed(range(len(grades))):
        result = F.when(value >= bounds[i], F.lit(int(grades[i]))).otherwise(result)
    return result


def attach_grades(recommendations: DataFrame, grades: DataFrame, column: str = "simulated_relevance") -> DataFrame:
    """Recommendations with the grade of their item, 0 where there is none."""
    return recommendations.join(grades.select("user_id", "opportunity_id", column), ["user_id", "opportunity_id"], "left").withColumn(
        column, F.coalesce(column, F.lit(0))
    )


def next_item(recommendations: DataFrame, seen: DataFrame, relevance: str = "simulated_relevance") -> DataFrame:
    """Per user the item to show next: best grade, then least seen, then best rank."""
    counted = seen.groupBy("user_id", "opportunity_id").agg(F.count("*").alias("_seen"))
    pool = recommendations.join(counted, ["user_id", "opportunity_id"], "left").withColumn(
        "seen", F.coalesce("_seen", F.lit(0)).cast("bigint")
    ).drop("_seen")
    order = [F.desc(relevance), F.asc("seen"), F.asc("rank"), F.asc("opportunity_id")]
    return top_n(pool, ["user_id"], order, 1, rank="_place").drop("_place")


def action_counts(feedback: DataFrame, by: Sequence[str] = ("user_id",), actions: Sequence[str] = tuple(K.FEEDBACK_WEIGHTS)) -> DataFrame:
    return pivot_counts(feedback, by, "action", actions)
