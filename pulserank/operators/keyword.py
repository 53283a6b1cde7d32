"""Keyword ranking: profiles against rows without vectors."""
from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from pulserank.functions import constants as K
from pulserank.functions.text import word_count
from pulserank.operators.dedup import top_n
from pulserank.operators.matching import phrase_places, words_of
from pulserank.operators.shaping import topic_label
from pulserank.session import materialise

_PARTS = ("quality_score", "freshness_score", "effort_score_normalized")
TEXT_FIELDS = ("title", "text", "platform", "domain", "domain_category", "topic_category")


def split_terms(value: str | Column) -> Column:
    """Terms of a free-text field, separated by commas, semicolons or line ends."""
    value = F.col(value) if isinstance(value, str) else value
    parts = F.transform(F.split(F.coalesce(value, F.lit("")), "[,;\n]+"), lambda p: F.btrim(p, F.lit(K.WHITESPACE)))
    return F.filter(parts, lambda p: p != "")


def tokens(value: Column) -> Column:
    """Distinct lower-case tokens longer than two characters that are no stop words."""
    words = F.regexp_extract_all(F.lower(value), F.lit("([a-z0-9+#.-]+)"))
    return F.array_distinct(F.filter(words, lambda w: (F.length(w) > 2) & ~w.isin(*K.RANKER_STOP_WORDS)))


def row_text(df: DataFrame) -> Column:
    fields = [F.col(n).cast("string") for n in TEXT_FIELDS if n in df.columns]
    return F.lower(F.concat_ws(" ", *fields))


def with_row_scores(df: DataFrame, words: Column | None = None) -> DataFrame:
    """Add ``quality_score``, ``freshness_score`` and ``effort_score_normalized``.

    ``words`` are the words of a row's text if they are known. Quality and effort are scaled to [0, 1] over the whole frame; both ranges come from
    one aggregate, used as a scalar subquery.
    """
    have = set(df.columns)

    def number(name: str) -> Column:
        return F.coalesce(F.col(name).try_cast("double"), F.lit(0.0))

    if "engagement_score" in have:
        quality = number("engagement_score")
    elif {"score", "num_comments"} <= have:
        quality = number("score") + number("num_comments")
    elif "final_score" in have:
        quality = number("final_score")
    else:
        quality = F.lit(0.0)
    light = number("effort_score") if "effort_score" in have else (word_count("text") if words is None else words).cast("double")
    span = df.select(quality.alias("q"), light.alias("e")).agg(
        F.struct(F.min("q").alias("q0"), F.max("q").alias("q1"), F.min("e").alias("e0"), F.max("e").alias("e1")).alias("s")
    ).scalar()

    def scaled(value: Column, low: Column, high: Column) -> Column:
        return F.when(high == low, 0.0).otherwise((value - low) / (high - low))

    if "age_days" in have:
        age = F.coalesce(F.col("age_days").try_cast("double"), F.lit(float(K.MISSING_AGE_DAYS)))
        fresh = F.lit(1.0) / (F.lit(1.0) + F.greatest(age, F.lit(0.0)))
    else:
        fresh = F.lit(0.5)
    ease = scaled(light, span["e0"], span["e1"])
    return df.withColumns({
        "quality_score": scaled(quality, span["q0"], span["q1"]),
        "freshness_score": fresh,
        "effort_score_normalized": ease if "effort_score" in have else F.lit(1.0) - ease,
    })


def keyword_match(rows: DataFrame, profiles: DataFrame, n: int, id_column: str = "id", max_profile_bytes: int = 1 << 20) -> DataFrame:
    """The best ``n`` matching rows of every user by match score, ties by id: ``user_id``, id, ``profile_match_score``.

    ``profiles`` has ``user_id`` and ``terms``.  Score = 0.7 · share of the user's terms
    that are substrings of the row + 0.3 · share of the user's tokens among the row's
    tokens, at most 1.  Rows that share nothing with a user are not produced.
    """
    plain = rows.withColumns({p: F.lit(0.0) for p in _PARTS})
    only_match = {"match": 1.0, "quality": 0.0, "freshness": 0.0, "effort": 0.0}
    found = _best_matches(plain, profiles, n, only_match, id_column, max_profile_bytes)
    best = top_n(found, ["user_id"], [F.desc("profile_match_score"), F.asc(id_column)], n)
    return best.select("user_id", id_column, "profile_match_score")


def _best_matches(
    rows: DataFrame, profiles: DataFrame, n: int, weights: Mapping[str, float], id_column: str, max_profile_bytes: int = 1 << 20,
) -> DataFrame:
    """The best ``n`` matching rows of every user in every task, so users x n rows leave a task and no pair is listed."""
    keep = {p: F.col(p) for p in _PARTS}
    return _union(_task_best(table, shipped, n, weights) for table, shipped in _with_places(rows, profiles, id_column, keep, max_profile_bytes)).withColumnRenamed("id", id_column)


def _union(frames) -> DataFrame:
    every = None
    for frame in frames:
        every = frame if every is None else every.unionByName(frame)
    return every


def _with_places(rows: DataFrame, profiles: DataFrame, id_column: str, keep: Mapping[str, Column], max_profile_bytes: int) -> list[tuple]:
    """Per block of profiles: the rows as (id, ``keep``, places) without their texts, and what tells whose the places are.

    Profiles are handed to the tasks in blocks of about ``max_profile_bytes``, measured first; each block is a pass
    over the texts. A task finds the phrases and tokens that its rows contain by array operations.
    """
    users = profiles.select(
        "user_id",
        F.transform("terms", lambda t: F.lower(t)).alias("phrases"),
        tokens(F.array_join("terms", " ")).alias("tokens"),
    )
    size = users.agg(F.sum(F.octet_length(F.array_join("phrases", "")) + F.size("phrases") * 16 + 64)).first()[0] or 0
    blocks, out = max(1, -(-size // max_profile_bytes)), []
    for block in range(blocks):
        part = users if blocks == 1 else users.where(F.pmod(F.xxhash64("user_id"), F.lit(blocks)) == block)
        held = [tuple(r) for r in part.collect()]
        phrases, words = (list(dict.fromkeys(x for u in held for x in u[at] if x)) for at in (1, 2))
        # A token of a row is a run of its letters, so the users' tokens are phrases with borders.
        places = phrase_places(row_text(rows), phrases + words, [False] * len(phrases) + [True] * len(words))
        table = rows.select(F.col(id_column).cast("string").alias("id"), *(c.alias(n) for n, c in keep.items()), places.alias("places"))
        shipped = rows.sparkSession.sparkContext.broadcast(([u[0] for u in held], _owners(held, 1, phrases), _owners(held, 2, words), len(phrases)))
        out.append((table, shipped))
    return out


def _task_best(table: DataFrame, shipped, n: int, weights: Mapping[str, float]) -> DataFrame:
    schema = "user_id string, id string, profile_match_score double, " + ", ".join(f"{p} double" for p in _PARTS)
    return table.select("id", *_PARTS, "places").mapInArrow(_matcher(shipped, n, dict(weights)), schema)


def _owners(users: list[tuple], at: int, keys: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, owners, sizes): the users of key i stand between starts[i] and starts[i + 1], once per occurrence in their list."""
    place = {key: i for i, key in enumerate(keys)}
    pairs = np.array([(place[x], u) for u, row in enumerate(users) for x in row[at] if x], np.int64).reshape(-1, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    return np.searchsorted(pairs[:, 0], np.arange(len(keys) + 1)), pairs[:, 1], np.array([max(1, len(row[at])) for row in users], float)


def _matcher(shipped, n: int, weights: dict[str, float]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = _BestMatches(*shipped.value, n, weights)
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                task.add(batch.slice(start, 1000))
        yield task.batch()

    return scan


def _per_user(keys: np.ndarray, rows: np.ndarray, starts: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(user, row) of every owner of every key that a row lists."""
    sizes = starts[keys + 1] - starts[keys]
    before = np.cumsum(sizes) - sizes
    return owners[np.repeat(starts[keys] - before, sizes) + np.arange(sizes.sum())], np.repeat(rows, sizes)


class _BestMatches:
    """The best ``n`` matches per user among the rows seen so far."""

    def __init__(self, names: list[str], phrases: tuple, words: tuple, n_phrases: int, n: int, weights: dict[str, float]):
        self.names, self.n, self.weights, self.phrases, self.words, self.n_phrases = names, n, weights, phrases, words, n_phrases
        self.kept = {"user": np.zeros(0, int), "id": np.zeros(0, "U1"), "total": np.zeros(0), "score": np.zeros(0), **{p: np.zeros(0) for p in _PARTS}}

    def add(self, batch: pa.RecordBatch) -> None:
        n, counts = batch.num_rows, []
        column = batch.column("places")
        keys = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        rows = np.repeat(np.arange(n), pc.list_value_length(column).to_numpy(zero_copy_only=False))
        is_word = keys >= self.n_phrases
        for chosen, first, (starts, owners, _) in ((~is_word, 0, self.phrases), (is_word, self.n_phrases, self.words)):
            user, row = _per_user(keys[chosen] - first, rows[chosen], starts, owners)
            counts.append(user * n + row)
        code, place = np.unique(np.concatenate(counts), return_inverse=True)
        p = np.bincount(place[:len(counts[0])], minlength=len(code))
        t = np.bincount(place[len(counts[0]):], minlength=len(code))
        user, row = np.divmod(code, max(1, n))
        score = np.minimum(1.0, 0.7 * (p / self.phrases[2][user]) + 0.3 * (t / self.words[2][user]))
        parts = {name: batch.column(name).to_numpy(zero_copy_only=False)[row] for name in _PARTS}
        w = self.weights
        total = w["match"] * score + w["quality"] * parts["quality_score"] + w["freshness"] * parts["freshness_score"] + w["effort"] * parts["effort_score_normalized"]
        ids = np.array([str(i) for i in batch.column("id").to_pylist()] or [""])[row]
        new = {"user": user, "id": ids, "total": total, "score": score, **parts}
        merged = {k: np.concatenate([v, new[k]]) for k, v in self.kept.items()}
        order = np.lexsort((merged["id"], -merged["total"], merged["user"]))
        sorted_users = merged["user"][order]
        first = np.arange(len(order)) - np.searchsorted(sorted_users, sorted_users) < self.n
        self.kept = {k: v[order][first] for k, v in merged.items()}

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "user_id": [self.names[u] for u in self.kept["user"]], "id": self.kept["id"].tolist(), "profile_match_score": self.kept["score"],
            **{p: self.kept[p] for p in _PARTS},
        }, schema=pa.schema([("user_id", pa.string()), ("id", pa.string()), *((c, pa.float64()) for c in ("profile_match_score", *_PARTS))]))


def keyword_rank(
    rows: DataFrame,
    profiles: DataFrame,
    n: int,
    weights: Mapping[str, float] = K.KEYWORD_WEIGHTS,
    id_column: str = "id",
    max_profile_bytes: int = 1 << 20,
) -> DataFrame:
    """The best ``n`` rows of every user by match, quality, freshness and effort.

    A row that matches nothing scores the same for every user.  If such a row is among a
    user's best ``n``, it is among the best ``n`` by that common part, because every row
    ahead of it there is ahead of it for the user too.  So the best ``n`` matches of each
    task and the global best ``n`` give the exact result.  Ids are compared as text.
    """
    numbers = ("engagement_score", "score", "num_comments", "final_score", "age_days", "effort_score")
    keep = {c: F.col(c) for c in numbers if c in rows.columns and c != id_column}
    if "effort_score" not in rows.columns:
        keep["_words"] = words_of(F.col("text"))
    # One pass over the texts for each block of profiles; what follows reads the narrow tables.
    passes = [(materialise(table, "row-matches"), shipped) for table, shipped in _with_places(rows, profiles, id_column, keep, max_profile_bytes)]
    words = F.col("_words") if "_words" in keep else None
    ranked = [(with_row_scores(table, words), shipped) for table, shipped in passes]
    scored = ranked[0][0].withColumn(id_column, F.col("id")).withColumn(
        "_base",
        F.lit(weights["quality"]) * F.col("quality_score")
        + F.lit(weights["freshness"]) * F.col("freshness_score")
        + F.lit(weights["effort"]) * F.col("effort_score_normalized"),
    )
    parts = list(_PARTS)
    facts = scored.select(id_column, "_base", *parts)
    common = facts.orderBy(F.desc("_base"), F.asc(id_column)).limit(n)
    users = profiles.select("user_id")
    reached = common.select(
        F.lit(1).alias("_one"), F.struct(id_column, "_base", *parts).alias("_row")
    )
    fallback = (
        users.withColumn("_row", F.explode(reached.agg(F.collect_list("_row")).scalar()))
        .select("user_id", "_row.*")
        .withColumn("profile_match_score", F.lit(0.0))
    )
    matched = _union(_task_best(table, shipped, n, weights) for table, shipped in ranked).withColumnRenamed("id", id_column)
    pairs = matched.unionByName(fallback, allowMissingColumns=True)
    # A pair from both sides keeps its match; scores follow the published order of terms.
    pairs = pairs.groupBy("user_id", id_column).agg(
        F.max("profile_match_score").alias("profile_match_score"), *[F.max(p).alias(p) for p in parts]
    )
    total = (
        F.lit(weights["match"]) * F.col("profile_match_score")
        + F.lit(weights["quality"]) * F.col("quality_score")
        + F.lit(weights["freshness"]) * F.col("freshness_score")
        + F.lit(weights["effort"]) * F.col("effort_score_normalized")
    )
    best = top_n(
        pairs.withColumn("recommendation_score", total), ["user_id"], [F.desc("recommendation_score"), F.asc(id_column)], n
    )
    return _with_rows(best, rows.drop(*parts), id_column)


def _with_rows(best: DataFrame, rows: DataFrame, id_column: str, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """``best`` joined with its ``rows``; only rows that it names are shuffled with their texts.

    The named ids are written and measured. Up to ``broadcast_bytes`` they travel to the rows; beyond that both sides are shuffled.
    """
    best = materialise(best, "best-rows")
    ids = best.select(id_column).distinct()
    size = ids.agg(F.coalesce(F.sum(F.octet_length(F.col(id_column).cast("string")) + 32), F.lit(0))).first()[0]
    if size <= broadcast_bytes:
        rows = rows.join(F.broadcast(ids), id_column, "left_semi")
    return best.join(rows, id_column)


def keyword_reasons(df: DataFrame, terms: str | Column = "terms") -> Column:
    """Up to three reasons: matched terms first, then activity and freshness, else the closest topic."""
    terms = F.col(terms) if isinstance(terms, str) else terms
    text = row_text(df)
    matched = F.slice(F.filter(terms, lambda t: F.contains(text, F.lower(t))), 1, 3)
    extra = F.array_compact(F.array(
        F.when(F.coalesce(F.col("quality_score"), F.lit(0.0)) >= 0.7, F.lit("strong community activity")),
        F.when(F.coalesce(F.col("freshness_score"), F.lit(0.0)) >= 0.05, F.lit("recent enough to engage")),
    ))
    reasons = F.concat(F.transform(matched, lambda t: F.concat(F.lit("profile match: "), t)), extra)
    return F.when(F.size(reasons) > 0, F.slice(reasons, 1, 3)).otherwise(
        F.array(F.concat(F.lit("closest available match in "), topic_label(df)))
    )
