"""Labels, NDCG and the comparison of ranking variants."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from pulserank.functions import constants as K
from pulserank.functions.text import clean, simple_key
from pulserank.operators.classify import interaction_from_percentile, interaction_of, relevance_of
from pulserank.operators.dedup import top_n
from pulserank.operators.profiles import preference_terms
from pulserank.operators.ranking import rerank, scored_candidates
from pulserank.operators.shaping import with_opportunity_id

LABEL_KEYS = ["user_id", "opportunity_id"]


def labels(df: DataFrame) -> DataFrame:
    """Trimmed ids, interaction and grade, one row per user and item.

    A missing grade follows from the interaction and the other way round.  Of several
    labels of a pair the highest grade stays.  Unknown interactions give a null grade,
    which :func:`pulserank.operators.quality.label_rules` reports.
    """
    missing = [c for c in LABEL_KEYS if c not in df.columns]
    if missing:
        raise ValueError(f"labels must include {missing}")
    have_name, have_grade = "interaction" in df.columns, "relevance_label" in df.columns
    if not (have_name or have_grade):
        raise ValueError("labels need interaction or relevance_label")
    if have_grade:
        grade = F.coalesce(F.col("relevance_label").try_cast("double").try_cast("int"), F.lit(0))
    else:
        grade = relevance_of("interaction")
    out = df.select(
        clean("user_id").alias("user_id"), clean("opportunity_id").alias("opportunity_id"),
        *([F.col("interaction")] if have_name else []), grade.alias("relevance_label"),
    )
    if not have_name:
        out = out.withColumn("interaction", interaction_of("relevance_label"))
    best = F.max_by(F.struct("interaction", "relevance_label"), F.struct("relevance_label", "interaction"))
    return out.groupBy(*LABEL_KEYS).agg(best.alias("b")).select(*LABEL_KEYS, "b.interaction", "b.relevance_label")


def users_with_vectors(df: DataFrame, vectors: DataFrame) -> DataFrame:
    return df.join(vectors.select("user_id"), "user_id", "left_semi")


def attach_labels(candidates: DataFrame, labelled: DataFrame) -> DataFrame:
    """Candidates with the labels of their user; without a label they count as skipped."""
    given = labelled.select(*LABEL_KEYS, "interaction", "relevance_label")
    pool = with_opportunity_id(candidates).drop("interaction", "relevance_label")
    return pool.join(given, LABEL_KEYS, "left").withColumns({
        "relevance_label": F.coalesce("relevance_label", F.lit(0)),
        "interaction": F.coalesce("interaction", F.lit("skipped")),
    })


def ndcg(
    df: DataFrame,
    label: str,
    score: str,
    k: int = 10,
    by: Sequence[str] = ("user_id",),
    gain: str = "linear",
    ties: str = "average",
    tie_order: Sequence[str] = ("opportunity_id",),
) -> DataFrame:
    """NDCG@k per group.

    ``gain`` is the label itself or ``2^label − 1``.  ``ties='average'`` gives rows with
    one score the mean gain of those rows, which is the expectation over their orders;
    ``'id'`` orders them by ``tie_order``.  The ideal order uses the group's own rows.  A
    group without any gain has NDCG 0.
    """
    by = list(by)
    value = F.col(label).cast("double")
    amount = value if gain == "linear" else F.pow(F.lit(2.0), value) - F.lit(1.0)
    group = Window.partitionBy(*by)
    names = [F.asc(c) for c in tie_order]
    placed = df.select(*by, *tie_order, F.col(score).cast("double").alias("_s"), amount.alias("_g")).withColumns({
        "_pos": F.row_number().over(group.orderBy(F.desc("_s"), *names)),
        "_ideal": F.row_number().over(group.orderBy(F.desc("_g"), *names)),
    })
    won = F.col("_g")
    if ties == "average":
        placed = placed.withColumn("_avg", F.avg("_g").over(Window.partitionBy(*by, "_s")))
        won = F.col("_avg")

    def discounted(worth: Column, position: str) -> Column:
        return F.sum(F.when(F.col(position) <= k, worth / F.log2(F.col(position) + 1)))

    return (
        placed.groupBy(*by)
        .agg(discounted(won, "_pos").alias("_dcg"), discounted(F.col("_g"), "_ideal").alias("_max"))
        .select(*by, F.when(F.col("_max") > 0, F.col("_dcg") / F.col("_max")).otherwise(0.0).alias("ndcg"))
    )


def variants(
    candidates: DataFrame, reference_ts: str | Column, bonus: float = 0.05, names: Sequence[str] = tuple(K.VARIANT_NAMES)
) -> DataFrame:
    """One row per candidate and ranking variant with its ``predicted_score``; one pass for all variants."""
    scored = rerank(scored_candidates(candidates, reference_ts), "simple", bonus)
    two = None
    for name, weight in K.TWO_SIGNAL_WEIGHTS.items():
        part = F.lit(weight) * F.col(name).cast("double")
        two = part if two is None else two + part
    columns = {
        "similarity_only": F.col("similarity").cast("double"),
        "similarity_engagement": two,
        "full_scoring": F.col("final_score"),
        "full_with_diversity": F.col("reranked_score"),
    }
    unknown = [n for n in names if n not in columns]
    if unknown:
        raise ValueError(f"unknown variants: {unknown}")
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("variant"), columns[n].alias("predicted_score")) for n in names]))
    return scored.withColumn("_v", pairs).select("*", "_v.variant", "_v.predicted_score").drop("_v")


def variant_ndcg(candidates: DataFrame, labelled: DataFrame, reference_ts: str | Column, k: int = 10) -> DataFrame:
    """NDCG per variant and user."""
    judged = attach_labels(variants(candidates, reference_ts), labelled)
    return ndcg(judged, "relevance_label", "predicted_score", k, by=("variant", "user_id"))


def compare(
    candidates: DataFrame,
    labelled: DataFrame,
    reference_ts: str | Column,
    k: int = 10,
    baseline: str = "similarity_only",
) -> DataFrame:
    """Mean NDCG over users per variant, with the difference to the baseline variant."""
    per_user = variant_ndcg(candidates, labelled, reference_ts, k)
    mean = per_user.groupBy("variant").agg(F.avg("ndcg").alias("ndcg"), F.count("*").alias("users"))
    shown = F.element_at(F.create_map(*[F.lit(x) for pair in K.VARIANT_NAMES.items() for x in pair]), F.col("variant"))
    base = F.max(F.when(F.col("variant") == baseline, F.col("ndcg"))).over(Window.partitionBy())
    return mean.select(
        "variant", shown.alias("display_name"), "ndcg", "users", (F.col("ndcg") - base).alias("gain_over_baseline")
    )


def markdown_table(comparison: DataFrame, k: int = 10) -> str:
    """The comparison as a Markdown table; it has one row per variant."""
    rows = comparison.orderBy("variant").limit(len(K.VARIANT_NAMES)).collect()
    order = list(K.VARIANT_NAMES)
    lines = [f"| Model | NDCG@{k} |", "|---|---|"]
    for row in sorted(rows, key=lambda r: order.index(r["variant"])):
        lines.append(f"| {row['display_name']} | {row['ndcg']:.4f} |")
    return "\n".join(lines)


def export(
    candidates: DataFrame, labelled: DataFrame, reference_ts: str | Column, variant: str = "full_with_diversity"
) -> DataFrame:
    """Evaluation rows of one variant."""
    judged = attach_labels(variants(candidates, reference_ts, names=(variant,)), labelled)
    return judged.select(
        "user_id", "opportunity_id", "predicted_score", "relevance_label", "interaction", clean("title").alias("title")
    )


def row_terms(df: DataFrame) -> Column:
    """Distinct tokens of a row's labels, title and text."""
    names = [n for n in ("topic_category", "domain_category", "domain", "title", "text") if n in df.columns]
    joined = F.concat_ws(" ", *[simple_key(n) for n in names])
    return F.filter(F.array_distinct(F.split(joined, " ")), lambda t: t != "")


def proxy_labels(
    candidates: DataFrame,
    profiles: DataFrame,
    aliases: Mapping[str, Sequence[str]] = K.PREFERENCE_ALIASES,
    weights: Mapping[str, float] = K.LABEL_WEIGHTS,
) -> DataFrame:
    """Stand-in labels from term overlap and similarity, graded by the rank inside the user's candidates.

    ``profiles`` has ``user_id``, ``preferred_domains`` and ``interests``.
    """
    users = profiles.select("user_id", preference_terms("preferred_domains", "interests", aliases).alias("_terms"))
    pool = with_opportunity_id(candidates)
    pool = pool.select("user_id", "opportunity_id", "similarity", row_terms(pool).alias("_row"))
    strength = F.when(
        F.size("_terms") > 0, F.size(F.array_intersect("_row", "_terms")) / F.size("_terms")
    ).otherwise(0.0)
    signal = F.lit(weights["strength"]) * strength + F.lit(weights["similarity"]) * F.coalesce(
        F.col("similarity").cast("double"), F.lit(0.0)
    )
    group = Window.partitionBy("user_id")
    placed = (
        pool.join(users, "user_id")
        .select("user_id", "opportunity_id", signal.alias("signal"))
        .withColumns({
            "_r": F.row_number().over(group.orderBy(F.desc("signal"), F.asc("opportunity_id"))) - 1,
            "_n": F.count("*").over(group),
        })
        .withColumn("percentile", F.lit(1.0) - F.col("_r") / F.greatest(F.col("_n") - 1, F.lit(1)))
        .withColumn("interaction", interaction_from_percentile("percentile"))
    )
    return placed.select("user_id", "opportunity_id", "interaction", relevance_of("interaction").alias("relevance_label"))


def best_candidates(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """The first ``n`` rows of every user."""
    return top_n(df, ["user_id"], order, n)
