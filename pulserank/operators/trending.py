"""Trending title terms: single words and pairs of neighbours, weighted by TF-IDF."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pulserank.functions import constants as K
from pulserank.functions.text import bigrams, let
from pulserank.operators.classify import topic_votes

# Token rules: runs of two or more letters, digits or underscores; and words that start
# with a letter and may contain signs.
WORD_TOKEN = r"[\p{L}\p{N}_]{2,}"
SIGN_TOKEN = r"[a-zA-Z][a-zA-Z0-9_+#.-]{1,}"


def terms_of(title: Column, stop_words: Sequence[str], token: str) -> Column:
    """Tokens without stop words, followed by the pairs that are neighbours after that removal."""
    tokens = F.regexp_extract_all(F.lower(title), F.lit(f"({token})"))
    if stop_words:
        tokens = F.filter(tokens, lambda t: ~t.isin(*stop_words))
    return let(tokens, lambda t: F.concat(t, bigrams(t)))


def _term_counts(titles: DataFrame) -> DataFrame:
    """Total occurrences and number of titles per term, combined on the map side."""
    counted = let(F.col("terms"), lambda terms: F.transform(
        F.array_distinct(terms), lambda x: F.struct(x.alias("topic"), F.size(F.filter(terms, lambda t: t == x)).alias("tf"))
    ))
    per_title = titles.select(F.inline(counted))
    return per_title.groupBy("topic").agg(F.sum("tf").alias("tf"), F.count("*").alias("df"))


def _idf(total: Column, df: Column) -> Column:
    return F.log((F.lit(1.0) + total) / (F.lit(1.0) + df)) + F.lit(1.0)


def trending(
    df: DataFrame,
    n: int = 30,
    stop_words: Sequence[str] = K.ANALYTICS_STOP_WORDS,
    norm: str | None = "l2",
    title: str = "analytics_title",
) -> DataFrame:
    """Top ``n`` terms with their score.

    ``norm='l2'``: the vocabulary is the ``n`` most frequent terms (ties by term); each
    title becomes a TF-IDF vector of length one over that vocabulary and the score sums
    the vectors.  ``norm=None``: score is total frequency times idf over all terms of
    titles that are not blank.  Pass the stop list that the first form needs.

    The first form needs no shuffle by title: the ``n`` chosen terms are a scalar
    subquery, and every title weighs its own terms inside its row.
    """
    titles = df.select(F.col(title).alias("title")).where(F.col("title").isNotNull())
    if norm is None:
        titles = titles.where(F.trim("title") != "")
    total = titles.agg(F.count("*").alias("n")).scalar()
    token = WORD_TOKEN if norm == "l2" else SIGN_TOKEN
    terms = titles.select(terms_of(F.col("title"), stop_words, token).alias("terms"))
    counted = _term_counts(terms)
    if norm is None:
        return (
            counted.select("topic", (F.col("tf") * _idf(total, F.col("df"))).alias("score"))
            .orderBy(F.desc("score"), F.asc("topic"))
            .limit(n)
        )
    top = (
        counted.orderBy(F.desc("tf"), F.asc("topic"))
        .limit(n)
        .agg(F.sort_array(F.collect_list(F.struct("topic", _idf(total, F.col("df")).alias("idf")))).alias("v"))
        .scalar()
    )

    def weighed(both: Column) -> Column:
        weights = F.filter(
            F.transform(both["vocab"], lambda v: F.struct(
                v["topic"].alias("topic"), (F.size(F.filter(both["terms"], lambda t: t == v["topic"])) * v["idf"]).alias("w")
            )),
            lambda x: x["w"] > 0,
        )
        return let(weights, lambda ws: let(
            F.sqrt(F.aggregate(ws, F.lit(0.0), lambda s, x: s + x["w"] * x["w"])),
            lambda length: F.transform(ws, lambda x: F.struct(x["topic"].alias("topic"), (x["w"] / length).alias("w"))),
        ))

    return (
        terms.withColumn("vocab", top).select(F.inline(let(F.struct("terms", "vocab"), weighed)))
        .groupBy("topic")
        .agg(F.sum("w").alias("score"))
        .orderBy(F.desc("score"), F.asc("topic"))
    )


def trends_board(trending_terms: DataFrame, vocab: Mapping[str, Sequence[str]], default: str = "General Tech") -> DataFrame:
    """Trending terms as ``topic``, whole ``count`` and a category by keyword votes."""
    voted = topic_votes(trending_terms.withColumn("_none", F.lit("")), vocab, "topic", "_none")
    return voted.select(
        "topic",
        F.round("score").cast("bigint").alias("count"),
        F.when(F.col("topic_category") == "unknown", default).otherwise(F.col("topic_category")).alias("category"),
    )
