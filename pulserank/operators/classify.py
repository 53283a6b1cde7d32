"""Rule based labels.  All vocabularies are arguments; rows never leave their task."""
from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pulserank.functions import constants as K
from pulserank.functions.text import clean, col, computed, let, literal_map, word_count
from pulserank.operators.matching import constant, phrase_places

Vocabulary = Mapping[str, Sequence[str]]


def domain_category(domain: str | Column, mapping: Mapping[str, str] = K.DOMAIN_CATEGORIES) -> Column:
    """Category of a domain: exact entry, else first entry that is a suffix, else ``other``.

    Suffixes need no dot border.  Null and empty domains are ``unknown``.
    """
    name = F.lower(col(domain))
    if not mapping:
        return F.when(F.coalesce(name, F.lit("")) == "", "unknown").otherwise("other")
    suffix = F.lit("other")
    for known, category in reversed(list(mapping.items())):
        suffix = F.when(F.endswith(name, F.lit(known)), F.lit(category)).otherwise(suffix)
    return F.when(F.coalesce(name, F.lit("")) == "", "unknown").otherwise(
        F.coalesce(F.try_element_at(literal_map(mapping), name), suffix)
    )


def domain_category_join(df: DataFrame, mapping: DataFrame, column: str = "domain") -> DataFrame:
    """:func:`domain_category` for mappings too large for an expression.

    ``mapping`` has ``known``, ``category`` and ``ord``.  The suffix match becomes an
    equi-join: every distinct domain is exploded into its suffixes, and the first entry
    wins.  Only distinct domains are exploded; rows join back on their domain, where
    adaptive execution splits the popular ones.
    """
    name = F.lower(F.col(column))
    domains = df.select(name.alias("_domain")).where(F.coalesce(F.col("_domain"), F.lit("")) != "").distinct()
    suffixes = domains.select(
        "_domain",
        F.explode(
            F.transform(F.sequence(F.lit(1), F.length("_domain")), lambda i: F.substring(F.col("_domain"), i, F.length("_domain")))
        ).alias("_suffix"),
    )
    exact_first = F.struct((F.col("_suffix") != F.col("_domain")).cast("int"), F.col("ord"))
    found = (
        suffixes.join(mapping.select(F.col("known").alias("_suffix"), "category", "ord"), "_suffix")
        .groupBy("_domain")
        .agg(F.min_by("category", exact_first).alias("_category"))
    )
    return (
        df.withColumn("_domain", name)
        .join(found, "_domain", "left")
        .withColumn(
            "domain_category",
            F.when(F.coalesce(F.col("_domain"), F.lit("")) == "", "unknown").otherwise(
                F.coalesce("_category", F.lit("other"))
            ),
        )
        .drop("_domain", "_category")
    )


def topic_votes(df: DataFrame, vocab: Vocabulary, title: str = "title", text: str = "text", counts: Mapping[bytes, int] | None = None) -> DataFrame:
    """Add ``topic_category``: the topic with most distinct keywords found as substrings.

    Ties go to the earlier topic; no keyword at all is ``unknown``. Vocabularies of any size are matched by
    :mod:`pulserank.operators.matching`; ``counts`` are gram counts for the choice of anchors.
    """
    content = F.lower(F.concat(F.coalesce(F.col(title), F.lit("")), F.lit(" "), F.coalesce(F.col(text), F.lit(""))))
    topics = {topic: list(dict.fromkeys(w for w in words if w)) for topic, words in vocab.items()}
    keywords = list(dict.fromkeys(k for words in topics.values() for k in words))
    none = F.struct(F.lit(0).alias("votes"), F.lit(1).alias("place"), F.lit("unknown").alias("topic"))  # beats topics without votes
    if not keywords:
        return df.withColumn("topic_category", F.lit("unknown"))
    place = {k: i for i, k in enumerate(keywords)}
    owners: list[list[int]] = [[] for _ in keywords]
    for i, words in enumerate(topics.values()):
        for word in words:
            owners[place[word]].append(i)
    of, names = constant(owners, "array<array<int>>"), constant(list(topics), "array<string>")

    def winner(voted: Column) -> Column:
        votes = F.transform(F.array_distinct(voted), lambda t: F.struct(
            F.size(F.filter(voted, lambda x: x == t)).alias("votes"), (-t).alias("place"), F.get(names, t).alias("topic")
        ))
        return F.array_max(F.concat(F.array(none), votes))["topic"]

    # Computed once: a filter on the topic must not match the texts again.
    columns = [c for c in df.columns if c != "topic_category"]
    df = df.withColumn("_places", phrase_places(content, keywords, counts=counts))
    voted = F.flatten(F.transform("_places", lambda i: F.get(of, i)))
    return computed(df, columns, topic_category=let(voted, winner))


def topic_matches(blob: str | Column, vocab: Vocabulary) -> Column:
    """All topics with a keyword that occurs in ``blob`` as a whole word, in vocabulary order."""
    text = col(blob)
    picks = []
    for topic, words in vocab.items():
        pattern = _word_pattern(words)
        if pattern:
            picks.append(F.when(F.rlike(text, F.lit(pattern)), F.lit(topic)))
    return F.array_compact(F.array(*picks)) if picks else F.array().cast("array<string>")


def _word_pattern(words: Sequence[str]) -> str:
    """One alternation for a topic; keywords without any word character need no border."""
    # The text is searched for the keyword first; its borders are tested only at a hit.
    bordered = [rf"{re.escape(w.lower())}(?<!\w{re.escape(w.lower())})" for w in words if re.search(r"\w", w)]
    plain = [re.escape(w.lower()) for w in words if w and not re.search(r"\w", w)]
    parts = [rf"(?:{'|'.join(bordered)})(?!\w)"] if bordered else []
    parts += plain
    return "(?iU)" + "|".join(parts) if parts else ""


def rarest_topic(df: DataFrame, matches: str = "topics", topics: Sequence[str] = ()) -> DataFrame:
    """Add ``topic``: of a row's matched topics the one with fewest matches overall.

    The counts are global, so the choice does not depend on the order in which rows
    arrive and needs no shared state.  Ties go to the earlier topic in the row.
    """
    counts = df.select(F.explode(matches).alias("t")).groupBy("t").agg(F.count("*").alias("n"))
    lookup = counts.agg(F.map_from_entries(F.collect_list(F.struct("t", "n"))).alias("m")).scalar()
    ranked = F.transform(
        F.col(matches), lambda t, i: F.struct(F.element_at(F.col("_lookup"), t).alias("n"), i.alias("i"), t.alias("t"))
    )
    return (
        df.withColumn("_lookup", lookup)
        .withColumn("topic", F.array_min(ranked)["t"])
        .drop("_lookup")
    )


def effort(text: str | Column) -> Column:
    """``low``, ``medium`` or ``high`` by the number of words to read."""
    words = word_count(text)
    return (
        F.when(words > K.EFFORT_WORDS["high"], "high")
        .when(words > K.EFFORT_WORDS["medium"], "medium")
        .otherwise("low")
    )


def effort_score(bucket: str | Column, scores: Mapping[str, float] = K.EFFORT_SCORES) -> Column:
    return literal_map(dict(scores))[col(bucket)]


def relevance_of(interaction: str | Column) -> Column:
    """Grade of an interaction name; null if the name is unknown."""
    return F.try_element_at(literal_map(K.RELEVANCE), F.lower(clean(interaction)))


def interaction_of(relevance: str | Column) -> Column:
    """Name of a grade 0 to 3; null outside."""
    return F.try_element_at(literal_map({v: k for k, v in K.RELEVANCE.items()}), col(relevance).cast("int"))


def interaction_from_percentile(percentile: str | Column) -> Column:
    result = F.lit("skipped")
    for name, floor in reversed(K.PERCENTILE_GRADES):
        result = F.when(col(percentile) >= floor, name).otherwise(result)
    return result
