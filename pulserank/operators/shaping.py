"""Schema shaping: aliases, defaults, identifiers, labels.  Every step is narrow."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pulserank.functions import constants as K
from pulserank.functions.text import clean, col, computed, contains_any, first_label, let, literal_map
from pulserank.functions.urls import opportunity_id, url_host


def rename_aliases(df: DataFrame, aliases: Mapping[str, str] = K.RAW_ALIASES) -> DataFrame:
    """Give alias columns their canonical name.

    A canonical column that is present wins.  Of several aliases of one name the first
    in mapping order wins and the others are dropped.
    """
    present, renames, dropped = set(df.columns), {}, []
    taken = set(df.columns)
    for alias, name in aliases.items():
        if alias not in present or name in present:
            continue
        if name in taken:
            dropped.append(alias)
        else:
            renames[alias] = name
            taken.add(name)
    return df.drop(*dropped).withColumnsRenamed(renames)


def first_existing(df: DataFrame, names: Sequence[str]) -> str | None:
    """First of ``names`` that is a column of ``df``."""
    return next((n for n in names if n in df.columns), None)


def text_or_unknown(df: DataFrame, names: Sequence[str]) -> Column:
    """First existing column as text, blank as ``unknown``; null stays null."""
    name = first_existing(df, names)
    if name is None:
        return F.lit("unknown")
    value = F.col(name).cast("string")
    return F.when(F.trim(value) == "", F.lit("unknown")).otherwise(value)


def standardize(
    df: DataFrame, source_name: str | Column = "unknown", aliases: Mapping[str, str] = K.RAW_ALIASES
) -> DataFrame:
    """Bring one source file to the nine raw columns and their types.

    Values that cannot be cast become null first and then the default, as numbers 0,
    as text the empty string.  A missing or empty domain is read from the url.
    """
    df = rename_aliases(df, aliases)
    df = df.withColumns({n: F.lit(None).cast("string") for n in K.RAW_COLUMNS if n not in df.columns})
    default_source = F.lit(source_name) if isinstance(source_name, str) else source_name
    types = dict(df.dtypes)

    def count_of(name: str) -> Column:
        number = F.col(name).try_cast("double")
        finite = F.when(~F.isnan(number), number)
        return F.coalesce(finite.try_cast("bigint"), F.lit(0).cast("bigint"))

    created = F.col("created_utc")
    if not types["created_utc"].startswith("timestamp"):
        created = F.col("created_utc").try_cast("string")
    return df.select(
        F.col("id").cast("string").alias("id"),
        clean(F.coalesce(F.col("source").cast("string"), default_source)).alias("source"),
        clean("title").alias("title"),
        clean("text").alias("text"),
        clean("url").alias("url"),
        count_of("score").alias("score"),
        count_of("num_comments").alias("num_comments"),
        created.try_cast("timestamp").alias("created_utc"),
        F.coalesce(F.nullif(F.col("domain").cast("string"), F.lit("")), url_host("url")).alias("domain"),
    )


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by name; columns missing on one side are null."""
    if not frames:
        raise ValueError("no frames to union")
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged


def analytics_view(df: DataFrame) -> DataFrame:
    """Add the ``analytics_*`` columns that the reports read, whatever the input names are."""
    created = first_existing(df, ("created_at", "created_utc", "created_at_utc"))
    engagement = first_existing(df, ("engagement", "score", "upvotes", "points"))
    comments = first_existing(df, ("comments", "num_comments", "comment_count"))
    source, domain = text_or_unknown(df, ("source",)), text_or_unknown(df, ("domain", "domain_category"))
    community = (
        text_or_unknown(df, ("community",)) if "community" in df.columns else F.concat_ws("::", source, domain)
    )
    return df.withColumns({
        "analytics_title": text_or_unknown(df, ("title",)),
        "analytics_source": source,
        "analytics_category": text_or_unknown(df, ("category", "topic_category")),
        "analytics_domain": domain,
        "analytics_community": community,
        "analytics_created_at": F.col(created).cast("string") if created else F.lit(None).cast("string"),
        "analytics_engagement": F.col(engagement).try_cast("double") if engagement else F.lit(0.0),
        "analytics_comments": F.col(comments).try_cast("double") if comments else F.lit(0.0),
    })


def with_opportunity_id(df: DataFrame) -> DataFrame:
    """Add ``opportunity_id`` unless every row may already carry one."""
    parts = {n: F.col(n) if n in df.columns else F.lit(None) for n in ("source", "id", "url", "title")}
    built = opportunity_id(parts["source"], parts["id"], parts["url"], parts["title"])
    if "opportunity_id" in df.columns:
        built = F.coalesce(F.nullif(clean("opportunity_id"), F.lit("")), built)
    return df.withColumn("opportunity_id", built)


def informative_domain(df: DataFrame, empty: Sequence[str] = K.EMPTY_LABELS) -> Column:
    """First meaningful of topic category, domain category and domain."""
    names = [n for n in ("topic_category", "domain_category", "domain") if n in df.columns]
    return first_label(names, empty)


def domain_label(df: DataFrame) -> Column:
    """Informative domain for display: underscores as blanks."""
    return F.trim(F.replace(informative_domain(df), F.lit("_"), F.lit(" ")))


def topic_label(df: DataFrame) -> Column:
    """Like :func:`domain_label`, with ``General Tech`` where nothing is known."""
    names = [n for n in ("topic_category", "domain_category", "domain") if n in df.columns]
    return F.replace(first_label(names, K.EMPTY_LABELS, "General Tech"), F.lit("_"), F.lit(" "))


def page_label(source: str | Column) -> Column:
    """Kind of page behind a source name."""
    name = F.lower(clean(source))
    return (
        F.when(F.contains(name, F.lit("github")), "GitHub issue or repository page")
        .when(F.contains(name, F.lit("hacker")) | (name == "hn"), "Hacker News discussion")
        .when(F.contains(name, F.lit("reddit")), "Reddit community thread")
        .when(name != "", F.concat(F.initcap(name), F.lit(" page")))
        .otherwise("Community page")
    )


def embedding_text(df: DataFrame) -> Column:
    """Four labelled lines that an encoder reads."""
    body = "text" if "text" in df.columns else "description"
    return F.concat_ws(
        "\n",
        F.concat(F.lit("Title: "), clean("title")),
        F.concat(F.lit("Description: "), clean(body) if body in df.columns else F.lit("")),
        F.concat(F.lit("Domain: "), informative_domain(df, K.EMPTY_LABELS_FOR_EMBEDDING)),
        F.concat(F.lit("Source: "), clean("source")),
    )


def board_defaults(df: DataFrame) -> DataFrame:
    """Columns that the recommendation board needs: mirrors, defaults and numbers.

    Rows without an ``id`` get the identifier of :func:`with_opportunity_id`, which does
    not depend on the row order.
    """
    have = set(df.columns)
    new: dict[str, Column] = {}
    if "platform" not in have and "source" in have:
        new["platform"] = F.col("source")
    if "source" not in have and "platform" in have:
        new["source"] = F.col("platform")
    for name in ("text", "url"):
        if name not in have:
            new[name] = F.lit("")
    if "topic_category" not in have:
        new["topic_category"] = F.col("domain_category") if "domain_category" in have else F.lit("General Tech")
    if "domain_category" not in have:
        new["domain_category"] = new.get("topic_category", F.col("topic_category"))
    for name in ("score", "num_comments", "age_days", "engagement_score", "final_score",
                 "relevance_score", "effort_score"):
        if name in have:
            new[name] = F.coalesce(F.col(name).try_cast("double"), F.lit(0.0))
    df = df.withColumns(new)
    if "id" not in have:
        df = with_opportunity_id(df).withColumnRenamed("opportunity_id", "id")
    return df


def prompt_pick(
    df: DataFrame,
    templates: Mapping[str, Sequence[str]],
    goal_key: str | Column,
    seed: int = 0,
    id_column: str = "id",
) -> DataFrame:
    """Fill one template per row: the persona's templates, else those of the source, else ``other``.

    ``templates`` maps a key to sentences with ``{title}`` and ``{topic}``.  A key is
    chosen if the persona name contains it, then if the source name contains it.  The
    sentence depends on a hash of seed and id only, so a second run picks the same one.
    """
    persona, source = F.lower(clean(goal_key)), F.lower(clean("source"))
    key = F.lit("other")
    for column in (source, persona):
        for name in reversed([k for k in templates if k != "other"]):
            key = F.when(F.contains(column, F.lit(name)), name).otherwise(key)
    chosen = literal_map({k: "\x00".join(v) for k, v in templates.items()})[key]
    options = F.split(chosen, "\x00")
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_column).cast("string"))), 1, 12)
    position = (F.conv(digits, 16, 10).cast("bigint") % F.size(options)).cast("int")
    filled = F.replace(F.element_at(options, position + 1), F.lit("{topic}"), topic_label(df))
    return df.withColumn("writing_prompt", F.replace(filled, F.lit("{title}"), F.coalesce(F.col("title"), F.lit("Untitled"))))


def is_beginner(df: DataFrame) -> Column:
    """Beginner-friendly row: by its domain (the category only if the domain is empty) or by its text."""
    def text_of(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("")) if name in df.columns else F.lit("")

    domain = F.lower(F.when(text_of("domain") != "", text_of("domain")).otherwise(text_of("domain_category")))
    words = F.lower(F.concat_ws(" ", text_of("title"), text_of("text"), text_of("topic_category")))
    return let(domain, lambda d: contains_any(d, K.BEGINNER_DOMAINS)) | let(words, lambda w: contains_any(w, K.BEGINNER_PHRASES))


def good_first_issues(df: DataFrame, min_rows: int = 0, source: str = "github") -> DataFrame:
    """Rows for newcomers.

    With ``min_rows``, fewer rows than that fall back to the source, then to all rows; the
    counts are one aggregate, used as a scalar subquery: no driver branch.
    """
    fields = [F.col(n).cast("string") for n in ("title", "text", "topic_category", "domain_category", "domain") if n in df.columns]
    from_source = F.coalesce(F.lower(col("source")) == source, F.lit(False))
    columns, df = df.columns, computed(df, df.columns, _content=F.lower(F.concat_ws("\n", *fields)))
    wanted = from_source | contains_any(F.col("_content"), K.FIRST_ISSUE_PHRASES)
    if not min_rows:
        return df.where(wanted).select(*columns)
    counts = df.agg(
        F.struct(
            F.count_if(wanted).alias("wanted"), F.count_if(from_source).alias("from_source")
        ).alias("n")
    ).scalar()
    keep = (
        F.when(counts["wanted"] >= min_rows, wanted)
        .when(counts["from_source"] > 0, from_source)
        .otherwise(True)
    )
    return df.where(keep).select(*columns)


def snapshot_features(df: DataFrame, reference_ts: str | Column) -> DataFrame:
    """Title length in code points, age in whole days, engagement, and ISO time stamps."""
    reference = F.lit(reference_ts).cast("timestamp") if isinstance(reference_ts, str) else reference_ts
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    return df.withColumns({
        "title_length": F.length("title"),
        "age_days": F.coalesce(whole_days(F.col("created_utc"), reference), F.lit(0)).cast("int"),
        "engagement_score": F.col("score").cast("double") + F.lit(2.0) * F.col("num_comments").cast("double"),
        "created_utc": F.date_format("created_utc", iso),
        "snapshot_utc": F.date_format(reference, iso),
    })


def whole_days(created: Column, reference: Column) -> Column:
    """Whole days between two time stamps, never below 0; null if ``created`` is null."""
    micros = F.unix_micros(reference.cast("timestamp")) - F.unix_micros(created.cast("timestamp"))
    days = F.greatest(F.floor(micros / F.lit(86_400_000_000)), F.lit(0)).cast("bigint")
    return F.when(micros.isNotNull(), days)  # greatest() would turn null into 0
