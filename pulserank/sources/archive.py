"""Hourly event archives: one JSON event per line, to flat records."""
from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pulserank.functions import constants as K
from pulserank.functions.text import clean, computed, let
from pulserank.operators.classify import rarest_topic, topic_matches
from pulserank.operators.dedup import keep_best
from pulserank.session import materialise

_ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"
RECORD_COLUMNS = (
    "id", "source", "event_type", "repo_name", "actor_login", "title", "text", "url", "score",
    "num_comments", "created_utc", "domain", "topic",
)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Parsed events as ``event`` (variant); blank and malformed lines are skipped.  Gzip is read as such."""
    return parse_lines(spark.read.text(path))


def parse_lines(lines: DataFrame) -> DataFrame:
    parsed = computed(lines.where(F.trim("value") != ""), event=F.try_parse_json("value"))
    return parsed.where(F.col("event").isNotNull())


def _get(source: str | Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(F.col(source) if isinstance(source, str) else source, path, kind)


def _text(source: str | Column, path: str) -> Column:
    return clean(_get(source, path))


def envelope(events: DataFrame) -> DataFrame:
    """Columns of the event envelope; the payload stays a variant."""
    return computed(
        events,
        public=F.to_json(_get("event", "$.public", "variant")) == "true",
        id=_get("event", "$.id"),
        event_type=_text("event", "$.type"),
        actor_login=_text("event", "$.actor.login"),
        repo_name=_text("event", "$.repo.name"),
        created_at=_text("event", "$.created_at"),
        payload=_get("event", "$.payload", "variant"),
        repo_description=_first_text("event", (
            "$.repo.description", "$.repo.repo_description", "$.org.description", "$.payload.description.description",
            "$.payload.repository.description", "$.payload.repo.description",
        )),
    )


def _first_text(source: str, paths: Sequence[str]) -> Column:
    return clean(F.coalesce(*[F.nullif(_get(source, p), F.lit("")) for p in paths]))


def valid(df: DataFrame, cutoff: str | Column) -> DataFrame:
    """Public events of a known type with a live actor, a full repository name and a time at or after ``cutoff``.

    Adds ``created_utc`` as ISO text.  All checks are cheap and come before any payload work.
    """
    limit = F.lit(cutoff).cast("timestamp") if isinstance(cutoff, str) else cutoff
    when = F.when(F.rlike("created_at", F.lit(r"^\d{4}-\d{2}-\d{2}")), F.col("created_at")).try_cast("timestamp")
    return df.withColumn("_at", F.date_trunc("second", when)).where(
        F.coalesce(F.col("public"), F.lit(False))
        & F.col("id").isNotNull()
        & F.col("event_type").isin(*K.ARCHIVE_EVENT_TYPES)
        & ~F.lower("actor_login").isin(*K.DELETED_MARKERS)
        & F.contains("repo_name", F.lit("/"))
        & F.col("_at").isNotNull()
        & (F.col("_at") >= limit)
    ).withColumn("created_utc", F.date_format("_at", _ISO)).drop("_at")


def _part(text: Column, length: int | None) -> Column:
    return text if length is None else F.substring(text, 1, length)


def _pair(title: Column, text: Column) -> Column:
    return F.struct(title.alias("title"), text.alias("text"))


def title_and_text(
    event_type: str = "event_type", payload: str = "payload", repo: str = "repo_name", title_limit: int | None = None,
    text_limit: int | None = None, comment_title: int | None = None, commits: int | None = None, pages: int | None = None,
) -> Column:
    """Title and text of an event by its type; the title may be empty.

    By default nothing is cut. The limits are in characters, those of ``commits`` and ``pages`` in entries.
    """
    kind = F.col(event_type)
    empty = F.lit("")

    def listed(path: str, key: str, limit: int | None) -> Column:
        entries = F.coalesce(_get(payload, path, "array<variant>"), F.array().cast("array<variant>"))
        entries = entries if limit is None else F.slice(entries, 1, limit)
        return F.filter(F.transform(entries, lambda e: clean(F.try_variant_get(e, key, "string"))), lambda t: t != "")

    def first_and_rest(texts: Column, otherwise: Column) -> Column:
        found = F.size(texts) > 0
        rest = F.array_join(F.slice(texts, F.lit(2), F.size(texts)), "\n")
        return _pair(
            F.when(found, _part(F.try_element_at(texts, F.lit(1)), title_limit)).otherwise(otherwise),
            F.when(found, _part(rest, text_limit)).otherwise(empty),
        )

    def entry(name: str) -> Column:
        return _pair(_part(_text(payload, f"$.{name}.title"), title_limit), _part(_text(payload, f"$.{name}.body"), text_limit))

    ref = _text(payload, "$.ref")
    comment = _text(payload, "$.comment.body")
    issue_title = _part(_text(payload, "$.issue.title"), title_limit)
    release = _get(payload, "$.release.name")
    created, ref_type = _text(payload, "$.description"), _text(payload, "$.ref_type")
    fork = _text(payload, "$.forkee.full_name")
    name = F.col(repo)
    return (
        F.when(kind == "PushEvent", first_and_rest(
            listed("$.commits", "$.message", commits),
            F.when(ref != "", F.concat(F.lit("Push to "), ref)).otherwise(empty),
        ))
        .when(kind == "IssuesEvent", entry("issue"))
        .when(kind == "PullRequestEvent", entry("pull_request"))
        .when(kind.isin("IssueCommentEvent", "CommitCommentEvent"), _pair(
            F.when(issue_title != "", issue_title).otherwise(_part(comment, comment_title)), _part(comment, text_limit)
        ))
        .when(kind.isin("PullRequestReviewCommentEvent", "PullRequestReviewEvent"), _pair(
            _part(_text(payload, "$.pull_request.title"), title_limit), _part(comment, text_limit)
        ))
        .when(kind == "ReleaseEvent", _pair(
            _part(F.when(release != "", clean(release)).otherwise(_text(payload, "$.release.tag_name")), title_limit),
            _part(_text(payload, "$.release.body"), text_limit),
        ))
        .when(kind == "CreateEvent", _pair(
            F.when((ref_type != "") & (ref != ""), F.concat_ws(" ", F.lit("Create"), ref_type, ref)).otherwise(_part(created, title_limit)),
            _part(created, text_limit),
        ))
        .when(kind == "GollumEvent", first_and_rest(listed("$.pages", "$.title", pages), empty))
        .when(kind == "WatchEvent", _pair(F.concat(F.lit("Starred "), name), empty))
        .when(kind == "ForkEvent", _pair(
            _part(F.concat(F.lit("Forked "), name, F.when(fork != "", F.concat(F.lit(" to "), fork)).otherwise(empty)), title_limit), empty
        ))
        .when(kind == "PublicEvent", _pair(F.concat(F.lit("Repository "), name, F.lit(" made public")), empty))
        .otherwise(_pair(empty, empty))
    )


def event_url(event_type: str = "event_type", payload: str = "payload", repo: str = "repo_name") -> Column:
    """Page of an event, else of its repository; null if the repository name has no slash."""
    kind = F.col(event_type)
    commits = F.coalesce(_get(payload, "$.commits", "array<variant>"), F.array().cast("array<variant>"))
    commit_urls = F.filter(F.transform(commits, lambda c: F.try_variant_get(c, "$.url", "string")), lambda u: F.coalesce(u, F.lit("")) != "")

    def page(name: str) -> Column:
        return F.nullif(_get(payload, f"$.{name}.html_url"), F.lit(""))

    own = (
        F.when(kind == "IssuesEvent", page("issue"))
        .when(kind.isin("PullRequestEvent", "PullRequestReviewCommentEvent"), page("pull_request"))
        .when(kind == "PushEvent", F.try_element_at(commit_urls, F.lit(1)))
        .when(kind == "ReleaseEvent", page("release"))
        .when(kind.isin("IssueCommentEvent", "CommitCommentEvent"), page("comment"))
    )
    return F.when(
        F.contains(F.col(repo), F.lit("/")), clean(F.coalesce(own, F.concat(F.lit("https://github.com/"), F.col(repo))))
    )


def _leaves(document: str | None, depth: int | None, items: int | None, skipped: frozenset) -> list[str]:
    """The texts of a JSON document, level by level; objects in the order of their keys."""
    level, found = [] if document is None else [json.loads(document)], []
    while level:
        found += [v for v in level if isinstance(v, str)]
        below = [] if depth == 0 else [
            x for v in level if isinstance(v, (dict, list))
            for x in ([v[k] for k in sorted(v) if k not in skipped] if isinstance(v, dict) else v[:items])
        ]
        level, depth = below, None if depth is None else depth - 1
    return found


def payload_strings(
    df: DataFrame,
    payload: str = "payload",
    out: str = "payload_strings",
    depth: int | None = None,
    items: int | None = None,
    skipped: Sequence[str] = K.PAYLOAD_SKIPPED_KEYS,
) -> DataFrame:
    """Add all string leaves of a free-form payload, one after the levels of the other.

    Values of objects without the skipped keys, and the entries of lists, are the next level. A payload is read in one go
    inside its row, however deep it nests, so the plan is the same for all data. ``depth`` limits the levels below the first,
    ``items`` the entries of a list. A null payload has no leaves.
    """
    hidden = frozenset(skipped)

    @F.arrow_udf("array<string>")
    def leaves(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([_leaves(document, depth, items, hidden) for document in batch.to_pylist()], pa.list_(pa.string()))

    return df.withColumn(out, leaves(F.to_json(payload)))


def valid_records(events: DataFrame, cutoff: str | Column) -> DataFrame:
    """Valid events with title, text and url, before topics are looked for; the payload stays a variant.

    Events with a deleted title or without a url are left out.
    """
    df = valid(envelope(events), cutoff)
    same = ("id", "event_type", "actor_login", "repo_name", "repo_description", "created_utc", "payload")
    action = _text("payload", "$.action")
    other = F.when(action != "", F.concat_ws(": ", "event_type", action)).otherwise(F.concat_ws(" on ", "event_type", "repo_name"))
    df = computed(df, same, _tt=title_and_text(), _other=other, url=event_url())
    return df.select(
        *same, "url", F.when(F.col("_tt.title") != "", F.col("_tt.title")).otherwise(F.col("_other")).alias("title"), F.col("_tt.text").alias("text")
    ).where(~F.lower("title").isin(*K.DELETED_MARKERS) & F.col("url").isNotNull())


def archive_events(events: DataFrame, cutoff: str | Column, vocab: Mapping[str, Sequence[str]]) -> DataFrame:
    """Flat records of valid events that match at least one topic; one row per event id.

    A row's topic is the rarest of those it matches, which needs the totals over all rows
    first: the matched rows are written once to the shared folder, so that no archive is
    parsed twice.
    """
    df = valid_records(events, cutoff)
    df = payload_strings(df)
    parts = F.concat(F.array("repo_name", "repo_description", "title", "text"), "payload_strings")
    blob = F.lower(F.array_join(F.filter(parts, lambda p: p != ""), "\n"))
    shown = ("id", "event_type", "repo_name", "actor_login", "title", "text", "url", "created_utc")
    df = computed(df, shown, topics=let(blob, lambda b: topic_matches(b, vocab))).where(F.size("topics") > 0)
    flat = df.select(
        "id", F.lit("github").alias("source"), "event_type", "repo_name", "actor_login", "title", "text", "url",
        F.lit(None).cast("bigint").alias("score"), F.lit(None).cast("bigint").alias("num_comments"), "created_utc",
        F.lit("github.com").alias("domain"), "topics",
    )
    once = keep_best(flat, F.col("id"), [F.asc("created_utc"), F.asc("event_type"), F.asc("title"), F.asc("text"), F.asc("url")])
    return rarest_topic(materialise(once, "archive-matches"), "topics").select(*RECORD_COLUMNS)
