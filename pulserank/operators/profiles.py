"""User profiles: nested optional fields to one ordered list of terms."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from pulserank.functions import constants as K
from pulserank.functions.text import clean, collapse_lines, let, simple_key


def _strings(value: Column, data_type) -> Column | None:
    """All strings of a string or of an array nested to any depth, in order; null for other types."""
    if isinstance(data_type, StringType):
        return F.array(clean(value))
    if isinstance(data_type, ArrayType):
        inner = data_type.elementType
        if isinstance(inner, StringType):
            return F.transform(value, lambda x: clean(x))
        nested = _strings(F.lit(None).cast(inner.simpleString()), inner)
        if nested is None:
            return None
        return F.flatten(F.transform(value, lambda x: F.coalesce(_strings(x, inner), F.array().cast("array<string>"))))
    return None


def _empty() -> Column:
    return F.array().cast("array<string>")


def _history(df: DataFrame, name: str, limit: int | None) -> Column:
    element = df.schema[name].dataType.elementType
    entries = F.coalesce(F.col(name), F.array().cast(df.schema[name].dataType.simpleString()))
    entries = entries if limit is None else F.slice(entries, 1, limit)
    if not isinstance(element, StructType):
        return F.coalesce(_strings(entries, ArrayType(element)), _empty())
    types = {f.name: f.dataType for f in element.fields}

    def entry(e: Column) -> Column:
        parts = [_strings(e[k], types[k]) for k in K.HISTORY_FIELDS if k in types]
        return F.concat(*[F.coalesce(p, _empty()) for p in parts if p is not None], _empty())

    return F.flatten(F.transform(entries, entry))


def _first_of_each(terms: Column) -> Column:
    """The terms without those that differ only in case from an earlier one: sorted by lower case and place, so the work is that of a sort."""
    placed = F.array_sort(F.transform(terms, lambda t, i: F.struct(F.lower(t).alias("low"), i.alias("place"), t.alias("term"))))
    kept = let(placed, lambda rows: F.filter(rows, lambda r, i: (i == 0) | (F.get(rows, i - 1)["low"] != r["low"])))
    return F.transform(F.array_sort(F.transform(kept, lambda r: F.struct(r["place"], r["term"]))), lambda r: r["term"])


def profile_terms(df: DataFrame, history_limit: int | None = None) -> DataFrame:
    """Add ``terms``, ``profile_text`` and ``encoding_text``.

    Terms come from the profile fields, then from the history (its first
    ``history_limit`` entries if that is given), then from the free text.  A term that differs only in case from an earlier
    one is left out.  The order is stable.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = [p for p in (_strings(F.col(n), types[n]) for n in K.PROFILE_FIELDS if n in types) if p is not None]
    history = [n for n in ("engagement_history", "history") if n in types and isinstance(types[n], ArrayType)]
    if history:
        chosen = _history(df, history[0], history_limit)
        for name in history[1:]:
            chosen = F.when(F.size(F.coalesce(F.col(history[0]), F.array())) > 0, chosen).otherwise(
                _history(df, name, history_limit)
            )
        parts.append(chosen)
    if "profile_text" in types:
        parts.append(F.split(F.replace(clean("profile_text"), F.lit(","), F.lit(" ")), f"[{K.WHITESPACE}]+"))
    every = F.filter(F.concat(*[F.coalesce(p, _empty()) for p in parts], _empty()), lambda t: t != "")
    first = let(every, _first_of_each)
    return (
        df.withColumn("terms", first)
        .withColumn("profile_text", F.array_join("terms", " "))
        .withColumn("encoding_text", collapse_lines(F.array_join("terms", "\n")))
    )


def preference_terms(
    preferred_domains: str,
    interests: str,
    aliases: Mapping[str, Sequence[str]] = K.PREFERENCE_ALIASES,
) -> Column:
    """Distinct normalised domain keys, their aliases and interests."""
    none = _empty()
    keys = F.transform(F.coalesce(F.col(preferred_domains), none), lambda d: F.replace(simple_key(d), F.lit(" "), F.lit("_")))
    flat = [
        F.struct(F.lit(key).alias("k"), simple_key(F.lit(name)).alias("v")) for key, names in aliases.items() for name in names
    ]
    extra = let(keys, lambda ks: F.transform(
        F.filter(F.array(*flat), lambda a: F.array_contains(ks, a["k"])), lambda a: a["v"]
    )) if flat else none
    wanted = F.transform(F.coalesce(F.col(interests), none), lambda i: simple_key(i))
    return F.filter(F.array_distinct(F.concat(keys, extra, wanted)), lambda t: t != "")
