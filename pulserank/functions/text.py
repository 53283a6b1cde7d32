"""Column expressions over text.  All of them are built-in Spark expressions."""
from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pulserank.functions import constants as K

# White space that the plain \s of a regular expression does not know.  Character classes
# with Unicode members are slow; one translation before a plain pattern is not.
_RARE = "".join(c for c in K.WHITESPACE if c not in " \t\n\r\x0b\x0c")


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    """Remove leading and trailing white space, line breaks and Unicode spaces included."""
    return F.btrim(col(c).cast("string"), F.lit(K.WHITESPACE))


def clean(c: str | Column) -> Column:
    """Stripped text, null as the empty string."""
    return F.coalesce(strip(c), F.lit(""))


def collapse_lines(c: str | Column) -> Column:
    """Single blanks inside lines, no blank lines, no blanks at line ends."""
    plain = F.translate(clean(c), K.BLANKS + K.LINE_BREAKS, " " * len(K.BLANKS) + "\n" * len(K.LINE_BREAKS))
    breaks = F.regexp_replace(F.regexp_replace(plain, " +", " "), " ?\n[ \n]*", "\n")
    return F.btrim(breaks, F.lit(" \n"))


def word_count(c: str | Column) -> Column:
    """Number of runs without white space."""
    return F.regexp_count(F.translate(clean(c), _RARE, " " * len(_RARE)), F.lit("\\S+"))


def first_label(columns: Iterable[str | Column], empty: Sequence[str], default: str = "unknown") -> Column:
    """First label that says something, stripped; ``default`` if none does."""
    picks = []
    for c in columns:
        value = clean(c)
        picks.append(F.when((value != "") & ~F.lower(value).isin(*empty), value))
    return F.coalesce(*picks, F.lit(default))


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, also where Spark would repeat its expression."""
    return F.element_at(F.transform(F.array(value), use), 1)


def computed(df: DataFrame, keep: Sequence[str] = (), **columns: Column) -> DataFrame:
    """``keep`` and new columns, each computed exactly once per row.

    Spark moves a filter below a projection by copying the column's expression into the
    condition, which repeats parsing and matching.  A generator of one row stops that.
    """
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*keep, F.inline(F.array(row)))


def contains_any(text: Column, phrases: Sequence[str]) -> Column:
    """True if ``text`` contains one of the phrases. Pass a column, not an expression: each phrase reads it."""
    hit = F.lit(False)
    for phrase in phrases:
        hit = hit | F.contains(text, F.lit(phrase))
    return hit


def literal_map(mapping: dict) -> Column:
    parts = []
    for key, value in mapping.items():
        parts += [F.lit(key), F.lit(value)]
    return F.create_map(*parts)


def simple_key(c: str | Column) -> Column:
    """Lower case with every run of other characters than a-z and 0-9 as one blank."""
    return F.trim(F.regexp_replace(F.lower(clean(c)), "[^a-z0-9]+", " "))


def bigrams(tokens: Column) -> Column:
    """Neighbouring pairs of an array of tokens, joined by a blank."""
    pairs = F.zip_with(
        F.slice(tokens, 1, F.greatest(F.size(tokens) - 1, F.lit(0))),
        F.slice(tokens, 2, F.greatest(F.size(tokens) - 1, F.lit(0))),
        lambda left, right: F.concat(left, F.lit(" "), right),
    )
    return F.when(F.size(tokens) > 1, pairs).otherwise(F.array().cast("array<string>"))
