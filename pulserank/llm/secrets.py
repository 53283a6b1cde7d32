"""Secrets in texts: fixed patterns, and credential values that are expensive to guess.

A value after a credential word gets the cost of guessing it, as the cheapest way to cut it into
dictionary words, dates, repeats, keyboard walks and brute-force spans. A dynamic program over its
positions finds that way: the cost of a prefix is the least over the spans that can end it. Costs are
decimal logarithms of guesses and add up. Dear values are added as spans of kind ``guess``.
"""
from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from pulserank.llm.common import column_free, lower_bytes, pieces

BASE_KINDS = ("assign", "access", "hex")
GUESS = "guess"
_ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_WORDS_OF_ASSIGN = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_CONTEXT = re.compile(
    r"""(?ai)(?:(?:password|passwd|passphrase|passcode|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credentials?|auth|bearer)["']?\s*(?::=|=>|[:=])\s*["']?(?:bearer\s+)?|(?P<scheme>\bbearer\s+))["']?(?P<value>[^\s"'<>,;]+)"""
)
_WORDS_OF_CONTEXT = (*_WORDS_OF_ASSIGN, b"pass", b"pwd", b"key", b"credential", b"auth", b"bearer")
_IS_HEX = bytes(104 if 48 <= c <= 57 or 97 <= c <= 102 else 32 for c in range(256))

# Words that guessers try first, the likeliest first.
COMMON = (
    "password", "admin", "welcome", "login", "letmein", "dragon", "monkey", "master", "secret", "token", "root", "user", "test",
    "guest", "default", "changeme", "example", "sample", "dummy", "demo", "public", "private", "access", "server", "database",
    "sunshine", "princess", "football", "baseball", "superman", "batman", "shadow", "michael", "jordan", "charlie", "love",
    "hello", "freedom", "whatever", "trustno", "summer", "winter", "spring", "autumn", "monday", "friday", "computer",
    "internet", "google", "company", "system", "manager", "service", "oracle", "mysql", "postgres", "redis", "linux", "ubuntu",
    "your", "here", "value", "string", "none", "null", "true", "false", "xxxx", "todo", "placeholder", "undefined", "the", "and",
)
WALKS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./", "abcdefghijklmnopqrstuvwxyz", "qazwsxedcrfvtgbyhnujmikolp", "qwertz", "azerty")
_LEET = str.maketrans("013457$@!", "oieastsai")
_DATE = re.compile(r"(?:(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d|(?:19|20)\d\d)", re.A)
_REPEAT = re.compile(r"(.{1,8}?)\1+", re.S)
RANKS = {w: i + 1 for i, w in enumerate(COMMON)}
_LONGEST = max(map(len, COMMON))
#: What each further span costs: the guesser must choose how to cut.
CUT = math.log10(4)
#: 8 random letters and digits cost 11.0 on average with a deviation of 0.4; this is 3 deviations below.
LEAST_MIXED = 9.8


def _letter_cost(c: str) -> float:
    if c.isascii():
        return 1.0 if c.isdigit() else math.log10(20) if c.islower() else math.log10(26) if c.isupper() else math.log10(33)
    return 2.0


def guess_cost(value: str) -> float:
    """The decimal logarithm of the guesses for ``value`` along its cheapest cut; 0 for the empty text."""
    n = len(value)
    lower = value.lower()
    plain = lower.translate(_LEET)
    if len(lower) != n or len(plain) != n:  # letters whose lower case is longer
        lower = plain = value
    ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]  # of spans that are no brute force: (start, cost)
    for m in _DATE.finditer(value):
        ends[m.end()].append((m.start(), math.log10(120 * (1 if m.end() - m.start() == 4 else 365))))
    for m in _REPEAT.finditer(value):
        unit, times = m.group(1), (m.end() - m.start()) // len(m.group(1))
        if m.end() - m.start() >= 3:
            ends[m.end()].append((m.start(), sum(map(_letter_cost, unit)) + math.log10(times)))
    for walk in WALKS:
        for line in (walk, walk[::-1]):
            start = 0
            for i in range(1, n + 1):
                if i == n or line.find(lower[i - 1] + lower[i]) < 0:
                    if i - start >= 3:
                        ends[i].append((start, math.log10(2 * len(WALKS) * len(line) * (i - start))))
                    start = i
    cost, brute = [0.0] * (n + 1), [math.inf] * (n + 1)  # brute: the last span is brute force
    for i in range(1, n + 1):
        brute[i] = min(brute[i - 1], cost[i - 1] + CUT) + _letter_cost(value[i - 1])
        best = brute[i]
        for start, c in ends[i]:
            best = min(best, cost[start] + CUT + c)
        for start in range(max(0, i - _LONGEST), i - 2):
            rank, leet = RANKS.get(lower[start:i]), False
            if rank is None:
                rank, leet = RANKS.get(plain[start:i]), True
            if rank:
                cased = value[start:i] != lower[start:i]
                best = min(best, cost[start] + CUT + math.log10(rank * (2 if leet else 1) * (4 if cased else 1)))
        cost[i] = best
    return cost[n]


def base_spans(text: str, lowered: bytes) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns: leftmost matches, those that fail their check dropped."""
    found = []
    if any(w in lowered for w in _WORDS_OF_ASSIGN):
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    if b"h" * 16 in lowered.translate(_IS_HEX):
        found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text) if m.end() - m.start() >= 16]
    return found


def _mixed(value: str) -> bool:
    """Whether a value has digits besides letters, or three kinds of characters; words of a sentence have neither."""
    lower, upper, digit = any(map(str.islower, value)), any(map(str.isupper, value)), any(map(str.isdigit, value))
    return digit and (lower or upper) or lower + upper + digit + (not value.isalnum()) >= 3


def guessed_spans(text: str, lowered: bytes, least: float, least_mixed: float) -> list[tuple[int, int, str]]:
    """Values in the context of a credential word whose guess cost is ``least`` or more, for mixed ones ``least_mixed``.

    After a mere ``bearer``, which is also a word of sentences, only mixed values count.
    """
    if not any(w in lowered for w in _WORDS_OF_CONTEXT):
        return []
    found = []
    for m in _CONTEXT.finditer(text):
        value = m.group("value")
        mixed = _mixed(value)
        if (mixed or not m.group("scheme")) and guess_cost(value) >= (min(least, least_mixed) if mixed else least):
            found.append((*m.span("value"), GUESS))
    return found


def find_secrets(docs: DataFrame, text: str = "text", least: float = 12.0, least_mixed: float = LEAST_MIXED) -> DataFrame:
    """``docs`` with ``spans``: array of (start, rank, kind, end), sorted by start, then kind as listed.

    Positions count code points of the whole text, ``end`` is exclusive. Kinds are ``assign``, ``access`` and ``hex`` (fixed
    patterns) and ``guess`` (values that cost 10 ** ``least`` guesses, or ``least_mixed`` if they mix letters and digits, unless an ``assign`` span ends with them). Null and empty texts have no spans.
    If ``docs`` has a column ``spans`` the new one starts with an underscore. Other columns pass.
    """
    name = column_free(docs, "spans")
    ranks = {k: i for i, k in enumerate((*BASE_KINDS, GUESS))}
    fields = [("start", pa.int32()), ("rank", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]

    def one(value: str | None) -> list[dict]:
        value = value or ""
        lowered = lower_bytes(value)
        found = base_spans(value, lowered)
        known = [s for s in found if s[2] == "assign"]
        found += [s for s in guessed_spans(value, lowered, least, least_mixed) if not any(a <= s[0] and s[1] <= b for a, b, _ in known)]
        return [{"start": a, "rank": ranks[k], "kind": k, "end": b} for a, b, k in sorted(found, key=lambda s: (s[0], ranks[s[2]], s[1]))]

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(rows, text):
            spans = pa.array([one(t) for t in part.column(text).to_pylist()], pa.list_(pa.struct(fields)))
            yield pa.RecordBatch.from_arrays([*part.columns, spans], [*part.schema.names, name])

    span = T.StructType([T.StructField(n, T.StringType() if n == "kind" else T.IntegerType()) for n, _ in fields])
    return docs.mapInArrow(batches, T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(span))]))


def joined_spans(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
