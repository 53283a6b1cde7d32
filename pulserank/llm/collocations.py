"""Phrase collocations, counted exactly level by level in counting quotient filters.

A phrase of n words occurs at least as often as any phrase that holds it, so only frequent phrases can be part of one. Words
with ``least`` occurrences get ids per language, and texts become sequences of ids with -1 for other words and between pieces.
On each level the id of a longer phrase is a pair: the ids of its first and of its last n - 1 words, which are neighbours in the sequence.
Every task counts such pairs in quotient filters (:mod:`pulserank.llm.quotient_filter`), one per language and bucket of the
permuted values; the filters of a bucket are merged across tasks, frequent pairs get ids, and the sequences are
written anew with them. No count is estimated and none is dropped that could matter.

Scale. A pair leaves a task once with its count, so a hot phrase is no hot key. A bucket holds at most about
``BUCKET`` positions before merging. Arrow batches are bounded by bytes and a counter by entries, so a task's memory does not grow with the length of texts. The ids of a level reach the tasks by broadcast if they are at most ``broadcast_bytes``,
otherwise by an equi-join of the positions; both give the same sequences. Phrases are then scored and compared as DataFrames.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from pulserank.llm.common import arrow_batches, materialise, pieces
from pulserank.llm.quotient_filter import Counter, QuotientFilter
from pulserank.operators.dedup import top_n

#: Fixed by the contract: signs that end a piece, and letters that are lowered.
ENDS = r"[.,;:!?\n-\r]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BUCKET, SEGMENT, BROADCAST = 500_000, 50_000, 64 << 20
_TEXTS, _IDS = 4 << 20, 4 << 20  # bytes a task works on at a time
_BREAK = "\n"


def _rows(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))


def word_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, word, f): all occurrences of every word of each language."""
    rows = _rows(docs, text, lang)
    words = F.split(F.translate("text", UPPER, LOWER), r"[.,;:!?\n-\r \t]+")
    return rows.select("lang", F.explode(words).alias("word")).where("word <> ''").groupBy("lang", "word").agg(F.count("*").alias("f"))


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``id``, dense from 0 in each lang; numbered bucket by bucket, so no lang has to fit one task."""
    local = rows.withColumn("_place", F.row_number().over(Window.partitionBy("lang", "bucket").orderBy(*order)))
    sizes = rows.groupBy("lang", "bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("lang").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("lang", "bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return local.join(starts, ["lang", "bucket"]).withColumn("id", F.col("_start") + F.col("_place") - 1).drop("_place", "_start", "bucket")


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(row, code, dictionary) of the words of each text in order; ``_BREAK`` stands between pieces."""
    low = pc.replace_substring_regex(pc.ascii_lower(texts), ENDS, f" {_BREAK} ")  # a slice must not be cast before: Arrow then reads other rows
    split = pc.split_pattern(pc.replace_substring(low, "\t", " "), " ")
    coded = split.flatten().dictionary_encode()
    row = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
    code, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
    if "" in words:
        kept = code != words.index("")
        row, code = row[kept], code[kept]
    return row, code, words


def _cut(row: np.ndarray, brk: np.ndarray) -> list[int]:
    """Starts of segments: where a row begins, and at a break after every ``SEGMENT`` words."""
    starts = [0, *(np.flatnonzero(np.diff(row)) + 1).tolist()] if len(row) else []
    out = []
    for a, b in zip(starts, [*starts[1:], len(row)]):
        out.append(a)
        if b - a > SEGMENT:
            for p in (np.flatnonzero(brk[a:b]) + a).tolist():
                if p - out[-1] >= SEGMENT:
                    out.append(p)
    return out


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.RecordBatch]]:
    for lang in pc.unique(batch.column("lang")).to_pylist():
        yield lang, batch.filter(pc.equal(batch.column("lang"), lang))


def _as_lists(values: pa.Array, starts: list[int]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([*starts, len(values)], pa.int32()), values)


def _fits(table: DataFrame, limit: int) -> bool:
    size = table.agg(F.sum(sum((F.octet_length(c) if t == "string" else F.lit(8)) + 16 for c, t in table.dtypes))).first()[0]
    return (size or 0) <= limit


def _rebuilt(positions: DataFrame) -> DataFrame:
    """(lang, ids) from (rid, lang, size, place, id): sequences with -1 where nothing was found."""
    rows = positions.groupBy("rid", "lang", "size").agg(F.collect_list("place").alias("places"), F.collect_list("id").alias("found"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for size, places, found in zip(*(batch.column(c).to_pylist() for c in ("size", "places", "found"))):
                ids = np.full(size, -1, np.int64)
                ids[places] = found
                out.append(ids)
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(out, pa.list_(pa.int64()))], ["lang", "ids"])

    return rows.mapInArrow(run, "lang string, ids array<bigint>")


def word_sequences(docs: DataFrame, ids: DataFrame, text: str = "text", lang: str = "lang", broadcast_bytes: int = BROADCAST) -> DataFrame:
    """(lang, ids): texts as sequences of the ids of (lang, word, id); long texts as several rows, cut between pieces."""
    rows = _rows(docs, text, lang)
    if not _fits(ids, broadcast_bytes):
        def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches, "text", _TEXTS):
                row, code, names = _words(batch.column("text"))
                brk = code == (names.index(_BREAK) if _BREAK in names else -1)
                starts = _cut(row, brk)
                own = batch.column("lang").take(pa.array(row[starts] if starts else [], pa.int64()))
                flat = pa.array(names, pa.string()).take(pa.array(code))
                yield pa.RecordBatch.from_arrays([own, _as_lists(flat, starts)], ["lang", "words"])

        split = materialise(rows.mapInArrow(words, "lang string, words array<string>").withColumn("rid", F.monotonically_increasing_id()), "colloc-texts")
        each = split.select("rid", "lang", F.size("words").alias("size"), F.posexplode("words").alias("place", "word"))
        return _rebuilt(each.join(ids, ["lang", "word"]).select("rid", "lang", "size", "place", "id"))
    known: dict[str, dict[str, int]] = {}
    for name, word, number in zip(*(c.to_pylist() for c in ids.select("lang", "word", "id").toArrow().columns)):
        known.setdefault(name, {})[word] = number
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", _TEXTS):
            for name, part in _by_lang(batch):
                own = shared.value.get(name, {})
                row, code, names = _words(part.column("text"))
                number = np.array([own.get(w, -1) for w in names], np.int64)
                starts = _cut(row, code == (names.index(_BREAK) if _BREAK in names else -1))
                flat = number[code] if len(code) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(starts), pa.string()), _as_lists(pa.array(flat), starts)], ["lang", "ids"])

    return rows.mapInArrow(numbers, "lang string, ids array<bigint>")


def _flat(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All sequences of a batch in a row, -1 after each; and where each one starts."""
    column = part.column("ids")
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    flat = np.full(int(sizes.sum()) + len(sizes), -1, np.int64)
    flat[np.arange(int(sizes.sum())) + np.repeat(np.arange(len(sizes)), sizes)] = column.flatten().to_numpy(zero_copy_only=False)
    return flat, starts


def pair_counts(sequences: DataFrame, width: int, bucket_bits: int, least: int) -> DataFrame:
    """(lang, bucket, left, right, f): neighbouring ids that stand side by side ``least`` times or more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def rows(lang: str, filters: list[QuotientFilter]) -> Iterator[pa.RecordBatch]:
            if filters:
                columns = [pa.array([lang] * len(filters), pa.string()), pa.array([f.bucket for f in filters], pa.int64()), pa.array([f.to_bytes() for f in filters], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "filter"])

        for batch in pieces(batches, "ids", _IDS):
            for lang, part in _by_lang(batch):
                flat, _ = _flat(part)
                both = np.flatnonzero((flat[:-1] >= 0) & (flat[1:] >= 0))
                counter = held.setdefault(lang, Counter(width, bucket_bits))
                yield from rows(lang, counter.add(flat[both], flat[both + 1]))
                if sum(c.held for c in held.values()) > 2 * counter.limit:  # many langs share the room of two
                    for name, each in held.items():
                        yield from rows(name, each.drain())
        for name, each in held.items():
            yield from rows(name, each.drain())

    def merge(table: pa.Table) -> pa.Table:
        merged = QuotientFilter.merge([QuotientFilter.from_bytes(raw) for raw in table.column("filter").to_pylist()])
        often = merged.counts >= least
        left, right = merged.pairs()
        n = int(often.sum())
        return pa.table({
            "lang": pa.array([table.column("lang")[0].as_py()] * n, pa.string()), "bucket": pa.array([merged.bucket] * n, pa.int64()),
            "left": left[often], "right": right[often], "f": merged.counts[often],
        })

    shards = sequences.mapInArrow(count, "lang string, bucket bigint, filter binary")
    return shards.groupBy("lang", "bucket").applyInArrow(merge, "lang string, bucket bigint, left bigint, right bigint, f bigint")


def pair_sequences(sequences: DataFrame, ids: DataFrame, broadcast_bytes: int = BROADCAST) -> DataFrame:
    """(lang, ids): the ids of neighbouring pairs, from (lang, left, right, id); rows without one are dropped."""
    ids = ids.select("lang", "left", "right", "id")
    if not _fits(ids, broadcast_bytes):
        split = materialise(sequences.withColumn("rid", F.monotonically_increasing_id()), "colloc-rows")
        after = F.expr("slice(ids, 2, greatest(size(ids) - 1, 0))")
        each = split.select("rid", "lang", F.size("ids").alias("size"), F.posexplode(F.arrays_zip(F.col("ids").alias("left"), after.alias("right"))).alias("place", "p"))
        pairs = each.select("rid", "lang", "size", "place", "p.left", "p.right").where("left >= 0 AND right >= 0")
        return _rebuilt(pairs.join(ids, ["lang", "left", "right"]).select("rid", "lang", "size", "place", "id"))
    table, known = ids.toArrow(), {}
    for lang, part in ((n, table.filter(pc.equal(table.column("lang"), n))) for n in pc.unique(table.column("lang")).to_pylist()):
        left, right, number = (part.column(c).to_numpy() for c in ("left", "right", "id"))
        key = left << 32 | right  # a table that fits has fewer than 2^31 ids below it
        order = np.argsort(key)
        known[lang] = key[order], number[order]
    shared = sequences.sparkSession.sparkContext.broadcast(known)

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "ids", _IDS):
            for lang, part in _by_lang(batch):
                if lang not in shared.value:
                    continue
                keys, number = shared.value[lang]
                flat, starts = _flat(part)
                out = np.full(len(flat), -1, np.int64)
                both = np.flatnonzero((flat[:-1] >= 0) & (flat[1:] >= 0))
                asked = flat[both] << 32 | flat[both + 1]
                place = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
                found = keys[place] == asked
                out[both[found]] = number[place[found]]
                lists = _as_lists(pa.array(out), starts.tolist())
                some = np.add.reduceat(out >= 0, starts) > 0 if len(starts) else np.zeros(0, bool)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * int(some.sum()), pa.string()), lists.filter(pa.array(some))], ["lang", "ids"])

    return sequences.mapInArrow(numbers, "lang string, ids array<bigint>")


def _bits(n: int) -> int:
    return max(1, int(n).bit_length())


def frequent_phrases(docs: DataFrame, least: int = 100, longest: int = 5, text: str = "text", lang: str = "lang", broadcast_bytes: int = BROADCAST) -> tuple[DataFrame, DataFrame]:
    """((lang, size, phrase, f), (lang, n)): all phrases of 1 to ``longest`` words with ``least`` or more occurrences, and all words.

    ``phrase`` joins its words with spaces. A null lang is ``und``, a null text is empty, repeated rows count apart.
    """
    with arrow_batches(docs.sparkSession, _TEXTS):  # every step that leaves the JVM is written inside
        return _levels(docs, least, longest, text, lang, broadcast_bytes)


def _levels(docs: DataFrame, least: int, longest: int, text: str, lang: str, broadcast_bytes: int) -> tuple[DataFrame, DataFrame]:
    counts = materialise(word_counts(docs, text, lang), "colloc-words")
    totals = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    often = counts.where(F.col("f") >= least)
    n_often, positions = often.agg(F.count("*"), F.coalesce(F.sum("f"), F.lit(0))).first()
    bucketed = often.withColumn("bucket", F.pmod(F.xxhash64("word"), F.lit(1 + n_often // 500_000)))
    words = materialise(_numbered(bucketed, ["word"]), "colloc-level")
    level = words.select("lang", "id", F.col("word").alias("phrase"), F.col("word").alias("last"), "f")
    levels = [level.select("lang", F.lit(1).alias("size"), "phrase", "f")]
    sequences = materialise(word_sequences(docs, words.select("lang", "word", "id"), text, lang, broadcast_bytes), "colloc-rows")
    for size in range(2, longest + 1):
        found = materialise(pair_counts(sequences, _bits(n_often), _bits(positions // BUCKET) - 1, least), "colloc-pairs")
        pairs = materialise(_numbered(found, ["left", "right"]), "colloc-level")
        n_often, positions = pairs.agg(F.count("*"), F.coalesce(F.sum("f"), F.lit(0))).first()
        if not n_often:
            break
        first, rest = level.select("lang", F.col("id").alias("left"), F.col("phrase").alias("_start")), level.select("lang", F.col("id").alias("right"), "last")
        named = pairs.join(first, ["lang", "left"]).join(rest, ["lang", "right"])
        level = materialise(named.select("lang", "id", F.concat_ws(" ", "_start", "last").alias("phrase"), "last", "f"), "colloc-names")
        levels.append(level.select("lang", F.lit(size).alias("size"), "phrase", "f"))
        if size < longest:
            sequences = materialise(pair_sequences(sequences, pairs, broadcast_bytes), "colloc-rows")
    every = levels[0]
    for each in levels[1:]:
        every = every.unionByName(each)
    return every, totals


def _part(start, length):
    return F.array_join(F.slice("words", start, length), " ")


def collocations(
    docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, cover: int = 100, text: str = "text", lang: str = "lang", broadcast_bytes: int = BROADCAST,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of every language.

    ``a`` counts the phrase, ``n`` all words; ``l`` and ``r`` count the parts of its worst cut, whose score is floor(1000 a n / (l r)). A phrase
    inside a longer one that has at least ``cover`` percent of its count is left out. Ties go by ``a``, then by the bytes of the phrase.
    Null langs are ``und``, null texts empty, ids are not read and repeated rows count apart; other columns are ignored, an empty table gives no rows.
    """
    every, totals = frequent_phrases(docs, least, longest, text, lang, broadcast_bytes)
    several = every.where("size > 1").withColumn("words", F.split("phrase", " "))
    cuts = several.select("lang", "phrase", "size", "f", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"), "words")
    cuts = cuts.select("lang", "phrase", "f", "k", _part(F.lit(1), F.col("k")).alias("head"), _part(F.col("k") + 1, F.col("size")).alias("tail"))
    head, tail = (every.select("lang", F.col("phrase").alias(name), F.col("f").alias(short)) for name, short in (("head", "l"), ("tail", "r")))
    scored = cuts.join(head, ["lang", "head"]).join(tail, ["lang", "tail"]).join(totals, "lang")
    wide = {c: f"CAST({c} AS decimal(19,0))" for c in ("f", "n", "l", "r")}
    score = F.expr(f"(CAST(1000 AS decimal(4,0)) * ({wide['f']} * {wide['n']})) DIV ({wide['l']} * {wide['r']})")
    worst = scored.groupBy("lang", "phrase", F.col("f").alias("a"), "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    spans = F.expr("flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), i -> array_join(slice(words, i, m), ' '))))")
    inner = several.where("size > 2").select("lang", F.explode(spans).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    left = worst.join(inner, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < cover * F.col("a"), F.lit(True)))
    flat = left.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    ranked = top_n(flat, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
