"""Spelling variants: words one edit apart, found by Gram matrices of letter counts between adjacent blocks.

One inserted or deleted letter moves the letter counts of a word by a squared distance of 1, one replaced letter by 2. So
words are put into blocks by their length, and within a length by how many letters of each of a few letter groups they
hold. An edit leads to the same block or to an adjacent one: one letter more in a group, or one more and one less. A task multiplies
the letter-count matrix of a block with those of its adjacent blocks, keeps pairs at a squared distance of at most 2, and
verifies the edit letter by letter. Blocks above ``tile`` words are dealt in tiles, so a hot block is many tasks.

No pair of words is handed on: a task returns, per word, how many near words it found and the most frequent one of them.
The number of letter groups follows the number of words and changes no result.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pulserank.llm.collocations import LOWER, UPPER
from pulserank.llm.common import materialise

#: Fixed by the contract: what a run of letters is.
RUN = "[A-Za-zÀ-ÿ]+"
#: Letters by how common they are in many languages; only the balance of the blocks depends on it.
COMMON = "etaoinsrhldcumfpgwybvkxjqz"
LETTERS = LOWER + UPPER + "".join(map(chr, range(0xC0, 0x100)))
_INDEX = np.full(256, -1, np.int64)
_INDEX[[ord(c) for c in LETTERS]] = np.arange(len(LETTERS))
_CELLS, _COMPARED = 4_000_000, 32_000_000


def words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", every: int = 97, shortest: int = 5, least: int = 3) -> DataFrame:
    """(word, n): runs of letters with A-Z lowered; where ``every`` divides crc32 of ``<doc_id>:<run>`` a letter of the run is left out."""
    rows = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    runs = rows.select("id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run")).where(F.length("run") >= shortest)
    low = F.translate("run", UPPER, LOWER)
    coded = runs.select(low.alias("run"), F.crc32(F.concat_ws(":", "id", low).cast("binary")).alias("h"))
    place = F.pmod("h", F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    word = F.when(F.col("h") % every == 0, cut).otherwise(F.col("run"))
    return coded.select(word.alias("word")).where(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def _key(groups: int) -> Column:
    """The number of letters of each group, joined by commas."""
    order = COMMON + "".join(c for c in LETTERS if c not in COMMON)
    return F.concat_ws(",", *((F.length("word") - F.length(F.translate("word", order[g::groups], ""))).cast("string") for g in range(groups)))


def _hosts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every block with the blocks that it visits: those that lead to it by an added letter, or by a letter moved to a lower group."""
    for batch in batches:
        host, guest, tiles = [], [], []
        for key, n in zip(batch.column("key").to_pylist(), batch.column("tiles").to_pylist()):
            counts = list(map(int, key.split(",")))
            for i, own in enumerate(counts):
                if own:
                    less = counts[:i] + [own - 1] + counts[i + 1:]
                    moved = [less[:j] + [less[j] + 1] + less[j + 1:] for j in range(i + 1, len(less))]
                    host += [",".join(map(str, c)) for c in [less, *moved]]
            host.append(key)
            guest += [key] * (len(host) - len(guest))
            tiles += [n] * (len(host) - len(tiles))
        yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(guest, pa.string()), pa.array(tiles, pa.int64())], ["host", "guest", "guest_tiles"])


def _spelled(names: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(names), np.uint8).reshape(len(names), -1)


def _letter_counts(spelled: np.ndarray) -> np.ndarray:
    n, length = spelled.shape
    flat = np.repeat(np.arange(n), length) * len(LETTERS) + _INDEX[spelled].ravel()
    exact = np.float32 if length <= 4000 else np.float64  # sums of squares stay below 2^24
    return np.bincount(flat, minlength=n * len(LETTERS)).reshape(n, -1).astype(exact)


def _edited(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether each row of ``long`` is its row of ``short`` with one letter replaced (equal lengths) or inserted."""
    length = short.shape[1]
    differs = short != long[:, :length]
    if long.shape[1] == length:
        return differs.sum(1) == 1
    first = np.where(differs.any(1), differs.argmax(1), length)
    moved = (short != long[:, 1:])[:, ::-1]
    last = np.where(moved.any(1), length - moved.argmax(1), 0)
    return last <= first


def near_pairs(left: np.ndarray, right: np.ndarray, same: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) one edit apart, of words of one length and words of that length or one more; i < j if ``same``."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    x = _letter_counts(left)
    own = (x * x).sum(1)
    step = max(1, _CELLS // max(1, len(left)))
    for at in range(0, len(right), step):
        part = right[at:at + step]
        y = _letter_counts(part)
        distance = own[:, None] + (y * y).sum(1)[None, :].astype(x.dtype) - 2 * (x @ y.T.astype(x.dtype))
        i, j = np.nonzero((distance <= 2) & (distance > 0))
        if same:
            i, j = i[i < j + at], j[i < j + at]
        checked = max(1, _COMPARED // left.shape[1])
        for k in range(0, len(i), checked):
            a, b = i[k:k + checked], j[k:k + checked]
            good = _edited(left[a], part[b])
            found.append((a[good], b[good] + at))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


_FOUND = "word string, near bigint, best_n bigint, best string"


def _compare(key: tuple, table: pa.Table) -> pa.Table:
    """The home tile of a block against its guests, and against itself where both tiles have one number."""
    names = [w.encode("latin-1") for w in table.column("word").to_pylist()]
    counts = table.column("n").to_numpy()
    side = table.column("side").to_numpy()
    sizes = np.array([len(w) for w in names])
    home = np.flatnonzero(side == 0)
    pairs = []
    if len(home):
        left = _spelled([names[i] for i in home])
        if key[1].as_py() == key[2].as_py():
            a, b = near_pairs(left, left, same=True)
            pairs.append((home[a], home[b]))
        for length in (left.shape[1], left.shape[1] + 1):
            guests = np.flatnonzero((side == 1) & (sizes == length))
            if len(guests):
                a, b = near_pairs(left, _spelled([names[i] for i in guests]))
                pairs.append((home[a], guests[b]))
    a = np.concatenate([p[0] for p in pairs] + [p[1] for p in pairs]) if pairs else np.zeros(0, np.int64)
    b = np.concatenate([p[1] for p in pairs] + [p[0] for p in pairs]) if pairs else np.zeros(0, np.int64)
    place = np.empty(len(names), np.int64)
    place[sorted(range(len(names)), key=names.__getitem__)] = np.arange(len(names))
    order = np.lexsort((place[b], -counts[b], a))
    a, b = a[order], b[order]
    starts = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.zeros(0, np.int64)
    near = np.diff(np.append(starts, len(a)))
    text = table.column("word")
    return pa.table({"word": text.take(pa.array(a[starts])), "near": near.astype(np.int64), "best_n": counts[b[starts]], "best": text.take(pa.array(b[starts]))})


def near_words(counted: DataFrame, tile: int = 2048, groups: int | None = None) -> DataFrame:
    """(word, near, best_n, best) of every word of (word, n) that has near words.

    ``near`` counts the words exactly one edit away; ``best`` is the one of largest n, the smallest of equals.
    """
    if groups is None:
        groups = max(2, min(8, round(math.log10(max(10, counted.count()))) - 1))
    keyed = counted.select("word", "n", _key(groups).alias("key"))
    blocks = materialise(keyed.groupBy("key").agg(F.count("*").alias("size")).select("key", F.ceil(F.col("size") / tile).cast("bigint").alias("tiles")), "spelling-blocks")
    visits = blocks.mapInArrow(_hosts, "host string, guest string, guest_tiles bigint")
    met = materialise(visits.join(blocks.select(F.col("key").alias("host"), F.col("tiles").alias("host_tiles")), "host"), "spelling-visits")
    dealt = keyed.join(blocks, "key").select("word", "n", "key", F.pmod(F.xxhash64("word"), F.col("tiles")).alias("tile"))
    most = met.groupBy(F.col("host").alias("key")).agg(F.max("guest_tiles").alias("most"))
    homes = dealt.join(most, "key").select(
        "key", F.col("tile").alias("home"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("most") - 1)).alias("visitor"), F.lit(0).alias("side"), "word", "n",
    )
    of = dealt.join(met.withColumnRenamed("guest", "key"), "key").select(
        F.col("host").alias("key"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("host_tiles") - 1)).alias("home"), F.col("tile").alias("visitor"),
        F.lit(1).alias("side"), "word", "n", (F.col("host") == F.col("key")).alias("own"),
    )
    guests = of.where("NOT own OR home < visitor").drop("own")
    found = homes.unionByName(guests).groupBy("key", "home", "visitor").applyInArrow(_compare, _FOUND)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best")))
    merged = found.groupBy("word").agg(F.sum("near").alias("near"), best.alias("b"))
    return merged.select("word", "near", (-F.col("b.less")).alias("best_n"), "b.best")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): the end of each chain, by doubling. Counts at least double along a chain, so there are no rings."""
    current = materialise(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = materialise(current.join(ahead, "root", "left"), "spelling-roots")
        current = joined.select("word", F.coalesce("next", "root").alias("root"))
        if joined.where("next IS NOT NULL").isEmpty():
            return current


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tile: int = 2048, groups: int | None = None, every: int = 97, shortest: int = 5, least: int = 3) -> DataFrame:
    """(word, n, n_near, form, form_n, root): the words of :func:`words` and what each is probably a variant of.

    A word's form is its near word of largest n (ties: smallest in code-point order) if that is at least twice its own n;
    its root is the last form along the chain, or the word itself. Null texts have no words, a null id counts as an empty one, repeated rows
    count apart, other columns are ignored, an empty table gives no rows. Long runs are words like others.
    """
    counted = materialise(words(docs, doc_id, text, every, shortest, least), "spelling-words")
    near = materialise(near_words(counted, tile, groups), "spelling-near")
    far = F.coalesce(F.col("best_n") >= 2 * F.col("n"), F.lit(False))
    rows = counted.join(near, "word", "left").select(
        "word", "n", F.coalesce("near", F.lit(0)).cast("bigint").alias("n_near"), F.when(far, F.col("best")).alias("form"), F.when(far, F.col("best_n")).alias("form_n"),
    )
    roots = _roots(rows.where("form IS NOT NULL"))
    return rows.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
