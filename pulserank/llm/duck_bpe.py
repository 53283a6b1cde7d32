"""Byte-level BPE by recursive queries: a rank file, DuckDB in every task, ordered aggregation.

Texts are cut into the matches of a pattern, and each match (a word) is encoded apart. In a task the distinct
words that its worker has not met become rows (word, pos, token), one per byte. A recursive query joins each
token and its right neighbour with the table of merges and contracts, word by word, the leftmost pair of
least rank, until no pair of a word is in the table. Decoding is an ordered aggregation of the tokens' bytes.

* The merges of a rank file are all splits of a token into two tokens; the rank of a merge is its token's.
* A word that is a token itself is that token, as the rule of rank files has it.
* In words above ``LONG`` bytes one round takes every occurrence of the least pair that the leftmost rule
  reaches anyway: all that do not overlap, from the left, unless the new token could start a merge of a
  lower rank (``risky``), when it takes the first only. Such words are also cut where two bytes meet that
  stand side by side in no token, since no merge can cross that place.
* A space after a character that is no white space always begins a match, and no match spans it. So texts are cut
  there first, by Arrow; only distinct chunks are searched with the pattern.

Memory: a task holds one slice of texts (4 MB), a long text is cut into segments of about 1 MB at such
spaces, at most ``BATCH`` words go into one query, and a worker remembers at most ``KNOWN`` words and fewer
chunks and decoded runs. A single match of the pattern is held whole.
"""
from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from pulserank.llm.common import column_free, pieces

LONG, SEGMENT, SLICE = 60, 1 << 20, 4 << 20
KNOWN, BATCH = 700_000, 50_000

#: A word's tokens lie at 64 * word and the places after it, without gaps; ``key`` orders its pairs by rank, then from the left.
_LEFTMOST = """
WITH RECURSIVE t(place, token, open) AS (
  SELECT word * 64 + pos, token, true FROM start
  UNION ALL (
    WITH pairs AS MATERIALIZED (
      SELECT n.place, n.token, m.rank::BIGINT << 32 | n.place AS key FROM (
        SELECT place, token, lead(token) OVER w AS next, lead(place) OVER w AS next_place FROM t WHERE open WINDOW w AS (ORDER BY place)) n
      LEFT JOIN merges m ON m.first = n.token AND m.second = n.next AND n.next_place = n.place + 1),
    least AS MATERIALIZED (SELECT place >> 6 AS word, min(key) AS key, min(key) & 4294967295 AS chosen FROM pairs GROUP BY ALL)
    SELECT place - coalesce(place > chosen, false)::INT, CASE WHEN p.key = l.key THEN (l.key >> 32)::INT ELSE token END, l.key IS NOT NULL
    FROM pairs p JOIN least l ON l.word = place >> 6 WHERE place IS DISTINCT FROM chosen + 1))
SELECT place >> 6 AS word, token FROM t WHERE NOT open ORDER BY place
"""
#: Long words have places of their own. All pairs of the least rank that do not overlap are taken, or the first if its token is risky.
_ALL_LEAST = """
WITH RECURSIVE t(word, pos, token, open) AS (
  SELECT word, pos, token, true FROM start
  UNION ALL (
    WITH pairs AS MATERIALIZED (
      SELECT n.*, m.rank, m.risky, m.rank::BIGINT << 32 | pos AS key FROM (
        SELECT word, pos, token, lead(token) OVER w AS next, lead(pos) OVER w AS next_pos FROM t WHERE open
        WINDOW w AS (PARTITION BY word ORDER BY pos)) n
      LEFT JOIN merges m ON m.first = n.token AND m.second = n.next),
    least AS MATERIALIZED (SELECT word, min(key) AS key FROM pairs GROUP BY word),
    runs AS (
      SELECT *, place - row_number() OVER (PARTITION BY word ORDER BY pos) AS run FROM (
        SELECT p.*, l.key AS least, row_number() OVER (PARTITION BY word ORDER BY pos) AS place FROM pairs p JOIN least l USING (word))
      WHERE rank = least >> 32),
    chosen AS MATERIALIZED (
      SELECT word, pos, next_pos, rank FROM (SELECT *, row_number() OVER (PARTITION BY word, run ORDER BY pos) AS run_place FROM runs)
      WHERE run_place % 2 = 1 AND (NOT risky OR key = least))
    SELECT p.word, p.pos, coalesce(c.rank, p.token), l.key IS NOT NULL
    FROM pairs p JOIN least l USING (word) LEFT JOIN chosen c ON c.word = p.word AND c.pos = p.pos
    WHERE NOT EXISTS (FROM chosen g WHERE g.word = p.word AND g.next_pos = p.pos)))
SELECT word, token FROM t WHERE NOT open ORDER BY word, pos
"""


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


class _Kept(dict):
    """At most ``limit`` entries; the older half goes when there are more."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit = limit

    def trim(self) -> None:
        if len(self) > self.limit:
            for key in list(islice(self, len(self) - self.limit // 2)):
                del self[key]


class Codec:
    """A rank file as tables of an in-memory DuckDB connection."""

    def __init__(self, path: str, pattern: str, known: int = KNOWN):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.findall = regex.compile(pattern).findall
        self.odd = regex.compile(r"\s ").search
        self.cut = regex.compile(r"(?<=\S) ").search
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.words, self.chunks, self.runs = _Kept(known), _Kept(known // 3), _Kept(known // 2)
        merges, beside = [], np.zeros(1 << 16, bool)
        for token, rank in self.ranks.items():
            for at in range(1, len(token)):
                beside[token[at - 1] << 8 | token[at]] = True
                first, second = self.ranks.get(token[:at]), self.ranks.get(token[at:])
                if first is not None and second is not None:
                    merges.append((first, second, rank))
        self.beside = beside
        least = np.full(max(self.ranks.values()) + 1, np.iinfo(np.int32).max)
        first, second, rank = np.array(merges, np.int32).reshape(-1, 3).T
        for part in (first, second):
            np.minimum.at(least, part, rank)
        self.spaced = np.zeros(len(least), bool)
        self.spaced[[r for t, r in self.ranks.items() if t[:1] == b" "]] = True
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "320MB", "temp_directory": ""})
        self._table("merges", first=first, second=second, rank=rank, risky=least[rank] < rank)
        self._table("tokens", id=np.fromiter(self.ranks.values(), np.int32), spelled=[t.hex() for t in self.ranks])

    def _table(self, name: str, **columns) -> None:
        self.db.register("_rows", pa.table({k: pa.array(v) for k, v in columns.items()}))
        self.db.sql(f"CREATE OR REPLACE TEMP TABLE {name} AS FROM _rows")
        self.db.unregister("_rows")

    def _contract(self, parts: list[bytes], query: str) -> tuple[np.ndarray, np.ndarray]:
        """(part, token) of each token, in order."""
        sizes = np.array([len(p) for p in parts])
        word = np.repeat(np.arange(len(parts), dtype=np.int32), sizes)
        pos = np.arange(len(word), dtype=np.int32) - np.repeat(np.cumsum(sizes) - sizes, sizes).astype(np.int32)
        self._table("start", word=word, pos=pos, token=self.bytes[np.frombuffer(b"".join(parts), np.uint8)])
        done = self.db.sql(query).fetchnumpy()
        return done["word"], done["token"]

    def _learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        """The packed tokens of each word."""
        found = {w: np.int32(self.ranks[w]).tobytes() for w in words if w in self.ranks}
        short = [w for w in words if w not in found and len(w) <= LONG]
        self._collect(found, short, range(len(short)), short, _LEFTMOST)
        owners, parts, long = [], [], [w for w in words if w not in found and len(w) > LONG]
        for i, w in enumerate(long):
            row = np.frombuffer(w, np.uint8).astype(np.int32)
            ends = [0, *(np.flatnonzero(~self.beside[row[:-1] << 8 | row[1:]]) + 1).tolist(), len(w)]
            parts += [w[a:b] for a, b in zip(ends, ends[1:])]
            owners += [i] * (len(ends) - 1)
        self._collect(found, long, owners, parts, _ALL_LEAST)
        return found

    def _collect(self, found: dict, words: list[bytes], owners, parts: list[bytes], query: str) -> None:
        if not parts:
            return
        part, token = self._contract(parts, query)
        owner = np.asarray(owners, np.int64)[part]
        ends = np.searchsorted(owner, np.arange(len(words) + 1))
        for word, a, b in zip(words, ends, ends[1:]):
            found[word] = token[a:b].astype(np.int32).tobytes()

    def _spell(self, chunks: list[str]) -> list[bytes]:
        """The packed tokens of each chunk."""
        known, findall = self.words, self.findall
        packed = [known.get(c) or self.chunks.get(c) for c in chunks]  # most chunks are a word, or were met before
        unmet = [i for i, p in enumerate(packed) if p is None]
        split = [findall(chunks[i]) for i in unmet]
        new = [w for w in dict.fromkeys(chain.from_iterable(split)) if w not in known]
        for at in range(0, len(new), BATCH):
            part = new[at:at + BATCH]
            coded = [w.encode("utf-8", "replace") for w in part]
            learned = self._learn(coded)
            known.update(zip(part, map(learned.__getitem__, coded)))
        for i, words in zip(unmet, split):
            packed[i] = known[words[0]] if len(words) == 1 else b"".join(map(known.__getitem__, words))
        self.chunks.update((chunks[i], packed[i]) for i in unmet if len(chunks[i]) <= 100)
        for word in new:
            if len(word) > 100:
                del known[word]
        known.trim()
        self.chunks.trim()
        return packed

    def _segments(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > SEGMENT:
            place = self.cut(text, at + SEGMENT)
            if place is None:
                break
            yield text[at:place.start()]
            at = place.start()
        yield text[at:]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ends, ids): the tokens of all texts in a row, those of text i from ends[i] to ends[i + 1]."""
        owners, whole = [], []
        for i, text in enumerate(texts):
            for segment in self._segments(text or ""):
                owners.append(i)
                whole.append(segment)
        odd = [bool(self.odd(s)) for s in whole]
        split = pc.split_pattern(pa.array(["" if o else s for s, o in zip(whole, odd)], pa.large_string()), " ")
        starts = split.offsets.to_numpy()
        coded = split.flatten().dictionary_encode()
        chunks = [" " + c for c in coded.dictionary.to_pylist()]  # a chunk after the first has its space
        code, owner = coded.indices.to_numpy().astype(np.int64), np.repeat(np.arange(len(whole)), np.diff(starts))
        code[starts[:-1]] = len(chunks) + np.arange(len(whole))
        chunks += [s[:p] if (p := s.find(" ")) >= 0 and not o else s for s, o in zip(whole, odd)]
        ids, each = _gathered(self._spell(chunks), code, np.int32)
        per_text = np.bincount(np.asarray(owners)[owner], each, len(texts)).astype(np.int64)
        return np.concatenate([[0], np.cumsum(per_text)]), ids

    def decode(self, ends: np.ndarray, ids: np.ndarray) -> list[bytes]:
        """The bytes that the tokens of each text spell; a run that begins with a space is spelled once."""
        if not len(ids):
            return [b""] * (len(ends) - 1)
        ids = np.ascontiguousarray(ids, np.int32)
        fresh = self.spaced[ids]
        fresh[ends[:-1][ends[:-1] < len(ids)]] = True
        starts = np.flatnonzero(fresh)
        offsets = np.append(starts, len(ids)).astype(np.int64) * 4
        runs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(ids)]).dictionary_encode()
        keys = runs.dictionary.to_pylist()
        new = [k for k in keys if k not in self.runs]
        for at in range(0, len(new), BATCH):
            part = new[at:at + BATCH]
            sizes = np.array([len(k) >> 2 for k in part], np.int64)
            self._table("spell", run=np.repeat(np.arange(len(part), dtype=np.int32), sizes), pos=np.arange(sizes.sum(), dtype=np.int32), id=np.frombuffer(b"".join(part), np.int32))
            done = self.db.sql("SELECT string_agg(spelled, '' ORDER BY pos) AS s FROM spell JOIN tokens USING (id) GROUP BY run ORDER BY run").fetchall()
            self.runs.update(zip(part, [bytes.fromhex(spelled) for spelled, in done]))
        spelled = [self.runs[k] for k in keys]
        for key in new:
            if len(key) > 400:
                del self.runs[key]
        self.runs.trim()
        flat, sizes = _gathered(spelled, runs.indices.to_numpy(), np.uint8)
        raw, places = flat.tobytes(), np.append(np.cumsum(sizes) - sizes, len(flat))[np.searchsorted(starts, ends)].tolist()
        return [raw[a:b] for a, b in zip(places, places[1:])]


def _gathered(parts: list[bytes], code: np.ndarray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The values of ``parts`` in the order of ``code``, and how many each has."""
    width = np.dtype(kind).itemsize
    sizes = np.array([len(p) // width for p in parts], np.int64)
    each = sizes[code]
    ends = np.cumsum(each)
    place = np.repeat((np.cumsum(sizes) - sizes)[code] - (ends - each), each)
    place += np.arange(len(place))
    return np.frombuffer(b"".join(parts), kind)[place], each


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec per process: a worker's later tasks find what its earlier ones have met."""
    return Codec(path, pattern)


def _lists(ends: np.ndarray, ids: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids, pa.int32()))


def encode(docs: DataFrame, text: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``docs`` with ``ids`` (array of int): the tokens of each whole text, without special tokens.

    Null and empty texts have none, repeated rows get equal results, an empty table gives an empty one. If ``docs`` has a
    column of that name the new one starts with an underscore. Other columns pass.
    """
    path, pattern, name = path or default_path(), pattern or default_pattern(), column_free(docs, "ids")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(rows, text, SLICE):
            found = _lists(*codec(path, pattern).encode(part.column(text).to_pylist()))
            yield pa.RecordBatch.from_arrays([*part.columns, found], [*part.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(T.IntegerType()))]))


def decode(rows: DataFrame, ids: str = "ids", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``rows`` with ``decoded`` (binary): the bytes of the tokens in ``ids``; null and empty lists spell no byte.

    A clash of names is solved as in :func:`encode`. An id that is in no rank is an error.
    """
    path, pattern, name = path or default_path(), pattern or default_pattern(), column_free(rows, "decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, ids, SLICE):
            column = part.column(ids)
            ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False))]).astype(np.int64)
            found = codec(path, pattern).decode(ends, column.flatten().to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.binary())], [*part.schema.names, name])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(name, T.BinaryType())]))


def round_trip(docs: DataFrame, text: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``docs`` without ``text``, with ``packed`` (ids as little-endian unsigned 32-bit integers) and ``decoded`` (binary).

    Both steps run in one Python process; cases as in :func:`encode`.
    """
    path, pattern = path or default_path(), pattern or default_pattern()
    names = [column_free(docs, "packed"), column_free(docs, "decoded")]
    kept = [f for f in docs.schema.fields if f.name != text]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for part in pieces(rows, text, SLICE):
            ends, ids = own.encode(part.column(text).to_pylist())
            raw = ids.astype("<u4").tobytes()
            packed = pa.array([raw[a * 4:b * 4] for a, b in zip(ends, ends[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in kept), packed, pa.array(own.decode(ends, ids), pa.binary())], [*(f.name for f in kept), *names])

    return docs.mapInArrow(run, T.StructType([*kept, *(T.StructField(n, T.BinaryType()) for n in names)]))


def digests(rows: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of :func:`round_trip`."""
    return rows.select(
        "doc_id", (F.octet_length("packed") / 4).cast("bigint").alias("n_tokens"), F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
