"""A distributed positional inverted index, and exact phrase and proximity search in it.

The index is sharded by documents. A shard holds the postings of a few megabytes of text: for each
term the increasing positions at which it stands, counted through the shard, with a free position
between documents. Building and searching need no shuffle, a lost executor costs its shards only, and
a stored index serves any number of test sets.

A phrase is found by intersecting the lists of its terms, each moved by the term's offset in the
phrase, from the term that is rarest in the shard onwards. Most phrases end at the first lookup.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pulserank.llm.common import pieces

#: Bytes of test text that are handed to the tasks at once; larger test sets are searched in blocks of this size.
BLOCK_BYTES = 8 << 20
_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Runs of digits, letters and characters beyond 127, A-Z lowered; null has none."""
    return (text or "").encode("utf-8", "replace").translate(_WORDS).split()


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", terms: set[bytes] | None = None) -> DataFrame:
    """The index of ``docs``, a row per shard: doc_ids, starts, n_words, terms, ends, positions.

    ``terms`` limits the postings to these terms (for a test set that is known beforehand); document
    lengths always count all words. Rows of a null or empty text have no postings, repeated rows and ids are indexed apart,
    other columns are ignored, an empty table has no shard.
    """
    kind = docs.schema[doc_id].dataType
    schema = T.StructType([
        T.StructField("doc_ids", T.ArrayType(kind)), T.StructField("starts", T.ArrayType(T.IntegerType())),
        T.StructField("n_words", T.ArrayType(T.IntegerType())), T.StructField("terms", T.ArrayType(T.BinaryType())),
        T.StructField("ends", T.ArrayType(T.IntegerType())), T.StructField("positions", T.ArrayType(T.IntegerType())),
    ])
    known = {t: i for i, t in enumerate(sorted(terms))} if terms is not None else None

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, text):
            ids = dict(known) if known is not None else {}
            codes, lengths = [], []
            for value in part.column(text).to_pylist():
                words = words_of(value)
                if known is None:
                    for word in words:
                        if word not in ids:
                            ids[word] = len(ids)
                    found = map(ids.__getitem__, words)
                else:
                    found = (ids.get(w, -1) for w in words)
                codes.append(np.fromiter(found, np.int64, len(words)))
                lengths.append(len(words))
            starts = np.concatenate([[0], np.cumsum(np.add(lengths, 1))])[:-1]
            code = np.concatenate(codes)
            at = np.arange(len(code)) + np.repeat(np.arange(len(lengths)), lengths)  # a free position after each document
            held = code >= 0
            code, at = code[held], at[held]
            order = np.argsort(code, kind="stable")
            counts = np.bincount(code, minlength=len(ids))
            present = np.flatnonzero(counts)
            names = list(ids)
            row = {
                "doc_ids": part.column(doc_id).to_pylist(), "starts": starts, "n_words": lengths,
                "terms": [names[i] for i in present], "ends": np.cumsum(counts[present]), "positions": at[order],
            }
            yield pa.RecordBatch.from_arrays([
                pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v, t))
                for v, t in zip(row.values(), (part.schema.field(doc_id).type, *(pa.int32(),) * 2, pa.binary(), *(pa.int32(),) * 2))
            ], list(row))

    return docs.select(doc_id, text).mapInArrow(shards, schema)


class _Shard:
    def __init__(self, row: dict):
        self.doc_ids, self.terms = row["doc_ids"], row["terms"]
        self.starts, self.n_words, self.ends, self.positions = (row[k] for k in ("starts", "n_words", "ends", "positions"))
        self.begins = np.concatenate([[0], self.ends])[:-1] if len(self.ends) else self.ends

    def postings(self, i: int) -> np.ndarray:
        return self.positions[self.begins[i]:self.ends[i]]

    def places(self, vocabulary: dict[bytes, int]) -> np.ndarray:
        """For each code of ``vocabulary`` its place among the shard's terms, -1 if it has none."""
        place = np.full(len(vocabulary), -1)
        for i, term in enumerate(self.terms):
            code = vocabulary.get(term)
            if code is not None:
                place[code] = i
        return place

    def document(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, at, "right") - 1


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[_Shard]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {}
            for name in batch.schema.names:
                value = batch.column(name)[i].values
                row[name] = value.to_pylist() if name in ("doc_ids", "terms") else value.to_numpy(zero_copy_only=False)
            yield _Shard(row)


def _held(postings: np.ndarray, at: np.ndarray) -> np.ndarray:
    i = np.searchsorted(postings, at)
    return postings[np.minimum(i, len(postings) - 1)] == at


class Phrases:
    """The windows of test items: ``width`` consecutive words each, an item of fewer (but not none) is one window."""

    def __init__(self, items: list[tuple[object, str | None]], width: int):
        self.item_ids = [i for i, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        by_length: dict[int, list[tuple[int, int, list[int]]]] = {}
        for item, (_, text) in enumerate(items):
            codes = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text)]
            size = min(width, len(codes))
            for offset in range(len(codes) - size + 1 if size else 0):
                by_length.setdefault(size, []).append((item, offset, codes[offset:offset + size]))
        self.groups = [
            (n, np.array([w[0] for w in ws]), np.array([w[1] for w in ws]), np.array([w[2] for w in ws])) for n, ws in by_length.items()
        ]

    def spans(self, shard: _Shard) -> list[tuple[int, int, int, int]]:
        """(item, item_start, start, length) of the longest shared passages; start is the shard's position."""
        place = shard.places(self.vocabulary)
        sizes = np.append(shard.ends - shard.begins, 0)[place]  # place -1 is the appended zero
        out = []
        for width, items, offsets, codes in self.groups:
            often = sizes[codes]
            hits = []
            for w in np.flatnonzero(often.min(axis=1) > 0):
                order = np.argsort(often[w], kind="stable")
                at = shard.postings(place[codes[w, order[0]]]) - order[0]
                for o in order[1:]:
                    at = at[_held(shard.postings(place[codes[w, o]]), at + o)]
                    if not len(at):
                        break
                if len(at):
                    hits.append(np.stack([np.full(len(at), items[w]), at - offsets[w], np.full(len(at), offsets[w])]))
            if hits:
                item, diagonal, offset = np.concatenate(hits, axis=1)
                order = np.lexsort((offset, diagonal, item))
                item, diagonal, offset = item[order], diagonal[order], offset[order]
                first = np.append(True, (np.diff(item) != 0) | (np.diff(diagonal) != 0) | (np.diff(offset) != 1))
                begin = np.flatnonzero(first)
                last = np.append(begin[1:], len(item)) - 1
                length = offset[last] - offset[begin] + width
                out += zip(item[begin].tolist(), offset[begin].tolist(), (diagonal + offset)[begin].tolist(), length.tolist())
        return out


def blocks_of(items: DataFrame, item_id: str, text: str) -> list[DataFrame]:
    """``items`` in parts of about BLOCK_BYTES of text, by a hash of the id."""
    size = items.agg(F.sum(F.octet_length(text))).first()[0] or 0
    count = max(1, -(-size // BLOCK_BYTES))
    part = F.pmod(F.xxhash64(item_id), F.lit(count))
    return [items.where(part == i) if count > 1 else items for i in range(count)]


def test_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> set[bytes] | None:
    """The terms of a test set of one block, else None: then the index holds all terms."""
    if len(blocks_of(items, item_id, text)) > 1:
        return None
    return {w for row in items.select(text).collect() for w in words_of(row[0])}


def find_phrases(
    index: DataFrame, items: DataFrame, width: int = 10, item_id: str = "item_id", text: str = "text",
) -> DataFrame:
    """A row per indexed document: doc_id, n_words, spans.

    ``spans``: array of (item_id, item_start, start, length), in words from 0: every longest passage whose windows of
    ``width`` words are consecutive windows of the item. Documents without spans have an empty array. Items of no words
    match nothing; repeated items are reported apart.
    """
    kind = index.schema["doc_ids"].dataType.elementType
    span = T.StructType([
        T.StructField("start", T.IntegerType()), T.StructField("length", T.IntegerType()),
        T.StructField("item_id", items.schema[item_id].dataType), T.StructField("item_start", T.IntegerType()),
    ])
    schema = T.StructType([
        T.StructField("doc_id", kind), T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(span)),
        T.StructField("row", T.LongType()),
    ])
    blocks = blocks_of(items, item_id, text)
    results = []
    for block in blocks:
        phrases = Phrases([tuple(r) for r in block.select(item_id, text).collect()], width)
        results.append(index.mapInArrow(_searcher(phrases, schema), schema))
    found = results[0]
    if len(blocks) > 1:
        for other in results[1:]:
            found = found.unionByName(other)
        spans = F.flatten(F.collect_list("spans")).alias("spans")
        found = found.groupBy("row", "doc_id", "n_words").agg(spans).select("doc_id", "n_words", "spans", "row")
    return found.drop("row")


def _searcher(phrases: Phrases, schema: T.StructType):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(schema)
        for shard in _shards(batches):
            rows = [[] for _ in shard.doc_ids]
            found = phrases.spans(shard)
            if found:
                documents = shard.document(np.array([s[2] for s in found]))
                for document, (item, item_start, start, length) in zip(documents.tolist(), found):
                    rows[document].append({
                        "start": start - int(shard.starts[document]), "length": length,
                        "item_id": phrases.item_ids[item], "item_start": item_start,
                    })
            # tells equal rows apart when the results of blocks are joined
            seed = zlib.crc32(repr(shard.doc_ids).encode(), zlib.crc32(shard.positions.tobytes()))
            yield pa.RecordBatch.from_arrays([
                pa.array(shard.doc_ids, target.field("doc_id").type), pa.array(shard.n_words, pa.int64()),
                pa.array(rows, target.field("spans").type), pa.array([(seed << 20) + i for i in range(len(rows))], pa.int64()),
            ], schema=target)

    return search


def find_near(index: DataFrame, queries: list[list[str]], slop: int) -> DataFrame:
    """(doc_id, query, start, end): the places where all terms of a query stand within ``slop`` words.

    For each possible first word the nearest following place of every other term is taken; ``end`` is exclusive.
    ``query`` is the place in ``queries``. A query of no terms matches nothing.
    """
    kind = index.schema["doc_ids"].dataType.elementType
    schema = T.StructType([
        T.StructField("doc_id", kind), *(T.StructField(n, T.IntegerType()) for n in ("query", "start", "end"))
    ])
    wanted = [sorted({w for part in q for w in words_of(part)}) for q in queries]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches):
            place = {t: i for i, t in enumerate(shard.terms)}
            out = {"doc_id": [], "query": [], "start": [], "end": []}
            for number, terms in enumerate(wanted):
                if not terms or any(t not in place for t in terms):
                    continue
                lists = sorted((shard.postings(place[t]) for t in terms), key=len)
                first = np.unique(np.concatenate(lists))
                near = np.searchsorted(lists[0], first)
                ahead = np.append(lists[0], np.iinfo(np.int32).max)[near]
                first = first[ahead - first < slop]
                end = first.copy()
                for postings in lists:
                    following = np.append(postings, np.iinfo(np.int32).max)[np.searchsorted(postings, first)]
                    end = np.maximum(end, following)
                fits = end - first < slop
                first, end = first[fits], end[fits]
                same = shard.document(first) == shard.document(end)
                first, end = first[same], end[same]
                document = shard.document(first)
                out["doc_id"] += [shard.doc_ids[d] for d in document]
                out["query"] += [number] * len(first)
                out["start"] += (first - shard.starts[document]).tolist()
                out["end"] += (end + 1 - shard.starts[document]).tolist()
            if out["query"]:
                yield pa.RecordBatch.from_pydict(out, schema=to_arrow_schema(schema))

    return index.mapInArrow(search, schema)


def hit_words(spans: Column) -> Column:
    """How many words the spans of a document cover together."""
    state = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    ordered = F.array_sort(spans)  # by start, then length

    def step(s, x):
        stop = x["start"] + x["length"]
        return F.struct(
            F.greatest(s["end"], stop).alias("end"), (s["n"] + F.greatest(F.lit(0), stop - F.greatest(s["end"], x["start"]))).alias("n")
        )

    covered = F.aggregate(ordered, state, step, lambda s: s["n"])
    return F.when(F.size(spans) == 0, 0).otherwise(covered).cast("bigint")


def item_names(spans: Column) -> Column:
    """The ids of the spans' items as text, each once, in text order."""
    return F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["item_id"].cast("string"))))
