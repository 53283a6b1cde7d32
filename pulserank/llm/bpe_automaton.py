"""Byte-pair encoding by a deterministic automaton over tokens.

The automaton starts with one state per byte and arcs between all of them. Merges are compiled one
after another, each as a gadget. The merge of ``u`` and ``v`` into ``w``

* adds the state ``w``, which leaves with the arcs that ``v`` has at that moment,
* adds an arc labelled ``w`` to each state that has one labelled ``u``, and
* cuts the arc from ``u`` labelled ``v``.

What remains accepts exactly the token sequences that applying the merges in order produces, so a
word has one path. Copying arcs 50,000 times would need gigabytes; a gadget is therefore kept as its
difference: the state it copies, the label it follows, its time and the arc it cuts. A lookup of an
arc resolves the gadgets backwards in time and enters the answer in the transition table, from which
later words are encoded. Decoding emits the labels of the arcs.
"""
from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from pulserank.llm.common import column_free, pieces

#: Fixed: the pattern by which the byte-level vocabulary splits text before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
START = -1
#: Chunks of text whose tokens a worker remembers, in each of two generations, and arcs in its transition table.
CHUNKS, ARCS = 120_000, 200_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    others = (b for b in range(256) if b not in set(plain))
    return letters | {chr(256 + i): b for i, b in enumerate(others)}


class Automaton:
    """States are token ids; an arc's label is the token it emits and the state it leads to."""

    def __init__(self, vocabulary: dict[str, int], merges: list, special: dict[str, int]):
        letters = byte_letters()
        self.special = special
        self.labels: dict[int, bytes] = {i: s.encode() for s, i in special.items()}
        size = max([*vocabulary.values(), *special.values()], default=0) + 1
        self.copied, self.followed, self.born = array("i", [0]) * size, array("i", [0]) * size, array("i", [-1]) * size
        self.cut: dict[int, int] = {}
        self.table: dict[int, bool] = {}
        self.tokens: dict[bytes, int] = {}
        for letter, byte in letters.items():
            if letter in vocabulary:
                self._add(bytes([byte]), vocabulary[letter])
        for time, pair in enumerate(merges):
            u, v = pair if isinstance(pair, list) else pair.split(" ")
            self._gadget(time, vocabulary[u], vocabulary[v], vocabulary[u + v])
        self.longest = max(map(len, self.tokens), default=0)
        self.sizes = array("i", [len(self.labels.get(i, b"")) for i in range(size)])
        self.spelling: dict = {}  # a trie of the labels: byte -> node, -1 -> the label that ends there
        for label, state in self.tokens.items():
            node = self.spelling
            for byte in label:
                node = node.setdefault(byte, {})
            node[-1] = state

    def _add(self, label: bytes, state: int) -> None:
        self.tokens[label] = state
        self.labels[state] = label

    def _gadget(self, time: int, u: int, v: int, w: int) -> None:
        if u in self.labels and v in self.labels and self._resolve(u, v):  # else no path has u before v
            self.copied[w], self.followed[w], self.born[w] = v, u, time
            self._add(self.labels[u] + self.labels[v], w)
            self.cut[u << 32 | v] = time

    def _resolve(self, state: int, label: int) -> bool:
        """Whether ``state`` has an arc with ``label`` after all merges so far."""
        limit, born = 1 << 30, self.born
        while True:
            if self.cut.get(state << 32 | label, limit) < limit:
                return False
            if born[label] >= born[state]:
                if born[label] < 0:
                    return True
                limit, label = born[label] + 1, self.followed[label]  # as it was once the merge had cut its arc
            else:
                limit, state = born[state], self.copied[state]  # as it was before the merge

    def arc(self, state: int, label: int) -> bool:
        key = state << 32 | label
        found = self.table.get(key)
        if found is None:
            found = self.table[key] = self._resolve(state, label)
        return found

    def encode(self, word: bytes) -> list[int]:
        """The labels of the only path that spells ``word``: longest label first, with steps back.

        The states of a path are fixed by the position they are at, so an end that fails once fails always.
        """
        table, sizes, n = self.table, self.sizes, len(word)
        path, choices, failed, state = [], [], set(), START
        at = 0
        while at < n:
            if len(choices) == len(path):
                options, node = [], self.spelling  # the labels that spell the word from here, shortest first
                for byte in word[at:at + self.longest]:
                    node = node.get(byte)
                    if node is None:
                        break
                    label = node.get(-1)
                    if label is not None:
                        options.append(label)
                choices.append(options)
            options = choices[-1]
            while options:
                label = options.pop()
                if state != START:
                    has = table.get(state << 32 | label)
                    if not (self.arc(state, label) if has is None else has):
                        continue
                if failed and at + sizes[label] in failed:
                    continue
                path.append(label)
                at += sizes[label]
                state = label
                break
            else:
                if not path:
                    raise ValueError("a byte of the text is not in the vocabulary")
                failed.add(at)
                choices.pop()
                at -= sizes[path.pop()]
                state = path[-1] if path else START
        return path


@lru_cache(maxsize=4)
def load(path: str) -> Automaton:
    """The automaton of a byte-level vocabulary file of the tokenizers library, compiled once per process."""
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    model = parts["model"]
    return Automaton(model["vocab"], model["merges"], {a["content"]: a["id"] for a in parts["added_tokens"]})


@lru_cache(maxsize=4)
def arc_labels(path: str) -> dict[int, bytes]:
    """What each token id emits; special tokens emit their own string."""
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    letters = byte_letters()
    labels = {i: bytes(letters[c] for c in s) for s, i in parts["model"]["vocab"].items()}
    return labels | {a["id"]: a["content"].encode() for a in parts["added_tokens"]}


def emit(labels: dict[int, bytes], ids) -> str:
    """The text that the labels of a path spell."""
    return b"".join([labels[i] for i in ids]).decode("utf-8", "replace")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class _Spelled(dict):
    """The tokens of chunks as packed ints. Two generations of ``limit`` chunks bound the memory."""

    def __init__(self, spell, limit: int):
        super().__init__()
        self.spell, self.limit, self.old = spell, limit, {}

    def __missing__(self, chunk: str) -> bytes:
        packed = self.old.get(chunk)
        if packed is None:
            packed = self.spell(chunk)
            if len(chunk) > 100:
                return packed
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[chunk] = packed
        return packed


class Encoder:
    """Encodes texts chunk by chunk and remembers the tokens of recent chunks.

    A space before a letter, digit or sign always begins a piece of the pattern. So a text whose spaces all stand
    before such a character is the chunks between its spaces, each with its space; other texts are one chunk.
    """

    def __init__(self, automaton: Automaton, chunks: int = CHUNKS, pattern: str = PATTERN):
        self.automaton = automaton
        self.split = regex.compile(pattern).findall
        self.odd_space = regex.compile(r" (?:\s|$)").search
        marks = sorted(automaton.special, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None
        self.spelled = _Spelled(lambda chunk: self.words[" " + chunk] if chunk.isalpha() else self._spell(" " + chunk), chunks)
        self.words = _Spelled(self._word, chunks // 2)

    def _word(self, word: str) -> bytes:
        if len(self.automaton.table) > ARCS:
            self.automaton.table.clear()
        return array("i", self.automaton.encode(word.encode("utf-8", "replace"))).tobytes()

    def _spell(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.split(text)))

    def _plain(self, text: str) -> bytes:
        if self.odd_space(text):
            return self._spell(text)
        first, *rest = text.split(" ")
        return self._spell(first) + b"".join(map(self.spelled.__getitem__, rest))

    def __call__(self, text: str | None) -> bytes:
        """The token ids of ``text``, as packed native ints."""
        text = text or ""
        if self.marks is None or not any(m in text for m in self.automaton.special):
            return self._plain(text)
        special = self.automaton.special
        return b"".join(array("i", [special[p]]).tobytes() if i % 2 else self._plain(p) for i, p in enumerate(self.marks.split(text)))


@lru_cache(maxsize=4)
def encoder(path: str, chunks: int) -> Encoder:
    """One encoder per process: a worker's later tasks find what its earlier ones have spelled."""
    return Encoder(load(path), chunks)


def _encoded(rows: Iterator[pa.RecordBatch], text: str, name: str, path: str, chunks: int) -> Iterator[pa.RecordBatch]:
    spell = encoder(path, chunks)
    for part in pieces(rows, text, 4 << 20):
        packed = [spell(value) for value in part.column(text).to_pylist()]
        ends = array("i", [0])
        for ids in packed:
            ends.append(ends[-1] + len(ids) // 4)
        values = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(packed))])
        lists = pa.ListArray.from_arrays(pa.array(memoryview(ends), pa.int32()), values)
        yield pa.RecordBatch.from_arrays([*part.columns, lists], [*part.schema.names, name])


def _decoded(rows: Iterator[pa.RecordBatch], ids: str, name: str, path: str) -> Iterator[pa.RecordBatch]:
    labels = arc_labels(path)
    for part in pieces(rows, ids, 4 << 20):
        texts = [emit(labels, v.values.to_numpy(zero_copy_only=False).tolist() if v.is_valid else ()) for v in part.column(ids)]
        yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, name])


_IDS, _DECODED = T.ArrayType(T.IntegerType()), T.StringType()


def encode(docs: DataFrame, text: str = "text", path: str | None = None, chunks: int = CHUNKS) -> DataFrame:
    """``docs`` with ``ids`` (array of int): the tokens of each whole text.

    Null and empty texts have no tokens. The strings of special tokens in a text are those tokens.
    If ``docs`` has a column of that name the new one starts with an underscore. Other columns pass.
    """
    path, name = path or default_path(), column_free(docs, "ids")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, _IDS)])
    return docs.mapInArrow(lambda rows: _encoded(rows, text, name, path, chunks), schema)


def decode(rows: DataFrame, ids: str = "ids", path: str | None = None) -> DataFrame:
    """``rows`` with ``decoded``: the text that the labels of ``ids`` spell; null ids spell the empty text.

    Bytes that are no UTF-8 become U+FFFD. A clash of names is solved as in :func:`encode`.
    """
    path, name = path or default_path(), column_free(rows, "decoded")
    schema = T.StructType([*rows.schema.fields, T.StructField(name, _DECODED)])
    return rows.mapInArrow(lambda parts: _decoded(parts, ids, name, path), schema)


def round_trip(docs: DataFrame, text: str = "text", path: str | None = None, chunks: int = CHUNKS) -> DataFrame:
    """``docs`` without ``text``, with the ``ids`` of :func:`encode` and the text that :func:`decode` makes of them.

    Both steps in one Python process: a task needs one worker's memory and ids cross to the JVM once.
    """
    path = path or default_path()
    names = [column_free(docs, "ids"), column_free(docs, "decoded")]
    kept = [f for f in docs.schema.fields if f.name != text]

    def both(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _decoded(_encoded(rows, text, names[0], path, chunks), names[0], names[1], path):
            yield part.select([f.name for f in kept] + names)

    return docs.mapInArrow(both, T.StructType([*kept, T.StructField(names[0], _IDS), T.StructField(names[1], _DECODED)]))


def digests(rows: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of the results of both."""
    return rows.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
