"""Token counts under a unigram vocabulary, by a dynamic program that a trie of pre-tokens shares.

The distinct pre-tokens of a task go into one trie. A node is a prefix; its forward state is the
best score of cutting that prefix into vocabulary pieces, and the pieces of the best cut. It is computed
when the node is made, from the states of the nodes above it, so a prefix that a thousand pre-tokens share is
scored once. The node that ends a pre-token stores its count; later occurrences are one lookup.

Scores are integers (millionths of the natural logarithm), so sums are exact and ties certain: of equal
scores the cut with fewer pieces wins. The vocabulary is a public rank file; ranks follow frequency,
so by Zipf's law a piece of rank r is given a probability in proportion to 1 / (r + 1). No tokenizer is trained.
"""
from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, types as T

from pulserank.llm.common import column_free, pieces

#: Fixed: the pattern by which the rank file's texts are split.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def pieces_of(path: str) -> dict[bytes, int]:
    """The score of each piece of a rank file."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    total = math.log(sum(1 / (r + 1) for r in ranks.values()))
    return {piece: round(-1e6 * (math.log(rank + 1) + total)) for piece, rank in ranks.items()}


class PrefixTrie:
    """Nodes of one trie of pre-tokens; ``limit`` nodes at most, then it starts anew."""

    def __init__(self, scores: dict[bytes, int], limit: int = 400_000):
        self.scores, self.limit = scores, limit
        self.longest = max(map(len, scores))
        self.clear()

    def clear(self) -> None:
        self.children: dict[int, int] = {}
        self.score, self.count = [0], [0]

    def tokens(self, word: bytes) -> int:
        """The number of pieces in the best cut of ``word``."""
        if len(self.score) > self.limit:
            self.clear()
        children, score, count, scores = self.children, self.score, self.count, self.scores
        path = [0]
        node = 0
        for end in range(1, len(word) + 1):
            key = node << 8 | word[end - 1]
            child = children.get(key)
            if child is None:
                best, fewest = None, 0
                for start in range(max(0, end - self.longest), end):
                    piece = scores.get(word[start:end])
                    if piece is not None and score[path[start]] is not None:
                        total = score[path[start]] + piece
                        pieces_ = count[path[start]] + 1
                        if best is None or total > best or total == best and pieces_ < fewest:
                            best, fewest = total, pieces_
                child = children[key] = len(score)
                score.append(best)
                count.append(fewest)
            node = child
            path.append(node)
        if score[node] is None:
            raise ValueError("the vocabulary cannot spell a byte of the text")
        return count[node]


class Counter:
    """Counts the tokens of texts; the counts of ``limit`` pre-tokens are remembered at most."""

    def __init__(self, scores: dict[bytes, int], limit: int = 400_000):
        self.trie, self.limit = PrefixTrie(scores, limit), limit
        self.split = regex.compile(PATTERN).findall
        self.known: dict[str, int] = {}

    def __call__(self, text: str | None) -> tuple[int, int]:
        words = self.split(text or "")
        known, total = self.known, 0
        for word in words:
            n = known.get(word)
            if n is None:
                n = self.trie.tokens(word.encode("utf-8", "replace"))
                if len(known) >= self.limit:
                    known.clear()
                if len(word) <= 64:
                    known[word] = n
            total += n
        return len(words), total


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(pieces_of(path))


def count_tokens(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """``docs`` with ``n_pretokens`` and ``n_tokens`` of each whole text; null and empty texts have 0 of both.

    A clash of names gives the new column an underscore in front. Other columns pass.
    """
    path = path or default_path()
    names = [column_free(docs, "n_pretokens"), column_free(docs, "n_tokens")]

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for part in pieces(rows, text):
            both = [count(t) for t in part.column(text).to_pylist()]
            columns = [pa.array([b[i] for b in both], pa.int64()) for i in range(2)]
            yield pa.RecordBatch.from_arrays([*part.columns, *columns], [*part.schema.names, *names])

    return docs.mapInArrow(batches, T.StructType([*docs.schema.fields, *(T.StructField(n, T.LongType()) for n in names)]))
