"""Work over the bytes of whole Arrow batches, for use inside tasks: dictionary matches and word counts.

All steps are array operations over a batch; no step runs once per row or once per phrase.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa

from pulserank.functions import constants as K

_PIECE = 4 << 20  # bytes looked at at a time
_GRAM = 3
_WORD = np.zeros(256, bool)
_WORD[[ord(c) for c in "abcdefghijklmnopqrstuvwxyz0123456789+#.-"]] = True


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, ends): the UTF-8 of all rows in a row; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    return data, ends - ends[0]


def _pieces(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Slices of about ``_PIECE`` bytes with the number of their first row; a longer text is a slice of its own."""
    ends, start = _bytes(texts)[1], 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + _PIECE, "right")) - 1)
        yield start, texts.slice(start, stop - start)
        start = stop


class PhraseIndex:
    """An anchor index: every phrase is filed under the rarest of its grams of three bytes, shorter ones under themselves.

    Texts are read once: the grams of all positions look up a bitmap of the anchors, the few places that remain are paired with the phrases
    filed there, and their bytes decide. The work per text does not grow with the dictionary. ``bordered`` phrases count only as whole words,
    that is between characters other than a-z, 0-9 and ``+#.-``. ``counts`` are gram counts of a sample; without them the dictionary's own serve.
    """

    def __init__(self, phrases: Sequence[str], bordered: Sequence[bool] | None = None, counts: Mapping[bytes, int] | None = None):
        spelled = [p.encode("utf-8", "replace") for p in phrases]
        if not all(spelled):
            raise ValueError("an empty phrase")
        self.bordered = np.zeros(len(spelled), bool) if bordered is None else np.array(bordered, bool)
        self.sizes = np.array([len(p) for p in spelled], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.letters = np.frombuffer(b"".join(spelled), np.uint8)
        if counts is None:
            counts = Counter(g for p in spelled for g in {p[i:i + _GRAM] for i in range(len(p) - _GRAM + 1)})
        filed: dict[int, list[tuple[int, int, int]]] = {}
        for place, phrase in enumerate(spelled):
            n = min(_GRAM, len(phrase))
            at = min(range(len(phrase) - n + 1), key=lambda i: (counts.get(phrase[i:i + n], 0), i))
            filed.setdefault(n, []).append((int.from_bytes(phrase[at:at + n], "big"), place, at))
        self.tables = {}
        for n, rows in filed.items():
            code, place, at = np.array(sorted(rows), np.int64).T
            marked = np.zeros(1 << 8 * n, bool)
            marked[code] = True
            self.tables[n] = marked, code, place, at

    def find(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(row, phrase): each phrase once per row that contains it, in order."""
        found = [np.zeros(0, np.int64)]
        for first, part in _pieces(texts):
            data, ends = _bytes(part)
            for n, (marked, codes, phrase, offset) in self.tables.items():
                if len(data) < n:
                    continue
                gram = data[: len(data) - n + 1].astype(np.int32)
                for i in range(1, n):
                    gram = gram << 8 | data[i : len(data) - n + 1 + i]
                place = np.flatnonzero(marked[gram])
                low = np.searchsorted(codes, gram[place])
                many = np.searchsorted(codes, gram[place], "right") - low
                for a, b in _blocks(many):
                    filed = np.repeat(low[a:b] - (np.cumsum(many[a:b]) - many[a:b]), many[a:b]) + np.arange(many[a:b].sum())
                    found.append(self._verified(data, ends, np.repeat(place[a:b], many[a:b]) - offset[filed], phrase[filed], first))
        code = np.unique(np.concatenate(found))
        return np.divmod(code, max(1, len(self.sizes)))

    def _verified(self, data: np.ndarray, ends: np.ndarray, start: np.ndarray, phrase: np.ndarray, first: int) -> np.ndarray:
        row = np.searchsorted(ends, start, "right") - 1
        stop = start + self.sizes[phrase]
        inside = (start >= 0) & (row >= 0)
        inside[inside] = stop[inside] <= ends[row[inside] + 1]
        start, stop, phrase, row = start[inside], stop[inside], phrase[inside], row[inside]
        good = np.ones(len(start), bool)
        for i in range(int(self.sizes[phrase].max(initial=0))):  # letter by letter, for the pairs that are that long and still agree
            open_ = np.flatnonzero(good & (self.sizes[phrase] > i))
            if not len(open_):
                break
            good[open_] = data[start[open_] + i] == self.letters[self.starts[phrase[open_]] + i]
        whole = np.flatnonzero(good & self.bordered[phrase])
        if len(whole):
            before, after = start[whole] - 1, stop[whole]
            left = (before >= ends[row[whole]]) & _WORD[data[np.maximum(before, 0)]]
            right = (after < ends[row[whole] + 1]) & _WORD[data[np.minimum(after, len(data) - 1)]]
            good[whole[left | right]] = False
        return (row[good] + first) * len(self.sizes) + phrase[good]

    def places(self, texts: pa.Array) -> pa.Array:
        """Per row the ascending places of the phrases it contains."""
        row, phrase = self.find(texts)
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(texts) + 1)), pa.int32()), pa.array(phrase, pa.int32()))


def _blocks(many: np.ndarray, most: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Ranges whose sums of ``many`` are about ``most``."""
    total, at = np.cumsum(many), 0
    while at < len(many):
        stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most, "right")))
        yield at, stop
        at = stop


_BLANK = np.zeros(256, bool)
_BLANK[[ord(c) for c in K.WHITESPACE if ord(c) < 128]] = True
_WIDE = {}
for _c in K.WHITESPACE:
    if ord(_c) >= 128:
        _WIDE.setdefault(len(_c.encode()), []).append(int.from_bytes(_c.encode(), "big"))


def word_counts(texts: pa.Array) -> pa.Array:
    """The number of runs without white space in each text, as :func:`pulserank.functions.text.word_count`; null has none."""
    out = np.zeros(len(texts), np.int64)
    for first, part in _pieces(texts):
        data, ends = _bytes(part)
        blank = _BLANK[data]
        for n, codes in _WIDE.items():
            lead = np.flatnonzero(np.isin(data[: max(0, len(data) - n + 1)], np.unique([c >> 8 * (n - 1) for c in codes]).astype(np.uint8)))
            code = np.zeros(len(lead), np.int64)
            for i in range(n):
                code = code << 8 | data[lead + i]
            for i in range(n):
                blank[lead[np.isin(code, codes)] + i] = True
        before = np.ones(len(data), bool)
        before[1:] = blank[:-1]
        edge = np.zeros(len(data) + 1, bool)
        edge[ends] = True
        begins = ~blank & (before | edge[:-1])
        out[first : first + len(part)] = np.diff(np.concatenate([[0], np.cumsum(begins)])[ends])
    return pa.array(out)
