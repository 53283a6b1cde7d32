"""A factorization machine over hashed terms that scores texts for toxicity.

A text's terms are its lower-cased words and their first 4, 5 and 6 characters, hashed to 64 bits; a
feature is whether a term occurs. Besides a weight per term the machine has a vector per term, and the
score adds the inner products of all pairs of terms: an insult next to a group's name can weigh more, or a
quoting verb less, than both alone. The sum over pairs is ((sum v)^2 - sum v^2) / 2, linear in the terms.

The fit is bounded: at most ``train_rows`` labelled rows, those with the smallest hash of their id, read from a written table into one list of
32-bit numbers, and a bucket
of ``buckets`` for each term, by its hash. A term's own rate in the classes does not decide whether it is fitted, so one that
says nothing alone can count in a pair; only buckets that fewer than ``min_docs`` of these rows hold are left out. Every row is scored.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from pulserank.llm.common import column_free, materialise, pieces
from pulserank.operators.sampling import bounded_sample

PREFIXES = (4, 5, 6)
TRAIN_ROWS = 20_000
BUCKETS = 1 << 20
#: Small sets are gone through more often, for as many steps of 512 rows.
LEAST_STEPS = 320
_WORD = re.compile(r"\w+").findall


def terms(chunk: str) -> list[int]:
    """The hashed terms of the words in a lower-cased chunk."""
    found = []
    for word in _WORD(chunk):
        found.append("=" + word)
        found += [word[:n] for n in PREFIXES if len(word) >= n]
    return [xxhash.xxh64_intdigest(t.encode("utf-8", "replace")) - (1 << 63) for t in found]


class _Terms(dict):
    """The buckets of chunks, or their ``places``; ``limit`` chunks are remembered at most."""

    def __init__(self, buckets: int, places: dict[int, int] | None = None, limit: int = 150_000):
        super().__init__()
        self.buckets, self.places, self.limit = buckets, places, limit

    def __missing__(self, chunk: str) -> tuple[int, ...]:
        found = {t % self.buckets for t in terms(chunk)}
        found = tuple(found if self.places is None else {self.places[b] for b in found if b in self.places})
        if len(self) >= self.limit:
            self.clear()
        self[chunk] = found
        return found

    def of(self, text: str | None) -> list[int]:
        return sorted(set().union(*map(self.__getitem__, set((text or "").lower().split()))))


@dataclass
class Machine:
    """Bias, and a weight and a vector per fitted bucket; ``places`` has the row of each."""

    bias: float
    weights: np.ndarray
    vectors: np.ndarray
    places: dict[int, int]
    buckets: int = BUCKETS

    def score(self, features: list[int]) -> float:
        v = self.vectors[features]
        total = v.sum(axis=0)
        z = self.bias + self.weights[features].sum() + 0.5 * float((total * total).sum() - (v * v).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


@dataclass
class Sample:
    """The features of all rows in a row; those of row i stand from starts[i] to starts[i + 1]."""

    flat: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, rows: list) -> Sample:
        sizes = [len(r) for r in rows]
        flat = np.concatenate([np.asarray(r, np.int32) for r in rows]) if rows else np.zeros(0, np.int32)
        return cls(flat, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))

    def __len__(self) -> int:
        return len(self.starts) - 1

    def batch(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(features, owner): of the chosen rows, and at which place of the batch each one's row is."""
        sizes = self.starts[chosen + 1] - self.starts[chosen]
        owner = np.repeat(np.arange(len(chosen)), sizes)
        return self.flat[np.repeat(self.starts[chosen] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())], owner


def fit_machine(rows, labels: np.ndarray, size: int, factors: int = 4, epochs: int = 30, rate: float = 0.05, decay: float = 1e-3, seed: int = 7, scale: np.ndarray | None = None, damp: float = 1e-8):
    """(bias, weights, vectors) by Adam on the logistic loss; rows are lists of features below ``size``, or a :class:`Sample`.

    ``scale`` multiplies the steps of each feature, which then shrink to 0 by the last one. ``damp`` is added to the root of the mean
    square of a slope, so that features of small slopes, the noise of rare terms, move less. The state is three tables of single precision,
    (1 + factors) numbers a feature each; a step needs one more.
    """
    rng = np.random.default_rng(seed)
    rows = rows if isinstance(rows, Sample) else Sample.of(rows)
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    bias = float(np.log(share / (1 - share)))
    state = np.zeros((size, 1 + factors), np.float32)  # a weight and a vector per feature
    state[:, 1:] = rng.normal(0, 0.01, (size, factors))
    if not size or not 0 < labels.sum() < len(labels):
        return bias, state[:, 0].astype(float), state[:, 1:].astype(float)
    means, squares, step, batch = np.zeros_like(state), np.zeros_like(state), 0, 512
    bias_mean = bias_square = 0.0
    last = epochs * -(-len(rows) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for start in range(0, len(order), batch):
            chosen = order[start:start + batch]
            flat, owner = rows.batch(chosen)
            values = state[flat]
            sums = np.stack([np.bincount(owner, values[:, k], len(chosen)) for k in range(1 + factors)], axis=1)
            own = np.bincount(owner, (values[:, 1:] ** 2).sum(1), len(chosen))
            z = bias + sums[:, 0] + 0.5 * ((sums[:, 1:] ** 2).sum(1) - own)
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[chosen]) / len(chosen)
            by_term = np.bincount(flat, error[owner], size).astype(np.float32)
            slope = decay * state
            slope[:, 0] += by_term
            for k in range(1, 1 + factors):
                slope[:, k] += np.bincount(flat, (error * sums[:, k])[owner], size).astype(np.float32) - state[:, k] * by_term
            now = rate if scale is None else rate * (1 - step / last)
            step += 1
            g = float(error.sum())
            bias_mean, bias_square = 0.9 * bias_mean + 0.1 * g, 0.999 * bias_square + 0.001 * g * g
            bias -= now * (bias_mean / (1 - 0.9 ** step)) / (np.sqrt(bias_square / (1 - 0.999 ** step)) + damp)
            for at in range(0, size, 65_536):  # in parts, so a step needs no second set of tables
                part = slice(at, at + 65_536)
                means[part] += np.float32(0.1) * (slope[part] - means[part])
                squares[part] += np.float32(0.001) * (slope[part] ** 2 - squares[part])
                move = np.float32(now / (1 - 0.9 ** step)) * means[part] / (np.sqrt(squares[part] / np.float32(1 - 0.999 ** step)) + np.float32(damp))
                state[part] -= move if scale is None else move * scale[part, None]
    return float(bias), state[:, 0].astype(float), state[:, 1:].astype(float)


def _scales(rows: Sample, labels: np.ndarray, size: int) -> np.ndarray:
    """How far a step moves a feature: whole if its rates in the classes differ by 6 deviations, less if they differ less, never 0.

    With few features all move whole; among very many, neutral ones move by a twentieth, or their sum would drown the others.
    """
    if not len(rows) or not size:
        return np.ones(size, np.float32)
    n = np.bincount(rows.flat, minlength=size)
    p = np.bincount(rows.flat, np.repeat(labels, np.diff(rows.starts)), size)
    share = labels.mean()
    z = (p - n * share) / np.sqrt(n * share * (1 - share) + 1e-9)
    return np.clip((z / 6) ** 2, max(0.05, min(1.0, 2000 / size)), 1).astype(np.float32)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _gathered(found: DataFrame, buckets: int, min_docs: int) -> tuple[np.ndarray, Sample, np.ndarray]:
    """(labels, features, buckets): the written sample, read part by part into one list, without the buckets of too few rows."""
    total, n = found.agg(F.sum(F.octet_length("features")), F.count("*")).first()
    flat, labels, starts, held, at = np.empty((total or 0) // 4, np.int32), np.empty(n), np.zeros(n + 1, np.int64), np.zeros(buckets, np.int32), 0
    for i, row in enumerate(found.orderBy("id", "features").toLocalIterator()):
        own = np.frombuffer(row.features, np.int32)
        flat[at:at + len(own)] = own
        held[own] += 1  # a bucket stands once in a row
        at += len(own)
        labels[i], starts[i + 1] = row.label, at
    often = held >= max(1, min_docs)
    place, mask = np.cumsum(often, dtype=np.int32) - np.int32(1), often[flat]
    sizes = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])[starts]
    return labels, Sample(place[flat[mask]], sizes), np.flatnonzero(often)


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
    train_rows: int = TRAIN_ROWS, buckets: int = BUCKETS, min_docs: int = 5,
) -> Machine:
    """The machine learned from labelled rows that are not held out.

    Rows without an id or a label are left out; an id with several labels counts as toxic if one is 1. Without rows of
    both classes the machine knows the smoothed share of label 1 only (0.5 without any row).
    """
    chosen = (
        labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(doc_id)))
        .groupBy(F.col(doc_id).alias("__id")).agg(F.max(label).cast("int").alias("__label"))
    )
    chosen = bounded_sample(materialise(chosen, "toxicity-labels"), ["__id"], train_rows)
    rows = docs.select(F.col(f"`{doc_id}`").alias("__id"), F.col(f"`{text}`").alias("__text")).join(F.broadcast(chosen), "__id")
    ones, zeros = [int(v or 0) for v in chosen.agg(F.sum("__label"), F.sum(1 - F.col("__label"))).first()]

    def bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Terms(buckets, limit=50_000)
        for part in pieces(batches, "__text", 2 << 20):
            lists = [np.array(known.of(t), np.int32).tobytes() for t in part.column("__text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("__id").cast(pa.string()), part.column("__label"), pa.array(lists, pa.binary())], ["id", "label", "features"])

    schema = "id string, label int, features binary"
    found = materialise(rows.select("__id", "__text", "__label").mapInArrow(bucketed, schema), "toxicity-sample") if ones and zeros else None
    target, kept, seen = _gathered(found, buckets, min_docs) if found is not None else (np.repeat([1.0, 0.0], [ones, zeros]), Sample.of([]), np.zeros(0, np.int64))
    scale = _scales(kept, target, len(seen))
    epochs = max(10, min(300, -(-LEAST_STEPS * 512 // max(1, len(kept)))))
    bias, weights, vectors = fit_machine(kept, target, len(seen), epochs=epochs, rate=0.02, scale=scale, damp=1e-3)
    return Machine(bias, weights, vectors, {b: i for i, b in enumerate(seen.tolist())}, buckets)


def score(docs: DataFrame, machine: Machine, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` between 0 and 1; null and empty texts get the score of no terms.

    If ``docs`` has a column ``score`` the new one starts with an underscore. Other columns pass.
    """
    name = column_free(docs, "score")

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Terms(machine.buckets, machine.places)
        for part in pieces(rows, text):
            scores = [machine.score(known.of(t)) for t in part.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], [*part.schema.names, name])

    return docs.mapInArrow(batches, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))
