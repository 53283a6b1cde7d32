"""Counting quotient filters over pairs of ids: exact, compact, mergeable counters.

A pair (left, right) of ``width``-bit numbers is permuted invertibly by a Feistel network whose halves are the
two numbers. The top ``quotient`` bits of the result name a slot, all other bits are kept as the remainder, so nothing is lost
and the pair can be read back. Entries are sorted by (quotient, remainder). What is stored is

* how many entries each slot holds, in unary: a bit 1 per entry, a bit 0 at the end of a slot,
* the remainders in whole bytes, and
* the counters in a byte each; those of 255 or more stand in a list of their own.

Filters of one shape merge like sorted runs. A filter may cover one *bucket*, the values whose top ``bucket_bits`` are its number.
"""
from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

_HEAD = "<BBBQQQ"
_ROUNDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def _mask(width: int) -> np.uint64:
    return np.uint64((1 << width) - 1)


def _mix(half: np.ndarray, key: int, width: int) -> np.ndarray:
    x = (half + np.uint64(1)) * np.uint64(key)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(32))) & _mask(width)


def permute(left: np.ndarray, right: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The two halves of each pair's place in the filter."""
    high, low = left.astype(np.uint64), right.astype(np.uint64)
    for key in _ROUNDS:
        high, low = low, high ^ _mix(low, key, width)
    return high, low


def restore(high: np.ndarray, low: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of :func:`permute`'s halves."""
    for key in reversed(_ROUNDS):
        high, low = low ^ _mix(high, key, width), high
    return high, low


def counted(high: np.ndarray, low: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (high, low) in order with the sums of their counts."""
    if not len(high):
        return high, low, counts
    if width <= 32:
        key = high << np.uint64(width) | low
        order = np.argsort(key, kind="stable")
        key = key[order]
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
    else:
        order = np.lexsort((low, high))
        fresh = np.concatenate([[True], (np.diff(high[order]) != 0) | (np.diff(low[order]) != 0)])
    starts = np.flatnonzero(fresh)
    first = order[starts]
    return high[first], low[first], np.add.reduceat(counts[order], starts)


def _bytes(values: np.ndarray, bits: int) -> bytes:
    size = (bits + 7) // 8
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]).tobytes()


def _numbers(raw: bytes, at: int, n: int, bits: int) -> tuple[np.ndarray, int]:
    size = (bits + 7) // 8
    full = np.zeros((n, 8), np.uint8)
    if size and n:
        full[:, :size] = np.frombuffer(raw, np.uint8, n * size, at).reshape(n, size)
    return full.view("<u8").reshape(n).astype(np.uint64), at + n * size


@dataclass
class QuotientFilter:
    """Sorted entries of one bucket; ``high`` holds the quotient and the first part of the remainder, ``low`` the rest."""

    width: int
    bucket_bits: int
    bucket: int
    high: np.ndarray
    low: np.ndarray
    counts: np.ndarray

    def to_bytes(self) -> bytes:
        n, free = len(self.high), self.width - self.bucket_bits
        slot_bits = min(free, max(0, (max(n, 1) - 1).bit_length()))
        rest = free - slot_bits
        inner = self.high & _mask(free)
        slots = (inner >> np.uint64(rest)).astype(np.int64)
        unary = np.zeros(n + (1 << slot_bits), np.uint8)
        unary[slots + np.arange(n)] = 1
        many = self.counts >= 255
        return b"".join([
            struct.pack(_HEAD, self.width, self.bucket_bits, slot_bits, self.bucket, n, int(many.sum())), np.packbits(unary).tobytes(),
            _bytes(inner & _mask(rest), rest), _bytes(self.low, self.width),
            np.minimum(self.counts, 255).astype(np.uint8).tobytes(), self.counts[many].astype("<i8").tobytes(),
        ])

    @classmethod
    def from_bytes(cls, raw: bytes) -> QuotientFilter:
        width, bucket_bits, slot_bits, bucket, n, many = struct.unpack_from(_HEAD, raw)
        free, at = width - bucket_bits, struct.calcsize(_HEAD)
        rest, bits = free - slot_bits, n + (1 << slot_bits)
        size = (bits + 7) // 8
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8, size, at), count=bits))
        slots = (ones - np.arange(n)).astype(np.uint64)
        part, at = _numbers(raw, at + size, n, rest)
        low, at = _numbers(raw, at, n, width)
        counts = np.frombuffer(raw, np.uint8, n, at).astype(np.int64)
        counts[counts == 255] = np.frombuffer(raw, "<i8", many, at + n)
        high = np.uint64(bucket) << np.uint64(free) | slots << np.uint64(rest) | part
        return cls(width, bucket_bits, bucket, high, low, counts)

    @classmethod
    def merge(cls, filters: list[QuotientFilter]) -> QuotientFilter:
        """The sums of filters of one width and one bucket."""
        first = filters[0]
        if any((f.width, f.bucket_bits, f.bucket) != (first.width, first.bucket_bits, first.bucket) for f in filters):
            raise ValueError("filters of different shapes")
        merged = counted(*(np.concatenate([getattr(f, name) for f in filters]) for name in ("high", "low", "counts")), first.width)
        return cls(first.width, first.bucket_bits, first.bucket, *merged)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        left, right = restore(self.high, self.low, self.width)
        return left.astype(np.int64), right.astype(np.int64)


class Counter:
    """Counts pairs and hands out filters, one per bucket; holds about ``limit`` entries."""

    def __init__(self, width: int, bucket_bits: int, limit: int = 250_000):
        self.width, self.bucket_bits, self.limit = width, min(bucket_bits, width), limit
        self.parts: list[tuple] = []
        self.held = 0

    def add(self, left: np.ndarray, right: np.ndarray) -> list[QuotientFilter]:
        """Counts pairs; returns filters if there is no more room."""
        if len(left):
            high, low = permute(left, right, self.width)
            self.parts.append(counted(high, low, np.ones(len(high), np.int64), self.width))
            self.held += len(self.parts[-1][0])
        if self.held <= self.limit:
            return []
        self._join()
        return self.drain() if 2 * self.held > self.limit else []

    def _join(self) -> None:
        if len(self.parts) > 1:
            self.parts = [counted(*(np.concatenate(p) for p in zip(*self.parts)), self.width)]
        self.held = len(self.parts[0][0]) if self.parts else 0

    def drain(self) -> list[QuotientFilter]:
        self._join()
        if not self.held:
            return []
        high, low, counts = self.parts[0]
        self.parts, self.held = [], 0
        bucket = (high >> np.uint64(self.width - self.bucket_bits)).astype(np.int64)
        starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        ends = [*starts[1:].tolist(), len(bucket)]
        return [QuotientFilter(self.width, self.bucket_bits, int(bucket[a]), high[a:b], low[a:b], counts[a:b]) for a, b in zip(starts.tolist(), ends)]
