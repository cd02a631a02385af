"""Words, rolling n-gram fingerprints and byte windows of a batch of texts, as NumPy arrays.

A batch's texts lie end to end in one byte array. Fingerprints are sums of random
64-bit values times powers of an odd base, modulo 2**64, so that those of every
word and window follow from running sums; they never reach across documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
_RANDOM = np.random.default_rng(20240607)
_BYTE_VALUES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & _MASK, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the base and of its inverse, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(0, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
        return self.up, self.down


_POWERS = _Powers()


def mixed(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over the whole word."""
    h = h + np.uint64(seed * 0xD1B54A32D192ED03 & _MASK)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


@dataclass
class Texts:
    """Consecutive documents: their bytes, and where each begins (one more offset than texts)."""

    data: np.ndarray
    offsets: np.ndarray

    @property
    def count(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def texts_of(column: pa.Array) -> Texts:
    """A string column without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    raw = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    body = column.buffers()[2] if len(column) else None
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return Texts(data[raw[0] : raw[-1]], raw - raw[0])


def chunks(batch: pa.RecordBatch, text_column: str | int = "text", most: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Slices of a batch of about `most` bytes each (a longer document is a slice of its own)."""
    texts = texts_of(batch.column(text_column))
    begin = 0
    while begin < texts.count:
        end = int(np.searchsorted(texts.offsets, texts.offsets[begin] + most, side="right")) - 1
        end = min(max(end, begin + 1), texts.count)
        base = texts.offsets[begin]
        yield batch.slice(begin, end - begin), Texts(texts.data[base : texts.offsets[end]], texts.offsets[begin : end + 1] - base)
        begin = end


@dataclass
class Words:
    """Where every word begins and ends, and per document the index of its first word."""

    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray

    @property
    def per_text(self) -> np.ndarray:
        return np.diff(self.offsets)


def words_of(texts: Texts) -> Words:
    inside = ~SPACES[texts.data]
    edges = texts.offsets[1:-1]
    edges = edges[edges < len(texts.data)]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[edges] = inside[edges]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    before = edges[edges > 0] - 1
    closes[before] = inside[before]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    return Words(starts, ends, np.searchsorted(starts, texts.offsets))


def lowered(texts: Texts) -> Texts:
    """A-Z in lower case, other characters unchanged."""
    upper = (texts.data >= 65) & (texts.data <= 90)
    return Texts(texts.data + upper.astype(np.uint8) * np.uint8(32), texts.offsets)


def _running(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of value times power, and the inverse powers."""
    up, down = _POWERS.get(len(texts.data) + 1)
    sums = np.zeros(len(texts.data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[texts.data] * up[: len(texts.data)], out=sums[1:])
    return sums, down


def span_prints(texts: Texts, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums, down = _running(texts)
    return mixed((sums[ends] - sums[starts]) * down[starts])


def word_prints(texts: Texts, words: Words) -> np.ndarray:
    return span_prints(texts, words.starts, words.ends)


def word_windows(prints: np.ndarray, offsets: np.ndarray, n: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint of every n-word window inside a document, and the index of its first word."""
    total = len(prints) - n + 1
    if total <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    factor = np.uint64(_powers(_BASE, seed + 3)[-1])
    out = prints[:total].copy()
    for k in range(1, n):
        out *= factor
        out += prints[k : k + total]
    last = np.repeat(offsets[1:], np.diff(offsets))[:total]
    first = np.flatnonzero(np.arange(n, total + n) <= last)
    return mixed(out[first], n + 100 * seed), first


def byte_windows(texts: Texts, n: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint of every n-byte window inside a document, and its first byte."""
    total = len(texts.data) - n + 1
    if total <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    sums, down = _running(texts)
    starts = np.concatenate([np.arange(a, b - n + 1) for a, b in zip(texts.offsets[:-1], texts.offsets[1:], strict=True) if b - a >= n] or [np.zeros(0, np.int64)])
    return mixed((sums[starts + n] - sums[starts]) * down[starts], n + 1000 * seed), starts


def owners(positions: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Index of the document that each position lies in."""
    return np.searchsorted(offsets, positions, side="right") - 1


def covered(starts: np.ndarray, width: int, length: int) -> np.ndarray:
    """Which of `length` positions lie in one of the windows."""
    change = np.zeros(length + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + width, length), -1)
    return np.cumsum(change[:-1]) > 0
