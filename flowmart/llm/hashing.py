"""Vectorised 64-bit hashes of words and word windows, for tasks that get batches of texts."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_SPAN = 64  # byte positions with tables of their own


def _odd(seed: int) -> np.uint64:
    return np.uint64(int(np.random.default_rng(seed).integers(1 << 62)) * 2 + 1)


_TABLE = np.random.default_rng(20_240_501).integers(0, 1 << 64, size=_SPAN * 256, dtype=np.uint64)
_TWIST, _BASE = _odd(11), _odd(12)
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that scatters them."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """All words of a batch in order: hash, number of the document, and how many words each document has."""

    hashes: np.ndarray
    doc: np.ndarray
    counts: np.ndarray

    @property
    def first(self) -> np.ndarray:
        """Place of each document's first word."""
        return np.concatenate(([0], np.cumsum(self.counts)[:-1])) if len(self.counts) else np.zeros(0, np.int64)


def hashed_words(texts: list[bytes], lower: bool = False, separators: np.ndarray = _WHITE) -> Words:
    """Words are runs of bytes that are no separators; lower levels A-Z."""
    data = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
    if not len(data):
        return Words(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(texts), np.int64))
    blank = separators[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True])).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    ends_of_docs = np.cumsum([len(t) + 1 for t in texts])
    doc = np.searchsorted(ends_of_docs, starts, side="right")
    counts = np.bincount(doc, minlength=len(texts)).astype(np.int64)
    if not len(starts):
        return Words(np.zeros(0, np.uint64), doc, counts)
    lengths = ends - starts
    inner = data[~blank]
    if lower:
        inner = _LOWER[inner]
    heads = np.cumsum(lengths) - lengths
    at = np.arange(len(inner), dtype=np.int32) - np.repeat(heads.astype(np.int32), lengths)
    values = _TABLE[(at & (_SPAN - 1)) * 256 + inner]
    if lengths.max() > _SPAN:
        far = np.flatnonzero(at >= _SPAN)
        turns = (at[far] // _SPAN).astype(np.uint64)
        values[far] = mixed(values[far] + turns * _TWIST)
    return Words(mixed(np.add.reduceat(values, heads)), doc, counts)


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2^64."""
    if len(_powers[0]) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for k, factor in enumerate((_BASE, inverse)):
            steps = np.full(max(n, 2 * len(_powers[k])), factor, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def windows(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of `length` words, by its first word. Runs across documents are the caller's to leave out."""
    n = len(hashes)
    if n < length:
        return np.zeros(0, np.uint64)
    up, down = _power(n + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * up[:n])))
    return mixed((sums[length:] - sums[:-length]) * down[: n - length + 1])


def running_least(values: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The least of every `length` neighbours and the first place where it stands, by doubling."""
    width, least, place = 1, values, np.arange(len(values), dtype=np.int32)

    def joined(step: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(least) - step
        later = least[step:] < least[:n]
        return np.where(later, least[step:], least[:n]), np.where(later, place[step:], place[:n])

    while width * 2 <= length:
        least, place = joined(width)
        width *= 2
    return joined(length - width) if length > width else (least, place)


def batches(texts: list[bytes], most: int = 1 << 21):
    """(first, last) places of neighbouring texts with about `most` bytes together; a longer text stands alone."""
    start = total = 0
    for k, text in enumerate(texts):
        if total and total + len(text) > most:
            yield start, k
            start, total = k, 0
        total += len(text) + 1
    if start < len(texts):
        yield start, len(texts)
