"""Word shingles as 64-bit hashes, in numpy, over batches of whole texts.

Text is lower-cased for A-Z only; words are [^\\x20\\x09-\\x0D]+. A text's set holds its distinct shingles of `width`
words; with fewer words, the whole sequence as one shingle; without words it is empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_STEP = np.uint64(0xD6E8FEB86659FD93)
#: Bytes of text hashed at once; a longer text is hashed alone.
BATCH = 1 << 18
power_tables: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not power_tables or len(power_tables[0]) < n:
        size = max(n, BATCH + 1)
        made = []
        for base in (_BASE, _INVERSE):
            full = np.full(size, base, np.uint64)
            full[0] = 1
            made.append(np.cumprod(full))
        if size > 8 << 20:  # not kept
            return made[0], made[1]
        power_tables[:] = made
    return power_tables[0], power_tables[1]


def spans_and_hashes(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every word of the bytes."""
    blank = np.concatenate([[True], _BLANK[buffer], [True]])
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edge[::2], edge[1::2]
    return starts, ends, span_hashes(buffer, starts, ends)


def word_hashes(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start offset and hash of every word of the bytes."""
    starts, _, found = spans_and_hashes(buffer)
    return starts, found


def span_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the bytes [start, end): equal bytes, wherever they stand, have equal hashes."""
    power, inverse = _power_tables(len(buffer) + 1)
    total = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum(_BYTE[buffer] * power[: len(buffer)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def shingle_sets(texts: list[str | None], width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in order."""
    batch: list[bytes] = []
    size = 0
    for text in texts:
        raw = text.encode().lower() if text else b""
        if batch and size + len(raw) > BATCH:
            yield from _sets(batch, width)
            batch, size = [], 0
        batch.append(raw)
        size += len(raw) + 1
    if batch:
        yield from _sets(batch, width)


def _sets(batch: list[bytes], width: int) -> Iterator[np.ndarray]:
    lengths = np.array([len(x) + 1 for x in batch], np.int64)
    starts, words = word_hashes(np.frombuffer(b"\n".join(batch), np.uint8))
    bounds = np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths)]))
    n = len(words)
    rolled = np.zeros(max(0, n - width + 1), np.uint64)
    for k in range(width):
        rolled = mix(rolled * _STEP + words[k : k + len(rolled)])
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= width:
            found = np.sort(rolled[a : b - width + 1])
            keep = np.empty(len(found), bool)
            keep[0] = True
            np.not_equal(found[1:], found[:-1], out=keep[1:])
            yield found[keep]
        elif b > a:
            one = np.uint64(b - a)
            acc = np.array([one], np.uint64)
            for k in range(a, b):
                acc = mix(acc * _STEP + words[k : k + 1])
            yield acc
        else:
            yield np.zeros(0, np.uint64)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == 0:
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] == a).sum())
