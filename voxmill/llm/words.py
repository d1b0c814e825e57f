"""Words of UTF-8 texts as hashes, for whole batches at a time in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at a time; a longer text is worked on alone.
BLOCK = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
# ASCII white space separates words; letters A-Z count as a-z.
_IN_WORD = np.ones(256, bool)
_IN_WORD[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
_PLUS_ONE = np.arange(1, 257, dtype=np.uint64)
_FORTH = np.ones(1, np.uint64)
_BACK = np.ones(1, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit number spread over all (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for at least n places."""
    global _FORTH, _BACK
    while len(_FORTH) < n:
        k = np.uint64(pow(_BASE, len(_FORTH), 1 << 64)), np.uint64(pow(_INVERSE, len(_BACK), 1 << 64))
        _FORTH, _BACK = np.concatenate([_FORTH, _FORTH * k[0]]), np.concatenate([_BACK, _BACK * k[1]])
    return _FORTH[:n], _BACK[:n]


def segment_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end], alike wherever a segment stands."""
    forth, back = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    numbers = _PLUS_ONE[data]
    numbers *= forth[:-1]
    np.cumsum(numbers, out=sums[1:])
    lengths = (ends - starts).astype(np.uint64)
    return mixed((sums[ends] - sums[starts]) * back[starts] + lengths * np.uint64(0xD6E8FEB86659FD93))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _IN_WORD[data]
    steps = np.flatnonzero(inside[1:] != inside[:-1])
    return steps[::2], steps[1::2]


def blocks(column: pa.Array, most: int = BLOCK) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of about ``most`` bytes together, with the place of the first."""
    texts = column.cast(pa.binary()).to_pylist()
    start = size = 0
    for i, text in enumerate(texts):
        texts[i] = text or b""
        if size and size + len(texts[i]) > most:
            yield start, texts[start:i]
            start, size = i, 0
        size += len(texts[i])
    if start < len(texts):
        yield start, texts[start:]


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts, a blank after each, as one array, and where each begins (and the end)."""
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=at[1:])
    return data, at


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words, A-Z lowered, and where each text's words begin (and the end)."""
    data, at = joined(texts)
    data = LOWER[data]
    starts, ends = word_bounds(data)
    return segment_hashes(data, starts, ends), np.searchsorted(starts, at)
