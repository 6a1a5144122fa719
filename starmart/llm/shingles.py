"""Word shingles as 64-bit numbers, whole batches of texts at a time.

Words are the stretches between white space with A-Z in lower case; a shingle is five words in a row,
or all words of a shorter text. Words and shingles are numbered by hashing; two different ones share a
number with a chance of about 1 in 10**19.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

WIDTH = 5
BATCH_BYTES = 1 << 20

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.arange(256, dtype=np.uint64)
_BYTE[65:91] += np.uint64(32)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUE = mixed(_BYTE + _FACTOR)


def _powers(n: int) -> np.ndarray:
    steps = np.full(max(n, 1), _FACTOR, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def _word_numbers(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all words in order, and how many each text has."""
    raw = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    inside = ~_SPACE[raw]
    edges = np.flatnonzero(np.diff(inside, prepend=False))  # the last byte is a space
    starts, stops = edges[::2], edges[1::2]
    ends_of_texts = np.cumsum([len(t) + 1 for t in texts])
    per_text = np.diff(np.searchsorted(starts, ends_of_texts), prepend=0)
    if not len(starts):
        return np.empty(0, np.uint64), per_text
    sizes = stops - starts
    first = np.cumsum(sizes) - sizes
    letters = raw[inside]
    place = np.arange(len(letters)) - np.repeat(first, sizes)
    sums = np.add.reduceat(_VALUE[letters] * _powers(int(sizes.max()))[place], first)
    return mixed(sums + sizes.astype(np.uint64)), per_text


def _sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    words, per_text = _word_numbers(texts)
    grams = np.empty(0, np.uint64)
    if len(words) >= WIDTH:
        grams = words[: len(words) - WIDTH + 1].copy()
        for i in range(1, WIDTH):
            grams = grams * _FACTOR + words[i : len(words) - WIDTH + 1 + i]
        grams = mixed(grams)
    at = 0
    for n in per_text.tolist():
        if n >= WIDTH:
            yield np.unique(grams[at : at + n - WIDTH + 1])
        elif n:
            number = np.uint64(n)
            for w in words[at : at + n]:
                number = np.uint64((int(number) * int(_FACTOR) + int(w)) % (1 << 64))
            yield mixed(np.array([number], np.uint64))
        else:
            yield np.empty(0, np.uint64)
        at += n


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The sorted, different shingles of each text."""
    batch: list[bytes] = []
    size = 0
    for text in texts:
        batch.append((text or "").encode())
        size += len(batch[-1])
        if size >= BATCH_BYTES:
            yield from _sets(batch)
            batch, size = [], 0
    yield from _sets(batch)


def set_digest(shingles: np.ndarray) -> bytes:
    """Twelve bytes that name a set of shingles."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=12).digest()
