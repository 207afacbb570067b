"""Words and word hashes of many texts at once, computed on their bytes.

A word is a run of ASCII letters, digits and non-ASCII characters; A-Z count as
a-z. The hash of a word is a polynomial over random 64-bit values of its bytes,
taken from prefix sums, so no string is made for any word.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np

WINDOW_BYTES = 1 << 20

#: The same words as a pattern for lower-cased text.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_UPPER = bytes(range(65, 91))
LOWER = bytes(b + 32 if b in _UPPER else b for b in range(256))
#: Lower-cased bytes with every byte outside words as a space.
WORDS_ONLY = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in LOWER)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240501)
    values = rng.integers(1, 1 << 63, 256, dtype=np.uint64)[np.frombuffer(LOWER, np.uint8)]
    inside = np.frombuffer(WORDS_ONLY, np.uint8) != 32
    base = 0x9E3779B97F4A7C15
    powers = np.full(WINDOW_BYTES, base, np.uint64)
    inverse = np.full(WINDOW_BYTES, pow(base, -1, 1 << 64), np.uint64)
    powers[0] = inverse[0] = 1
    return values, inside, np.multiply.accumulate(powers), np.multiply.accumulate(inverse)


def word_hashes(text: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words of one text, given as bytes, in order.

    Long texts are taken in windows that end outside a word; only a word longer
    than a window is hashed in several parts.
    """
    values, inside, powers, inverse = _tables()
    out, start = [], 0
    while start < len(text):
        stop = min(len(text), start + WINDOW_BYTES)
        if stop < len(text):
            gaps = np.flatnonzero(~inside[text[start:stop]])
            stop = start + int(gaps[-1]) + 1 if len(gaps) else stop
        part = text[start:stop]
        edges = np.flatnonzero(np.diff(inside[part], prepend=False, append=False))
        begins, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(values[part] * powers[: len(part)], out=sums[1:])
        out.append(mix((sums[ends] - sums[begins]) * inverse[begins]))
        start = stop
    return np.concatenate(out) if out else np.zeros(0, np.uint64)
