"""Sets of word shingles as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
PLACES = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                   0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F], np.uint64)

KEPT = 1 << 20
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64, at least n of each; up to KEPT stay for the next text."""
    if len(_powers[0]) >= n:
        return _powers[0], _powers[1]
    found = []
    for factor in (BASE, INVERSE):
        steps = np.full(1 << (n - 1).bit_length(), factor, np.uint64)
        steps[0] = 1
        found.append(np.multiply.accumulate(steps))
    if n <= KEPT:
        _powers[:] = found
    return found[0], found[1]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """A hash of each word (run of other than space and 09-0D), A-Z lower-cased."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8)
    inside = np.concatenate([[False], ~SPACE[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    power, inverse = _tables(len(data))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)])])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def shingle_set(text: str | None, words: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles; with fewer words, of the whole sequence."""
    if not text:
        return np.zeros(0, np.uint64)
    w = word_hashes(text)
    if not len(w):
        return w
    size = min(words, len(w))
    total = np.full(len(w) - size + 1, size, np.uint64)
    for j in range(size):
        total += mix(w[j:len(w) - size + 1 + j] + PLACES[j % len(PLACES)]) * PLACES[(j + 3) % len(PLACES)] * np.uint64(2 * j + 1)
    return np.unique(mix(total))


def set_hash(shingles: np.ndarray) -> int:
    """A signed 64-bit hash of a whole set."""
    if not len(shingles):
        return 0
    place = np.arange(1, len(shingles) + 1, dtype=np.uint64)
    return int(mix(np.array([np.bitwise_xor.reduce(mix(shingles + place * PLACES[0])) + np.uint64(len(shingles))], np.uint64)).view(np.int64)[0])
