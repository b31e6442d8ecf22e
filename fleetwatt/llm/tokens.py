"""Words of many texts as 64-bit keys, without making a string of each."""

from __future__ import annotations

import numpy as np

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
# All of ASCII but letters and digits; bytes beyond ASCII belong to words.
NOT_ALPHANUMERIC = np.arange(256) < 128
for _first, _last in (b"09", b"AZ", b"az"):
    NOT_ALPHANUMERIC[_first : _last + 1] = False


def spread(x: np.ndarray) -> np.ndarray:
    """Mixes 64-bit integers so that each bit of the result depends on each bit given."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def place_weights(size: int) -> np.ndarray:
    return spread((np.arange(size, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def word_keys(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SPACE, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Text number and key of each word of lower-cased (A-Z) or unchanged texts, in order.

    Words are runs of bytes that are no separators. The key is a multilinear
    hash: the sum of the bytes, each times a weight of its place in the word.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    low = LOWER[data] if lower else data
    word = ~separator[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    begins = offsets[:-1][np.diff(offsets) > 0]
    first[begins] = word[begins]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(word)
    # Among the bytes of words only, a word is what lies between two starts.
    heads = np.searchsorted(at, starts)
    lengths = np.diff(np.append(heads, len(at)))
    place = np.arange(len(at)) - np.repeat(heads, lengths)
    weights = place_weights(int(lengths.max()))
    product = (low[at].astype(np.uint64) + np.uint64(1)) * weights[place]
    keys = spread(np.add.reduceat(product, heads) ^ lengths.astype(np.uint64))
    return np.searchsorted(offsets, starts, "right") - 1, keys
