"""The binary Golay code [23, 12, 7], which is perfect: every word is within 3 bits of one codeword."""

from __future__ import annotations

from itertools import combinations

import numpy as np

from postlode.llm.shared import worker_cache

LENGTH, DATA = 23, 12
# x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
GENERATOR = 0b110001110101


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, LENGTH - DATA - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - (LENGTH - DATA))
    return word


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and of the high 11 bits, and the error pattern of each syndrome."""
    cache = worker_cache()
    if "golay" not in cache:
        low = np.array([_remainder(w) for w in range(1 << 12)], np.int32)
        high = np.array([_remainder(w << 12) for w in range(1 << 11)], np.int32)
        errors = np.zeros(1 << (LENGTH - DATA), np.int32)
        for weight in (1, 2, 3):
            for bits in combinations(range(LENGTH), weight):
                pattern = sum(1 << b for b in bits)
                errors[_remainder(pattern)] = pattern
        cache["golay"] = low, high, errors
    return cache["golay"]


def decode(words: np.ndarray) -> np.ndarray:
    """Index, the 12 data bits, of the codeword nearest to each 23-bit word."""
    low, high, errors = _tables()
    words = words.astype(np.int32)
    syndrome = low[words & 0xFFF] ^ high[words >> 12]
    return (words ^ errors[syndrome]) >> (LENGTH - DATA)


def nearby(words: np.ndarray, width: int) -> np.ndarray:
    """Per word the distinct codeword indices of it and of its one-bit neighbours, padded with -1.

    Two words at most two bits apart have a neighbour in common, hence an index. ``width`` is the number of
    bits in use; the others are zero in every word.
    """
    flips = np.array([0, *(1 << b for b in range(width))], np.int32)
    found = np.sort(decode((words.astype(np.int32)[:, None] ^ flips).ravel()).reshape(len(words), -1), axis=1)
    again = np.zeros(found.shape, bool)
    again[:, 1:] = found[:, 1:] == found[:, :-1]
    found = np.where(again, -1, found)
    most = int((~again).sum(axis=1).max(initial=1))
    return -np.sort(-found, axis=1)[:, :most]
