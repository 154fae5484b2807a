"""The perfect binary Golay code of length 23: nearest codewords, as the index of a fuzzy hash.

Every 23-bit word lies within 3 errors of exactly one codeword. A word is given the indices of all codewords within 4
errors: its nearest one and, if that is 3 errors away, the five that are 4 away. The nearest codeword of any word that
differs in one bit is among them.
"""

from __future__ import annotations

import functools

import numpy as np

#: Generator polynomial of the code, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 (fixed value).
GENERATOR = 0b101011100011


def remainder(words: np.ndarray) -> np.ndarray:
    """Division by the generator: the 11-bit syndrome of 23-bit words."""
    left = words.astype(np.int64).copy()
    for bit in range(22, 10, -1):
        left ^= np.where(left >> bit & 1, GENERATOR << (bit - 11), 0)
    return left


@functools.cache
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By syndrome: the error pattern of the nearest codeword; patterns of weight 4 (or -1); their number."""
    bits = 1 << np.arange(23, dtype=np.int64)
    i, j, k, l = (x.ravel() for x in np.meshgrid(*[np.arange(23)] * 4, indexing="ij"))
    near = np.zeros(2048, dtype=np.int64)
    for patterns in (bits[i] | bits[j] | bits[k],):
        weight = np.bitwise_count(patterns)
        for w in (3, 2, 1):
            near[remainder(patterns[weight == w])] = patterns[weight == w]
    near[0] = 0
    rising = (i < j) & (j < k) & (k < l)
    four = bits[i[rising]] | bits[j[rising]] | bits[k[rising]] | bits[l[rising]]
    syndrome = remainder(four)
    order = np.argsort(syndrome, kind="stable")
    syndrome, four = syndrome[order], four[order]
    count = np.bincount(syndrome, minlength=2048)
    more = np.full((2048, 5), -1, dtype=np.int64)
    start = np.concatenate([[0], np.cumsum(count)[:-1]])
    full = np.bitwise_count(near) == 3  # only these have codewords at 4 errors
    rank = np.arange(len(four)) - start[syndrome]
    use = full[syndrome] & (rank < 5)
    more[syndrome[use], rank[use]] = four[use]
    return near, more, np.where(full, count, 0)


def nearest(words: np.ndarray) -> np.ndarray:
    """Index (0 to 4095) of the nearest codeword: the message bits of the systematic form."""
    near, _, _ = tables()
    words = words.astype(np.int64)
    return (words ^ near[remainder(words)]) >> 11


def nearby(words: np.ndarray) -> np.ndarray:
    """Six indices per word, -1 where there are fewer: all codewords within 4 errors, the nearest first."""
    near, more, _ = tables()
    words = words.astype(np.int64)
    syndrome = remainder(words)
    first = (words ^ near[syndrome]) >> 11
    rest = more[syndrome]
    return np.concatenate([first[:, None], np.where(rest >= 0, (words[:, None] ^ rest) >> 11, -1)], axis=1)
