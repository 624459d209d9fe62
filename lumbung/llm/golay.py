"""The binary Golay code [23, 12, 7]: which codewords lie near a 23-bit word.

Every word has exactly one codeword at distance 3 or less. Words at distance 3
from it have five more codewords at distance 4. So two words that differ in one
bit always have a codeword in common among "the nearest one, and those at
distance 4": if both have the same nearest codeword that is it; if not, both are
at distance 3 from their own and at distance 4 from the other's.

Everything is derived from the generator polynomial.
"""

from __future__ import annotations

import functools
from itertools import combinations

import numpy as np

# Fixed value: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011
LENGTH, CHECK_BITS = 23, 11
MOST_CODEWORDS = 6


def remainder(word: int) -> int:
    """The syndrome: the remainder of the word, seen as a polynomial, by the generator."""
    for shift in range(LENGTH - 1, CHECK_BITS - 1, -1):
        if word >> shift & 1:
            word ^= GENERATOR << (shift - CHECK_BITS)
    return word


@functools.cache
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the bytes of a word; per syndrome the error patterns and how many there are.

    The first pattern leads to the nearest codeword, the others to those at distance 4.
    """
    of_bit = [remainder(1 << i) for i in range(LENGTH)]
    of_byte = np.zeros((3, 256), np.uint32)
    for part in range(3):
        for value in range(256):
            bits = [of_bit[8 * part + i] for i in range(8) if value >> i & 1 and 8 * part + i < LENGTH]
            of_byte[part, value] = functools.reduce(int.__xor__, bits, 0)
    patterns: list[list[int]] = [[] for _ in range(1 << CHECK_BITS)]
    for weight in range(5):
        for places in combinations(range(LENGTH), weight):
            syndrome = functools.reduce(int.__xor__, (of_bit[p] for p in places), 0)
            patterns[syndrome].append(sum(1 << p for p in places))
    errors = np.zeros((1 << CHECK_BITS, MOST_CODEWORDS), np.uint32)
    for syndrome, found in enumerate(patterns):
        errors[syndrome, : len(found)] = found
    return of_byte, errors, np.array([len(p) for p in patterns], np.uint8)


def codeword_indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word up to six 12-bit codeword indices, and a mask of those that exist."""
    of_byte, errors, found = tables()
    words = words.astype(np.uint32)
    syndrome = of_byte[0, words & 255] ^ of_byte[1, words >> 8 & 255] ^ of_byte[2, words >> 16 & 255]
    codewords = words[:, None] ^ errors[syndrome]
    return codewords >> CHECK_BITS, np.arange(MOST_CODEWORDS)[None, :] < found[syndrome][:, None]
