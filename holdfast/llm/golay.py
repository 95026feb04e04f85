"""The binary Golay code of 23 bits, 12 of them data: fixed values and key tables.

Any 23 bits are within three bits of exactly one codeword. Words at most two bits from theirs are five or more bits from
every other codeword; words three bits off are four bits from five others. The nearby codewords of a word are those within
four bits - one or six - and they include the codeword next to each word that differs in one bit.
"""

from itertools import combinations

import numpy as np

LENGTH, DATA = 23, 12
#: Fixed value: the generator polynomial.
GENERATOR = 0b101011100011


def _codewords() -> np.ndarray:
    data = np.arange(1 << DATA, dtype=np.uint32)
    rest = data << np.uint32(LENGTH - DATA)
    for bit in range(LENGTH - 1, LENGTH - DATA - 1, -1):
        rest ^= (rest >> np.uint32(bit) & np.uint32(1)) * np.uint32(GENERATOR << bit - (LENGTH - DATA))
    return data << np.uint32(LENGTH - DATA) | rest


#: By data bits, the codeword.
CODEWORDS = _codewords()


def _syndromes(words: np.ndarray) -> np.ndarray:
    check = CODEWORDS & np.uint32((1 << LENGTH - DATA) - 1)
    return check[words >> np.uint32(LENGTH - DATA)] ^ words & np.uint32((1 << LENGTH - DATA) - 1)


def _nearby_errors() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome, the error patterns that lead to nearby codewords, the nearest first, and their number."""
    errors, numbers = np.zeros((1 << LENGTH - DATA, 6), dtype=np.uint32), np.zeros(1 << LENGTH - DATA, dtype=np.int64)
    for weight in range(5):
        patterns = np.array([sum(1 << b for b in bits) for bits in combinations(range(LENGTH), weight)], dtype=np.uint32)
        for syndrome, pattern in zip(_syndromes(patterns), patterns):
            errors[syndrome, numbers[syndrome]] = pattern
            numbers[syndrome] += 1
    return errors, numbers


ERRORS, NUMBERS = _nearby_errors()


def nearest(words: np.ndarray) -> np.ndarray:
    """Data bits of the one codeword within three bits of each word."""
    return (words ^ ERRORS[_syndromes(words), 0]) >> np.uint32(LENGTH - DATA)


def nearby(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Data bits of the nearby codewords, six columns, and how many of the columns count."""
    syndromes = _syndromes(words)
    return (words[:, None] ^ ERRORS[syndromes]) >> np.uint32(LENGTH - DATA), NUMBERS[syndromes]
