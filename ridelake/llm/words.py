"""Words of texts as arrays of codes, and hashes of windows over them.

A word is a run of bytes other than ASCII white space, ``[^\\x20\\x09-\\x0D]+``, which is what
``bytes.split`` gives. Window hashes are polynomials in the words' 64-bit codes, computed for all
windows of an array by one cumulative sum.
"""

from __future__ import annotations

import numpy as np
import xxhash

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_BASE_2 = 0xC2B2AE3D27D4EB4F


class WordCodes(dict):
    """64-bit codes of words, remembered up to a limit."""

    def __init__(self, limit: int = 200_000) -> None:
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_powers: dict[tuple[int, int], np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        known = _powers[base] = np.multiply.accumulate(steps)
    return known[:n]


def window_hashes(codes: np.ndarray, width: int, second: bool = False) -> np.ndarray:
    """The hash of every ``width`` consecutive codes; ``second`` gives an independent one."""
    n = len(codes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    base = _BASE_2 if second else _BASE
    if second:
        codes = mixed(codes)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * _power_table(base, len(codes)), out=sums[1:])
    back = _power_table(pow(base, -1, 1 << 64), n)
    return mixed((sums[width:] - sums[:n]) * back)
