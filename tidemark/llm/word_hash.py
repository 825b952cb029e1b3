"""Word hashes and Rabin-Karp window hashes, for use inside tasks."""

from __future__ import annotations

import re

import numpy as np
import xxhash

from .common import WORD, Memo

_U = np.uint64
BASE_A, BASE_B = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93  # odd, so that they have inverses modulo 2**64
MEMO_WORDS = 100_000

_find = re.compile(WORD).findall
_memo = Memo(lambda w: xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")), MEMO_WORDS)
_powers: dict[int, np.ndarray] = {}


def words_of(text: str | None) -> list[str]:
    return _find(text) if text else []


def hashed(words: list[str]) -> np.ndarray:
    """A 64-bit hash of each word."""
    return np.fromiter(map(_memo.__getitem__, words), _U, len(words))


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(12, (n - 1).bit_length())
        have = np.full(size, base, _U)
        have[0] = 1
        have = np.cumprod(have, dtype=_U)
        _powers[base] = have
    return have[:n]


class Rolling:
    """Hashes of any span of words in O(1), from prefix sums of hash * base**place."""

    def __init__(self, hashes: np.ndarray, base: int = BASE_A):
        n = len(hashes)
        self.back = _power(pow(base, -1, 1 << 64), n + 1)
        self.sums = np.zeros(n + 1, _U)
        np.cumsum(hashes * _power(base, n), out=self.sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.back[starts]

    def windows(self, width: int) -> np.ndarray:
        """The hash of every run of ``width`` words."""
        n = len(self.sums) - width
        return (self.sums[width:] - self.sums[:n]) * self.back[:n] if n > 0 else np.zeros(0, _U)
