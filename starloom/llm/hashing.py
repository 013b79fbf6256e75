"""Rolling hashes of byte ranges, by prefix sums modulo 2^64."""

from __future__ import annotations

import numpy as np

_rng = np.random.default_rng(20240229)
#: A random 64-bit value per byte, for two independent hashes.
BYTE_VALUES = _rng.integers(1, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Odd bases and their inverses modulo 2^64.
BASES = [int(x) | 1 for x in _rng.integers(2**62, 2**63, 2, dtype=np.uint64)]
INVERSES = [pow(b, -1, 2**64) for b in BASES]

#: Powers that a worker keeps; those for longer buffers are made anew.
REMEMBERED = 1 << 21

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0, base^1, ..., at least n of them, modulo 2^64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        filled = np.full(max(n, 1 << 16), np.uint64(base))
        filled[0] = 1
        have = np.cumprod(filled, dtype=np.uint64)
        if n <= REMEMBERED:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers, one to one."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Prefix:
    """Hashes of any ranges of one byte buffer."""

    def __init__(self, raw: np.ndarray, which: int = 0):
        """``raw``: bytes, or 64-bit values of wider symbols."""
        self.which = which
        n = len(raw)
        values = raw if raw.dtype == np.uint64 else BYTE_VALUES[which][raw]
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * powers(BASES[which], n), dtype=np.uint64, out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash of raw[start:end] for each pair; equal bytes have equal hashes wherever they stand."""
        back = powers(INVERSES[self.which], len(self.sums))
        return mix((self.sums[ends] - self.sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def windows(hashes: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """A hash of each ``size`` neighbouring hashes, in order."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = out * np.uint64(BASES[which]) + hashes[i : i + n]
    return mix(out)


#: White space of the word rule: blank, and tab to carriage return.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


#: Bytes of plain words: ASCII letters and digits, and all bytes of other characters.
IS_PLAIN = np.zeros(256, bool)
IS_PLAIN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def words(
    raw: np.ndarray, offsets: np.ndarray, in_word: np.ndarray = ~IS_SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word in the buffer, and the number of words before each text."""
    ink = in_word[raw]
    n = len(raw)
    if not n:
        empty = np.empty(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    first = np.zeros(n + 1, bool)
    first[offsets] = True  # a text begins a new word whatever stands before it
    starts = ink.copy()
    starts[1:] &= ~ink[:-1] | first[1:n]
    last = ink.copy()
    last[:-1] &= ~ink[1:] | first[1:n]
    begin = np.flatnonzero(starts)
    return begin, np.flatnonzero(last) + 1, np.searchsorted(begin, offsets)


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the flags in each text."""
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return np.diff(sums[offsets])
