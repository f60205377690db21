"""Hashes of many substrings at once, and a table that is probed with them."""

from __future__ import annotations

import numpy as np

# Odd multipliers of two polynomial hashes modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MASK = (1 << 64) - 1


class Powers:
    """Powers of a base and of its inverse, as far as they were asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = max(n + 1, 1 << 20)
            self.up = self._powers(self.base, size)
            self.down = self._powers(self.inverse, size)
        return self.up, self.down

    @staticmethod
    def _powers(base: int, size: int) -> np.ndarray:
        out = np.full(size, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)


POWERS = tuple(Powers(b) for b in BASES)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads differences over all bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def prefixes(data: np.ndarray, which: int = 0) -> np.ndarray:
    """Prefix sums from which the hash of any substring follows."""
    up, _ = POWERS[which].upto(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    terms = data.astype(np.uint64)
    terms += np.uint64(1)
    terms *= up[: len(data)]
    np.cumsum(terms, out=out[1:])
    return out


def spans(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """Mixed hashes of ``data[start:end]``, the same wherever the bytes lie."""
    _, down = POWERS[which].upto(len(prefix))
    return mixed((prefix[ends] - prefix[starts]) * down[starts])


def all_spans(prefix: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """``spans`` of all substrings of a width."""
    n = len(prefix) - width
    _, down = POWERS[which].upto(len(prefix))
    out = prefix[width:] - prefix[:-width]
    out *= down[:n]
    return mixed(out)


class Table:
    """From 128-bit keys to runs of numbers in one pool; open addressing."""

    def __init__(self, bits: int, dtype: type = np.uint32):
        self.bits = bits
        self.dtype = dtype
        self.clear()

    def clear(self) -> None:
        n = 1 << self.bits
        self.key = np.zeros(n, np.uint64)
        self.check = np.zeros(n, np.uint64)
        self.start = np.zeros(n, np.int64)
        self.length = np.full(n, -1, np.int32)
        self.pool = np.zeros(1 << 16, self.dtype)
        self.used = self.count = 0

    @property
    def full(self) -> bool:
        return self.count > (1 << self.bits) // 2

    def slots(self, key: np.ndarray, check: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where it is not in the table."""
        mask = np.uint64((1 << self.bits) - 1)
        out = np.full(len(key), -1, np.int64)
        at = (key & mask).astype(np.int64)
        open_ = np.arange(len(key))
        while len(open_):
            here = at[open_]
            same = (self.key[here] == key[open_]) & (self.check[here] == check[open_])
            taken = self.length[here] >= 0
            hit = same & taken
            out[open_[hit]] = here[hit]
            open_ = open_[taken & ~hit]
            at[open_] = (at[open_] + 1) & int(mask)
        return out

    def add(self, key: np.ndarray, check: np.ndarray, runs: list[np.ndarray]) -> None:
        """New keys, each once, with their runs."""
        lengths = np.array([len(r) for r in runs], np.int32)
        flat = np.concatenate(runs) if runs else np.zeros(0, self.dtype)
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used : self.used + len(flat)] = flat
        starts = self.used + np.cumsum(lengths, dtype=np.int64) - lengths
        self.used += len(flat)
        self.count += len(key)
        mask = (1 << self.bits) - 1
        at = (key & np.uint64(mask)).astype(np.int64)
        open_ = np.arange(len(key))
        while len(open_):
            free = open_[self.length[at[open_]] < 0]
            _, first = np.unique(at[free], return_index=True)
            put = free[first]
            self.key[at[put]], self.check[at[put]] = key[put], check[put]
            self.start[at[put]], self.length[at[put]] = starts[put], lengths[put]
            open_ = np.setdiff1d(open_, put, assume_unique=True)
            at[open_] = (at[open_] + 1) & mask

    def runs(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The runs of the slots one after another, and their lengths."""
        lengths = self.length[slots].astype(np.int64)
        before = np.cumsum(lengths) - lengths
        total = int(lengths.sum())
        places = np.arange(total) + np.repeat(self.start[slots] - before, lengths)
        return self.pool[places], lengths
