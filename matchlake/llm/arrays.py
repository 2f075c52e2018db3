"""Word arrays of Arrow text batches.

Texts of a batch lie in one buffer, so words are found and hashed for many
rows at once: a word's hash is a polynomial over its bytes modulo 2**64, taken
from running sums, then mixed. Batches are worked through in groups of rows of
at most ``GROUP`` bytes; a longer text is a group of its own and is cut at
separators, so memory follows the longest text, not the batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

GROUP = 1 << 18
CUT = 1 << 20
BASE = 0x9E3779B97F4A7C55  # odd
INVERSE = pow(BASE, -1, 1 << 64)

WHITE = np.zeros(256, bool)
WHITE[[0x20, 9, 10, 11, 12, 13]] = True
# everything in ASCII that is no letter or digit
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
LINE = np.zeros(256, bool)
LINE[10] = True
_SAME = np.arange(1, 257, dtype=np.uint64)
_LOWER = _SAME.copy()
_LOWER[65:91] += np.uint64(32)

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, CUT)
        for i, base in enumerate((BASE, INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[i] = np.cumprod(p, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of the rows ``lo`` to ``hi`` of a batch, in order."""

    lo: int
    hi: int
    row: np.ndarray  # row of each word, from 0 at lo
    hash: np.ndarray  # uint64
    size: np.ndarray  # bytes
    more: dict[str, np.ndarray]  # results of the extras

    @property
    def rows(self) -> int:
        return self.hi - self.lo

    def per_row(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.rows)


@dataclass
class Piece:
    """A stretch of bytes with its words: for extras that need more."""

    low: np.ndarray  # mapped bytes, plus one
    start: np.ndarray
    end: np.ndarray
    sums: np.ndarray
    inverse: np.ndarray

    def prefix(self, n: int) -> np.ndarray:
        """Hash of each word's first ``n`` bytes (of all, if it is shorter)."""
        stop = np.minimum(self.start + n, self.end)
        return mix((self.sums[stop] - self.sums[self.start]) * self.inverse[self.start] + np.uint64(n))

    def suffix(self, n: int) -> np.ndarray:
        begin = np.maximum(self.end - n, self.start)
        return mix((self.sums[self.end] - self.sums[begin]) * self.inverse[begin] + np.uint64(256 + n))

    def byte(self, back: int) -> np.ndarray:
        """The byte ``back`` places before each word's end, 0 if there is none."""
        at = self.end - back
        return np.where(at >= self.start, self.low[np.maximum(at, 0)], np.uint64(0))


def buffers(col) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a text column; nulls are empty texts."""
    arr = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    if isinstance(arr, pa.ChunkedArray):
        arr = pa.concat_arrays(arr.chunks) if arr.num_chunks else pa.array([], pa.large_string())
    arr = arr.cast(pa.large_string())
    if arr.null_count:
        arr = arr.fill_null("")
    _, off, data = arr.buffers()
    if not len(arr):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(off, np.int64)[arr.offset : arr.offset + len(arr) + 1]
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def groups(offsets: np.ndarray, limit: int = GROUP) -> Iterator[tuple[int, int]]:
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def _cuts(data: np.ndarray, a: int, b: int, separator: np.ndarray) -> Iterator[tuple[int, int]]:
    while b - a > CUT:
        at, step = a + CUT, CUT
        while True:  # up to the next separator
            seps = np.flatnonzero(separator[data[at : min(at + step, b)]])
            if len(seps):
                at += int(seps[0])
                break
            at = min(at + step, b)
            if at >= b:
                break
        yield a, at
        a = at
    if b > a:
        yield a, b


def words(
    col,
    separator: np.ndarray = WHITE,
    lower: bool = False,
    extras: dict[str, Callable[[Piece], np.ndarray]] | None = None,
) -> Iterator[Words]:
    """Words of a text column, group of rows by group of rows. Empty and null
    texts have no words but keep their rows."""
    offsets, data = buffers(col)
    table = _LOWER if lower else _SAME
    for lo, hi in groups(offsets):
        parts = []
        for a, b in _cuts(data, int(offsets[lo]), int(offsets[hi]), separator):
            raw = data[a:b]
            inside = ~separator[raw]
            inner = offsets[lo + 1 : hi] - a
            inner = inner[(inner > 0) & (inner < b - a)]
            first, last = inside.copy(), inside.copy()
            first[1:] &= ~inside[:-1]
            last[:-1] &= ~inside[1:]
            first[inner] |= inside[inner]
            last[inner - 1] |= inside[inner - 1]
            start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
            low = table[raw]
            power, inverse = _power(b - a + 1)
            sums = np.zeros(b - a + 1, np.uint64)
            np.cumsum(low * power[:-1], out=sums[1:])
            row = np.searchsorted(offsets[lo : hi + 1] - a, start, side="right") - 1
            piece = Piece(low, start, end, sums, inverse)
            hashed = mix((sums[end] - sums[start]) * inverse[start])
            parts.append((row, hashed, end - start, {k: f(piece) for k, f in (extras or {}).items()}))
        if not parts:
            none = np.zeros(0, np.int64)
            parts = [(none, none.astype(np.uint64), none, {k: none.astype(np.uint64) for k in extras or {}})]
        joined = parts[0][:3] if len(parts) == 1 else [np.concatenate([p[i] for p in parts]) for i in range(3)]
        more = {k: np.concatenate([p[3][k] for p in parts]) for k in extras or {}}
        yield Words(lo, hi, *joined, more)


def hash_word(word: str, lower: bool = False) -> int:
    """The hash that ``words`` gives a single word."""
    got = next(words(pa.array([word]), np.zeros(256, bool), lower))
    return int(got.hash[0])


def class_counts(col, classes: list[np.ndarray]) -> np.ndarray:
    """Bytes of each class per row: an array of rows x classes."""
    offsets, data = buffers(col)
    out = np.zeros((len(offsets) - 1, len(classes)), np.int64)
    for lo, hi in groups(offsets):
        a, b = int(offsets[lo]), int(offsets[hi])
        raw = data[a:b]
        at = offsets[lo : hi + 1] - a
        for k, member in enumerate(classes):
            run = np.zeros(b - a + 1, np.int64)
            np.cumsum(member[raw], out=run[1:])
            out[lo:hi, k] = run[at[1:]] - run[at[:-1]]
    return out


def merge_counts(keys: np.ndarray, *sums: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys with the sums of their values."""
    if not len(keys):
        return (keys, *sums)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return (keys[at], *(np.add.reduceat(s[order], at) for s in sums))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
