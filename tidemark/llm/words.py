"""Word boundaries and hashes over Arrow text columns, as numpy arrays.

Texts are handled in runs of about a megabyte, so memory does not grow with the batch; a single longer
text is a run of its own. Every hash is a fixed function of the bytes, the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

RUN_BYTES = 1 << 20
_R = 0x9E3779B97F4A7C15
_R_INVERSE = pow(_R, -1, 1 << 64)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), RUN_BYTES + 1)
        for value, name in ((_R, "_powers"), (_R_INVERSE, "_inverses")):
            steps = np.full(size, value, np.uint64)
            steps[0] = 1
            globals()[name] = np.cumprod(steps)
    return _powers, _inverses


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class PrefixHash:
    """Hashes of any substrings of a byte array, from one running sum."""

    def __init__(self, data: np.ndarray) -> None:
        powers, self.inverses = _power_tables(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverses[starts] + (ends - starts).astype(np.uint64))


def hash_bytes(value: bytes) -> int:
    """The hash that ``PrefixHash`` gives to these bytes."""
    data = np.frombuffer(value, np.uint8)
    return int(PrefixHash(data).of(np.array([0]), np.array([len(data)]))[0])


@dataclass
class Run:
    """Some consecutive texts of a batch: text i is ``data[offsets[i]:offsets[i + 1]]``."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1

    def spans(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of bytes for which ``inside`` holds, none across texts: starts, ends, first span of each text."""
        before = np.empty(len(inside), bool)
        after = np.empty(len(inside), bool)
        if len(inside):
            before[0], before[1:] = False, inside[:-1]
            after[-1], after[:-1] = False, inside[1:]
            edges = self.offsets[(self.offsets > 0) & (self.offsets < len(inside))]
            before[edges] = False
            after[edges - 1] = False
        starts = np.flatnonzero(inside & ~before)
        ends = np.flatnonzero(inside & ~after) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)


def runs(texts: pa.Array, run_bytes: int = RUN_BYTES) -> Iterator[Run]:
    """The texts of a string array; a null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if n == 0:
        return
    _, where, content = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(content, np.uint8) if content is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + run_bytes, "right")) - 1
        last = min(n, max(last, first + 1))
        yield Run(first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


@cache
def _letter_table() -> np.ndarray:
    """Of each code point, whether ``[^\\W\\d_]`` matches it."""
    return np.array([c.isalnum() and not c.isdecimal() for c in map(chr, range(0x110000))])


@cache
def _lower_table() -> np.ndarray:
    """The small form of each code point below 0x800, where it takes two bytes as well."""
    small = [c.lower() for c in map(chr, range(0x800))]
    return np.array([ord(s) if len(s) == 1 and 0x80 <= ord(s) < 0x800 else k for k, s in enumerate(small)])


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the characters beyond ASCII in UTF-8 bytes: where each begins, its bytes, its code point."""
    at = np.flatnonzero(data >= 0xC0)
    lead = data[at].astype(np.int64)
    size = 2 + (lead >= 0xE0) + (lead >= 0xF0)
    value = lead & (0x7F >> size)
    for k in range(1, 4):
        more = size > k
        value[more] = value[more] << 6 | data[at[more] + k] & 0x3F
    return at, size, value


def letters_and_small(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes belong to letters, and the bytes with capitals of one or two bytes made small in place."""
    small = LOWER[data]
    inside = (small >= 97) & (small <= 122)
    at, size, value = code_points(data)
    letter = _letter_table()[value]
    for k in range(4):
        inside[at[letter & (size > k)] + k] = True
    two = at[size == 2]
    lower = _lower_table()[value[size == 2]]
    small[two], small[two + 1] = 0xC0 | lower >> 6, 0x80 | lower & 0x3F
    return inside, small


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` word hashes."""
    n = len(words) - size + 1
    h = np.zeros(max(n, 0), np.uint64)
    for k in range(size):
        h = h * np.uint64(_R) + words[k : k + max(n, 0)]
    return mix(h + np.uint64(size))
