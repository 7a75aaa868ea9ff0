"""Words of many texts at once, as 64-bit numbers.

A slice of texts is one array of bytes. Word borders are found with array
operations, and a word's number is the difference of two prefix sums of a
polynomial over its bytes, so that no Python object is made per word. The same
sums over word numbers give the number of any run of words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 .. n-1 of the base and of its inverse; kept for the next call."""
    held = _powers.get("up")
    if held is None or len(held) < n:
        size = max(n, 1 << 20)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of ``x``."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums of value * base ** place before each place, one longer than ``values``."""
    up, _ = powers(len(values) + 1)
    sums = np.empty(len(values) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(values * up[:-1], out=sums[1:])
    return sums


def run_numbers(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Numbers of the runs ``[start, end)``; equal runs get equal numbers wherever they stand."""
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    """Words of a slice of texts: byte borders, numbers, and where each text's words begin."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    numbers: np.ndarray
    offsets: np.ndarray  # of texts, into the words

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all runs of ``size`` words inside one text, and the places of their first words."""
        n = len(self.numbers)
        if n < size:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        fits = np.zeros(n + 1, dtype=np.int64)  # a place fits if its run ends inside its text
        counts = np.maximum(np.diff(self.offsets) - size + 1, 0)
        np.add.at(fits, self.offsets[:-1], (counts > 0).astype(np.int64))
        np.add.at(fits, self.offsets[:-1] + counts, -(counts > 0).astype(np.int64))
        at = np.flatnonzero(np.cumsum(fits[:-1]) > 0)
        return run_numbers(prefix_sums(self.numbers), at, at + size), at


def text_bytes(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts as one array, and each text's place in it (no nulls)."""
    borders = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset:texts.offset + len(texts) + 1]
    if texts.buffers()[2] is None:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[borders[0]:borders[-1]]
    return data, (borders - borders[0]).astype(np.int64)


def words_of(texts: pa.StringArray, lower: bool) -> Words:
    """Maximal runs of bytes other than blank, tab and line ends; A-Z lowered if asked."""
    data, borders = text_bytes(texts)
    if lower:
        data = _LOWER[data]
    inside = ~_SPACE[data]
    first, last = inside.copy(), inside.copy()
    if len(data):
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        heads = borders[:-1][borders[:-1] < len(data)]
        first[heads] = inside[heads]
        tails = borders[1:][borders[1:] > 0] - 1
        last[tails] = inside[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    numbers = run_numbers(prefix_sums(_BYTE[data]), starts, ends)
    return Words(data, starts, ends, numbers, np.searchsorted(starts, borders))
