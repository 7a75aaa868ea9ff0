"""Distinct items of a task with their counts, handed on in few pieces."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


class Tally:
    """Adds up counts by 64-bit number; ``payload`` is what a number stands for, and may be left out.

    Additions wait until they are as many as ``limit`` and are then merged
    together, so that what is held is not sorted anew for each of them. ``full``
    merges when that is due; ``settle`` merges what still waits.
    """

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.numbers = np.empty(0, np.uint64)
        self.counts = np.empty(0, np.int64)
        self.payload: pa.Array | None = None
        self.parts: list[tuple[np.ndarray, np.ndarray, pa.Array | None]] = []
        self.waiting = 0

    def add(self, numbers: np.ndarray, counts: np.ndarray, payload: pa.Array | None = None) -> None:
        """Add distinct numbers."""
        self.parts.append((numbers, counts, payload))
        self.waiting += len(numbers)

    def settle(self) -> None:
        if not self.parts:
            return
        parts = [(self.numbers, self.counts, self.payload)] * (len(self.numbers) > 0) + self.parts
        self.parts, self.waiting = [], 0
        numbers, counts, payload = parts[0]
        if len(parts) > 1:
            both, counts = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
            order = np.argsort(both, kind="stable")
            both = both[order]
            first = np.flatnonzero(np.r_[True, both[1:] != both[:-1]])[:len(both)]
            numbers, counts = both[first], np.add.reduceat(counts[order], first) if len(first) else counts
            if payload is not None:
                payload = pa.concat_arrays([p[2] for p in parts]).take(pa.array(order[first]))
        self.numbers, self.counts, self.payload = numbers, counts, payload

    @property
    def full(self) -> bool:
        if self.waiting > self.limit:
            self.settle()
        return len(self.numbers) > self.limit
