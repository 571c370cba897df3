"""Byte-level helpers for task functions: texts as one buffer, word borders, word hashes.

All of it is vectorised numpy over about a megabyte at a time; one text longer than that is a slice
of its own, so memory follows the longest text, never the number of rows.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_U = np.uint64
_P1, _P2 = 0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1


def worker_state(name: str, make: Callable[[], object]) -> object:
    """An object kept for as long as the Python worker lives (workers are used for many tasks)."""
    state = sys.__dict__.setdefault("_lotwise_llm", {})
    if name not in state:
        state[name] = make()
    return state[name]


def word_table(separators: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(lower-casing table for A-Z, flags of bytes that belong to words once lower-cased)."""
    fold = np.arange(256, dtype=np.uint8)
    fold[65:91] += 32
    return fold, ~separators(np.arange(256))[fold]


def spaced() -> tuple[np.ndarray, np.ndarray]:
    """Words are runs of anything but space and the control characters 9 to 13."""
    return word_table(lambda b: (b == 0x20) | ((b >= 0x09) & (b <= 0x0D)))


def alphanumeric() -> tuple[np.ndarray, np.ndarray]:
    """Words are runs of ASCII letters, digits and everything beyond ASCII."""
    return word_table(lambda b: (b <= 0x2F) | ((b >= 0x3A) & (b <= 0x60)) | ((b >= 0x7B) & (b <= 0x7F)))


@dataclass
class Texts:
    """Some rows' texts in one buffer; row i holds ``data[bounds[i]:bounds[i + 1]]``."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.bounds) - 1


def texts_of(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """Cuts a string column into slices of about ``limit`` bytes; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        end = min(max(end, at + 1), len(column))
        bounds = offsets[at:end + 1]
        yield Texts(at, data[bounds[0]:bounds[-1]], bounds - bounds[0])
        at = end


def powers(n: int, second: bool) -> tuple[np.ndarray, np.ndarray]:
    """Powers of one of the hash bases and of its inverse modulo 2**64, at least ``n`` of each."""
    held = worker_state(f"powers {second}", dict)
    if held.get("n", 0) < n:
        size, base = -(-n // (1 << 18)) << 18, _P2 if second else _P1
        held["n"], held["tables"] = size, tuple(
            np.multiply.accumulate(np.concatenate([np.ones(1, _U), np.full(size - 1, p, _U)])) for p in (base, pow(base, -1, 1 << 64)))
    return held["tables"]


def scramble(h: np.ndarray) -> np.ndarray:
    """Spreads a 64-bit value over all its bits."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


class Hasher:
    """Hashes of any substrings of a buffer in constant time each, from prefix sums."""

    def __init__(self, data: np.ndarray, second: bool = False):
        forward, self._back = powers(len(data) + 1, second)
        self._sums = np.zeros(len(data) + 1, _U)
        np.cumsum((data.astype(_U) + _U(1)) * forward[:len(data)], out=self._sums[1:])

    def raw(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self._sums[ends] - self._sums[starts]) * self._back[starts]

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return scramble(self.raw(starts, ends))

    def every(self, width: int) -> np.ndarray:
        """Hash of each substring of ``width`` bytes, unscrambled."""
        n = len(self._sums) - width
        return (self._sums[width:] - self._sums[:-width]) * self._back[:n] if n > 0 else np.zeros(0, _U)


@dataclass
class Words:
    """Words of a slice: byte borders, and for each row the range of its words."""

    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray


def words_of(texts: Texts, flags: np.ndarray) -> Words:
    inside = flags[texts.data]
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    cuts = texts.bounds[(texts.bounds > 0) & (texts.bounds < len(inside))]
    before[cuts], after[cuts - 1] = False, False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(starts, ends, np.searchsorted(starts, texts.bounds))


def total_by(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums over the ranges that ``bounds`` delimits, each on its own; an empty range gives 0."""
    out = np.zeros(len(bounds) - 1, values.dtype if values.dtype.kind == "f" else np.int64)
    full = bounds[1:] > bounds[:-1]
    if full.any():
        out[full] = np.add.reduceat(values, bounds[:-1][full], dtype=out.dtype)
    return out
