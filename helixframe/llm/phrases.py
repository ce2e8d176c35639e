"""Prefix-free phrases of byte strings: content-defined triggers and what they delimit.

Every window of ``WIDTH`` bytes picks a trigger, the least of the rolling hashes of its
``KMER``-byte strings (leftmost on ties). Consecutive windows with one trigger form a phrase:
the bytes that those windows cover. Equal windows pick equal triggers at equal places, so
they lie in phrases of one trigger string, and a window lies in exactly one phrase of its
text. Phrases are cut at ``PIECE`` windows in long texts, which changes where a phrase ends
but not what holds for windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

from helixframe.llm.shingles import mixed

WIDTH = 100
KMER = 32
PIECE = 1 << 19
_INDEX_BITS = np.uint64(20)
_INDEX_MASK = np.uint64((1 << 20) - 1)
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    tables = []
    for factor in (base, pow(base, -1, 1 << 64)):
        steps = np.full(PIECE + WIDTH + 1, factor, np.uint64)
        steps[0] = 1
        tables.append(np.multiply.accumulate(steps))
    return tables[0], tables[1]


_tables: list[tuple[np.ndarray, np.ndarray]] = []


class Rolling:
    """Hashes of any substring of a piece of at most ``PIECE + WIDTH`` bytes."""

    def __init__(self, data: np.ndarray, which: int) -> None:
        if not _tables:
            _tables.extend(_powers(b) for b in _BASES)
        powers, self.inverse = _tables[which]
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.inverse[starts])

    def of_width(self, width: int) -> np.ndarray:
        n = len(self.sums) - width
        return mixed((self.sums[width:] - self.sums[:n]) * self.inverse[:n])


class Phrases(NamedTuple):
    trigger: np.ndarray  # hash of the trigger string
    content: np.ndarray  # hash of all bytes of the phrase
    start: np.ndarray  # first byte in the text
    windows: np.ndarray  # number of windows; the phrase has windows + WIDTH - 1 bytes


def _least_of(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` consecutive values."""
    reach, least = 1, values
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def pieces(text: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """Overlapping pieces of a text, each with its offset; every window lies in one piece."""
    data = np.frombuffer(text, np.uint8)
    for at in range(0, len(data) - WIDTH + 1, PIECE):
        yield at, data[at : at + PIECE + WIDTH - 1]


def phrases_of(text: bytes) -> Iterator[Phrases]:
    for at, data in pieces(text):
        first, second = Rolling(data, 0), Rolling(data, 1)
        kmers = first.of_width(KMER)
        keyed = (kmers & ~_INDEX_MASK) | np.arange(len(kmers), dtype=np.uint64)
        chosen = (_least_of(keyed, WIDTH - KMER + 1) & _INDEX_MASK).astype(np.int64)
        changes = np.flatnonzero(chosen[1:] != chosen[:-1]) + 1
        starts = np.concatenate([[0], changes])
        windows = np.diff(np.concatenate([starts, [len(chosen)]]))
        yield Phrases(kmers[chosen[starts]], second.of(starts, starts + windows + WIDTH - 1), starts + at, windows)


def window_hashes(text: bytes, start: int, windows: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of each window of a stretch of at most ``PIECE`` windows."""
    data = np.frombuffer(text, np.uint8)[start : start + windows + WIDTH - 1]
    return Rolling(data, 0).of_width(WIDTH), Rolling(data, 1).of_width(WIDTH)
