"""Sets of hashed word shingles, computed for many texts at once."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

SIZE = 4
PIECE_BYTES = 1 << 21

# White space of the word rule becomes a blank, A-Z are lower-cased, other bytes stay.
_FOLD = bytes(0x20 if 0x09 <= b <= 0x0D else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACES = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64)]


def mixed(values: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over the hash."""
    x = values ^ (values >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_table(size: int) -> np.ndarray:
    if len(_powers[0]) < size:
        factors = np.full(max(size, 64), _BASE, np.uint64)
        factors[0] = 1
        _powers[0] = np.multiply.accumulate(factors)
    return _powers[0]


def word_hashes(folded: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first positions of the words of folded text."""
    data = np.frombuffer(folded, np.uint8)
    visible = data != 0x20
    edges = np.flatnonzero(np.diff(np.concatenate([[False], visible, [False]]).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64), starts
    lengths = ends - starts
    offsets = np.cumsum(lengths) - lengths
    letters = data[visible].astype(np.uint64) + np.uint64(1)
    local = np.arange(len(letters)) - np.repeat(offsets, lengths)
    letters *= _power_table(int(lengths.max()))[local]
    return mixed(np.add.reduceat(letters, offsets)), starts


def _long_word_hashes(folded: bytes) -> np.ndarray:
    """Word hashes of one long text, in pieces that end at blanks."""
    found, at = [], 0
    while at < len(folded):
        stop = folded.find(b" ", at + PIECE_BYTES)
        stop = len(folded) if stop < 0 else stop
        found.append(word_hashes(folded[at:stop])[0])
        at = stop
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def _set_of(words: np.ndarray) -> np.ndarray:
    if not len(words):
        return words
    if len(words) < SIZE:
        whole = (words * _PLACES[: len(words)]).sum(dtype=np.uint64) + np.uint64(len(words))
        return mixed(np.array([whole], np.uint64))
    total = words[: len(words) - SIZE + 1] * _PLACES[0]
    for i in range(1, SIZE):
        total = total + words[i : len(words) - SIZE + 1 + i] * _PLACES[i]
    return np.unique(mixed(total))


def shingle_sets(texts: Iterable[str | None]) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, ascending; empty where it has no word.

    A text of fewer than four words has one shingle, its whole sequence.
    """
    pending: list[bytes] = []
    size = 0
    for text in texts:
        folded = text.encode("utf-8", "replace").translate(_FOLD) if text else b""
        if len(folded) > PIECE_BYTES:
            yield from _joined_sets(pending)
            pending, size = [], 0
            yield _set_of(_long_word_hashes(folded))
            continue
        pending.append(folded)
        size += len(folded)
        if size > PIECE_BYTES:
            yield from _joined_sets(pending)
            pending, size = [], 0
    yield from _joined_sets(pending)


def _joined_sets(folded: list[bytes]) -> Iterator[np.ndarray]:
    if not folded:
        return
    hashes, starts = word_hashes(b" ".join(folded))
    firsts = np.cumsum([0] + [len(f) + 1 for f in folded])
    bounds = np.searchsorted(starts, firsts)
    for i in range(len(folded)):
        yield _set_of(hashes[bounds[i] : bounds[i + 1]])
