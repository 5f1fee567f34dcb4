"""Words of whole texts as numpy columns: their places, their hashes and the hashes of runs of words.

A slice of rows is worked on at once: the bytes of all its texts lie behind each other, as Arrow
keeps them, and every step is one pass over that buffer. Slices hold about `SLICE_BYTES` of text,
whatever the size of the batch; a longer text is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

#: Odd multipliers of the polynomial hashes and of the final mixing, modulo 2**64.
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
MIX_1, MIX_2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


@dataclass(frozen=True)
class Alphabet:
    """Which bytes belong to words, after `lower` has been applied to every byte."""

    inside: bytes
    lower: bool

    def table(self) -> np.ndarray:
        return np.frombuffer(self.inside, np.uint8).astype(bool)


_SPACES = {0x20, *range(0x09, 0x0E)}
#: Everything but a blank and the control characters from tab to carriage return.
VISIBLE = Alphabet(bytes(b not in _SPACES for b in range(256)), lower=False)
VISIBLE_LOWER = Alphabet(VISIBLE.inside, lower=True)
#: Digits, letters a to z and every byte of a character beyond ASCII.
LETTERS = Alphabet(bytes(0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)), lower=True)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

_powers: dict[tuple[int, bool], np.ndarray] = {}


def _power(base: int, count: int, inverse: bool = False) -> np.ndarray:
    """base**0 … base**(count-1) modulo 2**64, or of its inverse."""
    have = _powers.get((base, inverse))
    if have is None or len(have) < count:
        root = pow(base, -1, 1 << 64) if inverse else base
        size = max(count, 2 * SLICE_BYTES)
        have = np.full(size, root, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size > 4 * SLICE_BYTES:  # a giant text: not kept
            return have
        _powers[base, inverse] = have
    return have[:count]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(MIX_1)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(MIX_2)
    return h ^ (h >> np.uint64(31))


def _ranges(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """The polynomial hash of values[start:end] for every pair."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power(base, len(values)), out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * _power(base, len(values) + 1, True)[starts])


@dataclass
class Words:
    """The words of consecutive texts. Text t has the words first[t] … first[t+1]-1."""

    data: np.ndarray  # bytes of all texts, lower-cased where the alphabet says so
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    _hashes: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.first) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def owner(self) -> np.ndarray:
        """The text of every word."""
        return np.repeat(np.arange(len(self)), self.counts)

    @property
    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            self._hashes = _ranges(self.data.astype(np.uint64) + np.uint64(1), self.starts, self.ends, BYTE_BASE)
        return self._hashes

    def runs(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, hashes) of all runs of `length` words that lie within one text."""
        limit = np.repeat(self.first[1:], self.counts)
        at = np.flatnonzero(np.arange(len(limit)) + length <= limit)
        return at, _ranges(self.hashes, at, at + length, WORD_BASE)

    def whole(self) -> np.ndarray:
        """A hash of each text's sequence of words."""
        return _ranges(self.hashes, self.first[:-1], self.first[1:], WORD_BASE) + np.diff(self.first).astype(np.uint64)


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    base = offsets[0] if len(offsets) else 0
    return data[base : offsets[-1] if len(offsets) else 0], offsets - base


def words_of(data: np.ndarray, offsets: np.ndarray, alphabet: Alphabet) -> Words:
    if alphabet.lower:
        data = _LOWER[data]
    inside = alphabet.table()[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    opens[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(opens)
    ends = np.flatnonzero(closes) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def sliced(texts: pa.Array, alphabet: Alphabet, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(from, to, words) for consecutive slices of rows with about `size` bytes of text each."""
    data, offsets = buffer_of(texts)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1
        stop = min(max(stop, row + 1), rows)
        a, b = offsets[row], offsets[stop]
        yield row, stop, words_of(data[a:b], offsets[row : stop + 1] - a, alphabet)
        row = stop


def joined_all(words: Words, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets): the kept words of every text, each followed by one blank."""
    chosen = np.flatnonzero(keep)
    lengths = words.ends[chosen] - words.starts[chosen] + 1
    to = np.concatenate(([0], np.cumsum(lengths)))
    out = np.full(to[-1], 0x20, np.uint8)
    inner = lengths - 1
    begin = np.repeat(to[:-1] - np.concatenate(([0], np.cumsum(inner)))[:-1], inner)
    source = np.repeat(words.starts[chosen] - np.concatenate(([0], np.cumsum(inner)))[:-1], inner)
    step = np.arange(inner.sum())
    out[step + begin] = words.data[step + source]
    kept_before = np.concatenate(([0], np.cumsum(keep)))
    return out, to[kept_before[words.first]]
