"""Vectorised word splitting and hashing inside Arrow batches.

The operators that work in Python share these helpers: text arrives as an Arrow column, is
viewed as one byte array (no per-word Python objects) and words come out as byte spans and
64-bit hashes. Work goes through pieces of about ``PIECE`` bytes cut between words, so the
temporary arrays stay small for any document length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20
_MULT = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _tables() -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    # A word byte is a digit, a letter or part of a non-ASCII character; the rest separates.
    word = np.zeros(256, dtype=bool)
    word[48:58] = word[65:91] = word[97:123] = True
    word[128:] = True
    return lower, word


LOWER, WORD = _tables()


@dataclass
class Words:
    """The words of rows ``first .. first + len(counts) - 1`` of a batch, in order.

    ``low`` holds the rows' lower-cased bytes, ``starts``/``ends`` the words' spans in it,
    ``counts`` the number of words of each row and ``hashes`` one 64-bit hash a word.
    """

    first: int
    counts: np.ndarray
    low: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray

    def bounds(self) -> np.ndarray:
        """Word offsets of the rows (one more than rows)."""
        return np.concatenate(([0], np.cumsum(self.counts)))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column; null counts as the empty text."""
    column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    raw = raw[offs[0] : offs[-1]]
    return raw, offs - offs[0]


_POWERS = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_MULT, _INV)):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads a uint64 hash over all its bits."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def _split(low: np.ndarray, is_word: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans and hashes of the runs of word bytes; ``cuts`` are row ends that also end a word."""
    before = np.zeros(len(low) + 1, dtype=bool)
    before[1:] = is_word
    after = before[1:].copy()
    before = before[:-1]
    inner = cuts[(cuts > 0) & (cuts < len(low))]
    before[inner] = False
    starts = np.flatnonzero(is_word & ~before)
    after[:-1] = is_word[1:]
    after[-1:] = False
    after[inner - 1] = False
    ends = np.flatnonzero(is_word & ~after) + 1
    power, inverse = _powers(len(low) + 1)
    sums = np.zeros(len(low) + 1, dtype=np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * power[: len(low)], out=sums[1:])
    return starts, ends, mix((sums[ends] - sums[starts]) * inverse[starts])


def _pieces(is_word: np.ndarray, piece: int) -> Iterator[tuple[int, int]]:
    """Cut one long row into pieces between words (a longer word stays whole)."""
    at, n = 0, len(is_word)
    while at < n:
        end = min(at + piece, n)
        while end < n:
            gaps = np.flatnonzero(~is_word[at:end])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
                break
            end = min(end + piece, n)
        yield at, end
        at = end


def split_words(column: pa.Array, word: np.ndarray = WORD, lower: np.ndarray = LOWER, piece: int = PIECE) -> Iterator[Words]:
    """The words of a string column, in groups of whole rows of about ``piece`` bytes."""
    raw, offs = text_bytes(column)
    rows, row = len(offs) - 1, 0
    while row < rows:
        last = max(row + 1, int(np.searchsorted(offs, offs[row] + piece, side="right")) - 1)
        part = raw[offs[row] : offs[last]]
        low, is_word = lower[part], word[part]
        if last == row + 1 and len(part) > piece:
            found = [(a, _split(low[a:b], is_word[a:b], np.zeros(0, dtype=np.int64))) for a, b in _pieces(is_word, piece)]
            starts = np.concatenate([a + s for a, (s, _, _) in found])
            ends = np.concatenate([a + e for a, (_, e, _) in found])
            hashes = np.concatenate([h for _, (_, _, h) in found])
            counts = np.array([len(starts)], dtype=np.int64)
        else:
            cuts = offs[row : last + 1] - offs[row]
            starts, ends, hashes = _split(low, is_word, cuts)
            counts = np.diff(np.searchsorted(starts, cuts))
        yield Words(row, counts, low, starts, ends, hashes)
        row = last


def row_means(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Mean of each row's run of ``values`` (0 for rows without any)."""
    sums = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    at = np.concatenate(([0], np.cumsum(counts)))
    return (sums[at[1:]] - sums[at[:-1]]) / np.maximum(counts, 1)
