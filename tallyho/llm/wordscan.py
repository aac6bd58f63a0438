"""Words of Arrow text columns by a table of byte classes, in array passes.

A word is a maximal run of ``letters``; all separators are ASCII, so the work
is on UTF-8 bytes.  A-Z are lower-cased.  Words are numbered by a dictionary
of the chunk, so equal numbers are equal words.  Texts are read in chunks of
about ``CHUNK`` bytes; a longer text is read in pieces that end at a byte of
``cuts``, so the working arrays grow with a row only where it has none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from tallyho.llm.hashing import text_buffers

CHUNK = 4 << 20
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def byte_set(*members: int | range) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    for m in members:
        out[list(m) if isinstance(m, range) else m] = True
    return out


@dataclass
class Words:
    """The words of one chunk, in order."""

    rows: np.ndarray  # the row of each word
    pieces: np.ndarray  # equal for words of one row that no cut byte separates
    codes: np.ndarray  # place in ``distinct``
    distinct: pa.LargeBinaryArray
    starts: np.ndarray  # first byte, and the byte behind the last, within the chunk
    ends: np.ndarray
    data: np.ndarray  # the chunk's bytes
    first: int  # its first row, and where each of its rows begins
    bounds: np.ndarray


def _chunk(data: np.ndarray, bounds: np.ndarray, first: int, letters: np.ndarray, cuts: np.ndarray) -> Words:
    n = len(data)
    letter = letters[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[bounds] = True
    begin, end = letter.copy(), letter.copy()
    begin[1:] &= ~letter[:-1] | edge[1:n]
    end[:-1] &= ~letter[1:] | edge[1:n]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    row = np.searchsorted(bounds, starts, side="right") - 1
    # Both terms only rise, so their sum changes where either does.
    ahead = np.bincount(np.searchsorted(starts, np.flatnonzero(cuts[data])), minlength=len(starts))
    pieces = np.cumsum(ahead[: len(starts)]) + row
    offsets = np.concatenate((np.zeros(1, np.int64), np.cumsum(ends - starts, dtype=np.int64)))
    kept = np.ascontiguousarray(_FOLD[data[letter]])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
    coded = words.dictionary_encode()
    return Words(row + first, pieces, coded.indices.to_numpy().astype(np.int64), coded.dictionary, starts, ends, data, first, bounds)


def scanned(column: pa.Array, letters: np.ndarray, cuts: np.ndarray | None, most: int = CHUNK) -> Iterator[Words]:
    """Chunks of words; rows without any word have none.  ``cuts`` None: a row is never read in pieces."""
    data, offsets = text_buffers(column)
    breaks = byte_set() if cuts is None else cuts
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1)
        lo, hi = int(offsets[row]), int(offsets[stop])
        if hi - lo <= 2 * most or cuts is None:
            yield _chunk(data[lo:hi], offsets[row : stop + 1] - lo, row, letters, breaks)
        else:  # one long row
            while lo < hi:
                end = min(lo + most, hi)
                while end < hi and not breaks[data[end - 1]]:
                    ahead = np.flatnonzero(breaks[data[end : end + most]])
                    end = end + int(ahead[0]) + 1 if len(ahead) else min(end + most, hi)
                yield _chunk(data[lo:end], np.array([0, end - lo]), row, letters, breaks)
                lo = end
        row = stop
