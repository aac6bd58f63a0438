"""Vectorized hashing of the words and word shingles of Arrow text columns.

A word is a maximal run of characters other than space and \\t \\n \\v \\f \\r,
with A-Z lower-cased.  Its hash is a polynomial over its UTF-8 bytes (prefix
sums modulo 2**64, so a whole chunk of rows is hashed in a few array passes),
finished with a 64-bit mixer.  A shingle hash combines the hashes of ``k``
consecutive words.  A text with fewer than ``k`` words has one shingle, its
whole word sequence; a text without words (or NULL) has none.

Memory: rows are hashed in chunks of about ``CHUNK`` bytes, and a longer row
in pieces cut at white space, so the working arrays do not grow with a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tallyho.llm.columns import hold

CHUNK = 1 << 19
_U = np.uint64
_GOLD = 0x9E3779B97F4A7C15
_BASE = _U(0xD6E8FEB86659FD93)
_BASE_INV = _U(pow(0xD6E8FEB86659FD93, -1, 1 << 64))

_SEP = np.zeros(256, dtype=bool)
_SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finisher."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers for a seed."""
    with np.errstate(over="ignore"):
        return mix(_U(seed) * _U(0x2545F4914F6CDD1D) + np.arange(1, n + 1, dtype=np.uint64) * _U(_GOLD))


_fold = np.arange(256)
_fold[65:91] += 32
_BYTE = (stream(1, 256) | _U(1))[_fold]  # A-Z share the value of a-z
_PLACE = stream(2, 64) | _U(1)
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    hold("powers", _powers.clear)
    if not _powers or len(_powers["up"]) < n + 1:
        size = max(n + 1, CHUNK + 1)
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column; a NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string()).cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=len(column) + 1, offset=8 * column.offset) if len(column) else np.zeros(1, dtype=np.int64)
    data = column.buffers()[2] if len(column) else None
    return (np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)), offsets


def _chunk_words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of ``data`` and the number of words in each row ``bounds`` delimits."""
    n = len(data)
    if not n:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(bounds) - 1, dtype=np.int64)
    up, down = _power_tables(n)
    letter = ~_SEP[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[bounds] = True
    begin, end = letter.copy(), letter.copy()
    begin[1:] &= ~letter[:-1] | edge[1:n]
    end[:-1] &= ~letter[1:] | edge[1:n]
    first, last = np.flatnonzero(begin), np.flatnonzero(end) + 1
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up[:n], out=total[1:])
    hashes = mix((total[last] - total[first]) * down[first] + (last - first).astype(np.uint64) * _U(_GOLD))
    counts = np.diff(np.searchsorted(first, bounds))
    return hashes, counts


def word_hashes(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Chunks of rows: (first row, hashes of all their words, words per row)."""
    data, offsets = text_buffers(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK, side="right")) - 1)
        lo, hi = int(offsets[row]), int(offsets[stop])
        if hi - lo <= 2 * CHUNK:
            yield row, *_chunk_words(data[lo:hi], offsets[row : stop + 1] - lo)
        else:  # one long row, in pieces cut at white space
            parts = []
            while lo < hi:
                cut = min(lo + CHUNK, hi)
                while cut < hi and not _SEP[data[cut]]:
                    ahead = np.flatnonzero(_SEP[data[cut : cut + CHUNK]])
                    cut = cut + int(ahead[0]) if len(ahead) else min(cut + CHUNK, hi)
                parts.append(_chunk_words(data[lo:cut], np.array([0, cut - lo]))[0])
                lo = cut
            words = np.concatenate(parts)
            yield row, words, np.array([len(words)])
        row = stop


def _full(words: np.ndarray, k: int) -> np.ndarray:
    """The hash of the ``k`` words from each word on."""
    n = max(0, len(words) - k + 1)
    full = np.full(n, _U(k) * _U(_GOLD & 0xFFFFFFFF), dtype=np.uint64)
    for j in range(k):
        full += words[j : j + n] * _PLACE[j]
    return mix(full)


def _short(words: np.ndarray) -> np.ndarray:
    """The hash of a sequence of fewer than ``k`` words."""
    return mix(np.atleast_1d((words * _PLACE[: len(words)]).sum(dtype=np.uint64) + _U(len(words)) * _U(_GOLD & 0xFFFFFFFF)))


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """For each row, in order, the sorted distinct hashes of its ``k``-word shingles."""
    for _, words, counts in word_hashes(column):
        full = _full(words, k)
        at = 0
        for count in counts.tolist():
            if count >= k:
                one = np.sort(full[at : at + count - k + 1])
                yield one[np.concatenate(([True], one[1:] != one[:-1]))]
            elif count:
                yield _short(words[at : at + count])
            else:
                yield np.zeros(0, dtype=np.uint64)
            at += count


def word_counts(column: pa.Array) -> np.ndarray:
    """The number of words of each row."""
    return np.concatenate([np.zeros(0, dtype=np.int64), *(counts for _, _, counts in word_hashes(column))])


def flat_shingles(column: pa.Array, k: int, also: tuple[int, ...] = ()) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Chunks of (shingle hashes, with repeats; their rows).

    ``also``: numbers of words below ``k`` whose windows are given too; a
    window hashes as a text that is that word sequence.
    """
    for first, words, counts in word_hashes(column):
        full = _full(words, k)
        rows = np.repeat(np.arange(len(counts)), counts)
        inside = rows[: len(full)] == rows[k - 1 :]
        ends = np.cumsum(counts)
        few = np.flatnonzero((counts > 0) & (counts < k))
        short = [_short(words[ends[i] - counts[i] : ends[i]]) for i in few.tolist()]
        hashes, owners = [full[inside], *short], [rows[: len(full)][inside], few]
        for n in also:
            window = _full(words, n)
            inside = rows[: len(window)] == rows[n - 1 :]
            hashes.append(window[inside])
            owners.append(rows[: len(window)][inside])
        yield np.concatenate(hashes), first + np.concatenate(owners)


def digest(values: np.ndarray) -> bytes:
    """16 bytes that stand for a sorted distinct array of 64-bit numbers."""
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()
