"""White-space tokens of Arrow text columns, each distinct token handled once per slice."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 2 << 20
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library may have it


def release() -> None:
    """Gives memory that numpy and Arrow have freed back to the system, so a worker is small between batches."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


_held: dict[str, Callable[[], None]] = {}


def hold(name: str, drop: Callable[[], None]) -> None:
    """Names the cache that a worker uses now; ``drop`` empties it.

    Spark gives a worker one stage after another.  The caches that earlier
    stages left in it are emptied here, so it holds one at a time.
    """
    others = [k for k in _held if k != name]
    for k in others:
        _held.pop(k)()
    _held[name] = drop
    if others:
        release()


def token_slices(column: pa.Array, most: int = SLICE) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[str]]]:
    """(first row, row offsets, code of each token, distinct tokens) for slices of about ``most`` bytes.

    NULL and blank rows have no tokens.
    """
    for row, bounds, codes, tokens in coded_slices(column, most):
        yield row, bounds, codes, tokens.to_pylist()


def coded_slices(column: pa.Array, most: int = SLICE) -> Iterator[tuple[int, np.ndarray, np.ndarray, pa.Array]]:
    """``token_slices`` with the distinct tokens left in Arrow."""
    column = column.fill_null("").cast(pa.large_string())
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False)
    total = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    row = 0
    while row < len(column):
        stop = max(row + 1, int(np.searchsorted(total, total[row] + most, side="right")) - 1)
        parts = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(column.slice(row, stop - row)))
        bounds = parts.offsets.to_numpy().astype(np.int64)
        coded = parts.flatten().dictionary_encode()
        codes, tokens = coded.indices.to_numpy(), coded.dictionary
        bounds = bounds - bounds[0]
        blank = pc.index(tokens, pa.scalar("", tokens.type)).as_py()
        if blank >= 0:  # a blank row splits into one empty token
            keep = codes != blank
            bounds = np.concatenate(([0], np.cumsum(keep)))[bounds]
            codes = codes[keep]
        yield row, bounds, codes, tokens
        row = stop
    pa.default_memory_pool().release_unused()


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The sum of each row's values; 0 for a row without any."""
    out = np.zeros(len(bounds) - 1)
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, bounds[:-1][full])
    return out
