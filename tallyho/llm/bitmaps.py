"""Bitmaps over 64-bit hashes, made by Spark and small enough to broadcast.

A bitmap has ``room`` bits for each hash of the set, and ``MOST_BITS`` at most
whatever the set: beyond that it holds ever more hashes that are not in the
set, so it may only be used where those cost work, never results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyho.llm.hashing import mix

MOST_BITS = 1 << 27
_U = np.uint64


class Bitmap:
    """A set of 64-bit numbers that may hold a few more."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.mask = _U(64 * len(words) - 1)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = mix(hashes) & self.mask
        return (self.words[at >> _U(6)] >> (at & _U(63))) & _U(1) > 0


def _set_bits(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(size // 64, dtype=np.uint64)
        for batch in batches:
            at = mix(batch.column(0).to_numpy().view(np.uint64)) & _U(size - 1)
            np.bitwise_or.at(words, at >> _U(6), _U(1) << (at & _U(63)))
        used = np.flatnonzero(words)
        for i in range(0, len(used), 65_536):
            own = used[i : i + 65_536]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(words[own].view(np.int64))], names=["word", "bits"])

    return run


def bitmap(hashes: DataFrame, n: int, room: int = 16, most_bits: int = MOST_BITS) -> Bitmap:
    """A bitmap of the one column of ``hashes``, of ``n`` rows; at most ``most_bits`` / 64 numbers come to the driver."""
    size = min(most_bits, max(1 << 12, 1 << (room * max(1, n) - 1).bit_length()))
    words = np.zeros(size // 64, dtype=np.uint64)
    got = hashes.mapInArrow(_set_bits(size), "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words[got.column("word").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return Bitmap(words)
