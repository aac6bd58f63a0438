"""Benchmark decontamination by size-partitioned MinHash containment search.

An item is contained in a document when at least ``percent`` per cent of its
distinct ``width``-word shingles occur in the document's whole text.  Items
are partitioned by set size (powers of two).  Each partition has its own
MinHash permutation and sketch length: an item keeps the k least hashes of
its set, with k one more than the shingles that an item of the partition may
lack.  So a document that contains an item holds one of its sketch shingles
for certain, however long the document is, and no similarity over the union
of a short and a long set is ever estimated.  Documents with fewer shingles
than the item needs are passed over.  What a sketch hit proposes is verified
on the whole sets.

An item of fewer than ``width`` words is one shingle, its whole word sequence.
It is contained in a document that holds this sequence anywhere: the
documents' windows of its number of words are probed as well.

Documents are read once and not shuffled.  Items are the query side: they go
to the tasks in blocks of about ``BLOCK_SHINGLES`` shingles, one pass over
the documents for each block.  A block's matches are stored and its items
freed before the next is collected, so the driver and the tasks hold one
block, however large the benchmark; one item must fit into memory.

Defined cases: NULL or blank items match nothing, NULL or blank documents
contain nothing; a text of fewer than ``width`` words is one shingle, and in
a document its shorter windows count for items as short; of rows repeated with
one id the best match counts; extra columns are ignored; empty tables give an
empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyho.llm import hashing as H
from tallyho.llm.components import row_keyed, saved

BLOCK_SHINGLES = 1_000_000
_TABLE = 1 << 20
_A, _B = H.stream(21, 64) | np.uint64(1), H.stream(22, 64)
FOUND = "doc_id long, item_id long, n_item long, n_shared long"


def sketch(shingles: np.ndarray, percent: int) -> np.ndarray:
    """The least hashes of an item's set under the permutation of its size partition."""
    size = len(shingles).bit_length()
    largest = (1 << size) - 1
    k = min(len(shingles), largest - -(-percent * largest // 100) + 1)
    order = np.argsort(shingles * _A[size] + _B[size], kind="stable")
    return shingles[order[:k]]


def _index(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(H.shingle_sets(batch.column(1), width))
            words = np.minimum(H.word_counts(batch.column(1)), width)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([sketch(s, percent).tobytes() for s in sets], pa.binary()), pa.array(words, pa.int64())],
                names=["item_id", "n", "shingles", "sketch", "words"],
            )

    return run


class Block:
    """The items of one block: sketch hash -> items, and their whole sets.  ``short``: the numbers of words of items without a full shingle."""

    def __init__(self, rows: list[tuple], width: int, percent: int):
        self.percent = percent
        self.short = tuple(sorted({r[3] for r in rows if r[3] < width}))
        self.ids = [r[0] for r in rows]
        self.sets = [np.frombuffer(bytes(r[1]), np.uint64) for r in rows]
        self.sizes = np.array([len(s) for s in self.sets], dtype=np.int64)
        sketches = [np.frombuffer(bytes(r[2]), np.uint64) for r in rows]
        keys = np.concatenate([np.zeros(0, np.uint64), *sketches])
        owners = np.repeat(np.arange(len(rows)), [len(s) for s in sketches])
        order = np.argsort(keys, kind="stable")
        self.keys, self.owners = keys[order], owners[order]
        self.table = np.zeros(_TABLE, dtype=bool)
        self.table[self.keys & np.uint64(_TABLE - 1)] = True

    def proposed(self, hashes: np.ndarray, rows: np.ndarray) -> dict[int, set[int]]:
        """row -> items with a sketch shingle in it."""
        likely = np.flatnonzero(self.table[hashes & np.uint64(_TABLE - 1)])
        own = hashes[likely]
        lo, hi = np.searchsorted(self.keys, own, "left"), np.searchsorted(self.keys, own, "right")
        hit = np.flatnonzero(hi > lo)
        hit = hit[np.unique(np.stack((rows[likely[hit]], lo[hit]), axis=1), axis=0, return_index=True)[1]]  # a repeated shingle once a row
        out: dict[int, set[int]] = {}
        for i in hit.tolist():
            out.setdefault(int(rows[likely[i]]), set()).update(self.owners[lo[i] : hi[i]].tolist())
        return out


def _search(block, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Block = block.value
        for batch in batches:
            ids = batch.column(0).to_pylist()
            found: list[tuple] = []
            for hashes, rows in H.flat_shingles(batch.column(1), width, items.short):
                proposed = items.proposed(hashes, rows)
                if proposed:  # each row's shingles side by side
                    order = np.argsort(rows, kind="stable")
                    hashes, rows = hashes[order], rows[order]
                for row, candidates in proposed.items():
                    own = np.unique(hashes[np.searchsorted(rows, row, "left") : np.searchsorted(rows, row, "right")])
                    for c in sorted(candidates):
                        if 100 * len(own) < items.percent * items.sizes[c]:
                            continue
                        at = np.minimum(np.searchsorted(own, items.sets[c]), len(own) - 1)
                        shared = int((own[at] == items.sets[c]).sum())
                        if 100 * shared >= items.percent * items.sizes[c]:
                            found.append((ids[row], items.ids[c], int(items.sizes[c]), shared))
            columns = list(zip(*found, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "item_id", "n_item", "n_shared"])

    return run


def contained(docs: DataFrame, items: DataFrame, width: int = 5, percent: int = 80, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """doc_id, item_id, n_item, n_shared, containment for every contained item of every document."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    index = saved(items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("item_id IS NOT NULL").mapInArrow(_index(width, percent), "item_id long, n long, shingles binary, sketch binary, words long").where("n > 0"), "items")
    blocks = max(1, math.ceil((index.agg(F.sum("n")).first()[0] or 0) / block_shingles))
    parts = []
    for b in range(blocks):
        rows = index.where(F.expr(f"pmod(xxhash64(item_id), {blocks}L) = {b}")).select("item_id", "shingles", "sketch", "words").collect()  # about block_shingles
        block = spark.sparkContext.broadcast(Block(sorted(map(tuple, rows)), width, percent))
        parts.append(saved(texts.mapInArrow(_search(block, width), FOUND), f"matches-{b}"))
        block.destroy()
        del rows, block
    best = reduce(DataFrame.union, parts).groupBy("doc_id", "item_id", "n_item").agg(F.max("n_shared").alias("n_shared"))
    return best.withColumn("containment", F.col("n_shared") / F.col("n_item"))


def decontaminated(docs: DataFrame, items: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows whose text contains no item, each judged by its own text, whether its id is unique, repeated or NULL."""
    rows = row_keyed(docs)
    found = saved(contained(rows.select(F.col("__row_key").alias("doc_id"), "text"), items, width, percent).select(F.col("doc_id").alias("__row_key")).distinct(), "contaminated")
    return rows.join(found, "__row_key", "left_anti").select(docs.columns)
