"""Packing of tokenized documents into fixed-length sequences.

A document's ids (with an end id) are cut into full pieces of ``capacity``
ids and a rest.  A full piece is a sequence of its own.  The rests are dealt
at random into groups of about ``group`` pieces; each group is packed by
first-fit decreasing, where a tournament tree over the bins' free room finds
the first bin with room enough in log2(bins) steps.  Groups are independent
tasks, so nothing grows with the corpus but their number.

Padding: a sequence is padded to ``capacity`` unless its length is a power of
two.  Defined cases: a NULL or empty text is one piece, its end id; a
document longer than ``capacity`` becomes many pieces; repeated rows are
packed as often as they occur; columns other than doc_id and text are
ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyho.llm.components import saved
from tallyho.llm.tokens import encoded

CAPACITY = 2048
GROUP = 16_384


def _pieces(path: str, keep_space: bool, capacity: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, start, length, crc, total, ids = [], [], [], [], [], []
            for key, row in zip(batch.column(0).to_pylist(), encoded(batch.column(1), path, keep_space), strict=True):
                for at in range(0, len(row), capacity):
                    part = row[at : at + capacity].astype("<u4")
                    doc.append(key)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    total.append(len(row))
                    if keep_ids:
                        ids.append(part.view(np.int32))
            columns = [pa.array(x, pa.int64()) for x in (doc, start, length, crc, total)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if keep_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def pieces(docs: DataFrame, path: str, keep_space: bool = True, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """The pieces of every document: doc_id, start, length, ids_crc32, doc_tokens, and the ids if asked for."""
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * keep_ids
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_pieces(path, keep_space, capacity, keep_ids), schema)


class Tournament:
    """Bins in a row, each with its free room; the inner nodes hold the most room below them."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.most = [room] * (2 * self.leaves)

    def put(self, size: int) -> tuple[int, int]:
        """Puts a piece into the first bin with room for it: (bin, offset from the bin's full room)."""
        most, node = self.most, 1
        while node < self.leaves:
            node *= 2
            if most[node] < size:
                node += 1
        left = most[node]
        most[node] = left - size
        place = node - self.leaves
        while node > 1:
            node //= 2
            best = max(most[2 * node], most[2 * node + 1])
            if most[node] == best:
                break
            most[node] = best
        return place, left


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each size; equal sizes keep their order."""
    order = np.argsort(-sizes, kind="stable")
    bins, offsets = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
    tree = Tournament(len(sizes), capacity)
    for i in order.tolist():
        bins[i], left = tree.put(int(sizes[i]))
        offsets[i] = capacity - left
    return bins, offsets


def _pack_group(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("row", "ascending")])
        bins, offsets = first_fit_decreasing(table.column("length").to_numpy(), capacity)
        group = table.column("pack_group").to_numpy()
        keep = table.drop_columns(["pack_group", "row"])
        # Even numbers; the full pieces have odd ones.
        return keep.append_column("sequence_id", pa.array(2 * (group * (1 << 32) + bins))).append_column("offset", pa.array(offsets))

    return run


def pack(parts: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``parts`` (a stored table with a length column) and, for each row, sequence_id and offset."""
    parts = parts.withColumn("row", F.monotonically_increasing_id())
    full = parts.where(F.col("length") == capacity).withColumn("sequence_id", F.col("row") * 2 + 1).withColumn("offset", F.lit(0).cast("long")).drop("row")
    rest = parts.where(F.col("length") < capacity)
    groups = max(1, math.ceil(rest.count() / group))
    schema = rest.drop("row").schema.add("sequence_id", "long").add("offset", "long")
    dealt = rest.withColumn("pack_group", F.expr(f"pmod(xxhash64(row, length), {groups}L)"))
    return full.unionByName(dealt.groupBy("pack_group").applyInArrow(_pack_group(capacity), schema))


def packed(docs: DataFrame, path: str, keep_space: bool = True, capacity: int = CAPACITY, group: int = GROUP, keep_ids: bool = False) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    return pack(saved(pieces(docs, path, keep_space, capacity, keep_ids), "pieces"), capacity, group)


def sequences(parts: DataFrame, capacity: int = CAPACITY, pad: int = 0) -> DataFrame:
    """sequence_id and its ids, padded as described above, from packed pieces that kept their ids."""
    joined = parts.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))  # at most ``capacity`` ids
    ids = F.flatten(F.col("parts.ids"))
    size = F.size(ids)
    room = F.when(size.bitwiseAND(size - 1) == 0, 0).otherwise(F.lit(capacity) - size)
    return joined.select("sequence_id", F.concat(ids, F.array_repeat(F.lit(pad), room)).alias("ids"))
