"""Token ids in Huffman-coded files.

1. Texts are tokenized once and kept as id bytes; counts of all ids are
   summed map-side, one row per id and task at most.
2. The counts give a canonical code no longer than ``max_length`` bits
   (package-merge over at most vocabulary-many counts).  Only code lengths
   are stored: the codes follow from them.
3. Documents are range-partitioned and sorted by id; each partition becomes
   one file whose rows are blocks of at most ``BLOCK`` ids.  A block is
   independent: its own bit stream, the bit offset of every ``STEP``-th id,
   and the documents (or parts of a long one) that it holds.
4. Reading decodes each block alone, with a table over ``max_length`` bits,
   all checkpoints of the block side by side.

A file row: file, block, docs (doc_id, start in the file, length, part, parts),
n_ids, checkpoints, payload.  ``codebook`` is a second folder (id, length).

Defined cases: a NULL or empty text is one end id; documents with a NULL id
come first; repeated ids are ordered by their ids' bytes; a document longer
than a block spans blocks; other columns are ignored; an empty table gives
empty files.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyho.llm.components import saved
from tallyho.llm.tokens import encoded_slices, forget
from tallyho.session import scratch_path

BLOCK = 65_536
STEP = 128
MAX_LENGTH = 16
SLICE = 2 << 20  # bytes of text tokenized at a time
COUNTED = 1 << 19  # bytes of ids counted at a time
ROWS_A_FILE = 25_000
_BLOCKS = "file int, block int, docs array<struct<doc_id: bigint, start: bigint, length: int, part: int, parts: int>>, n_ids int, checkpoints binary, payload binary"
_DOCS = pa.list_(pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int32()), ("part", pa.int32()), ("parts", pa.int32())]))
_ARROW_BLOCKS = pa.schema([("file", pa.int32()), ("block", pa.int32()), ("docs", _DOCS), ("n_ids", pa.int32()), ("checkpoints", pa.binary()), ("payload", pa.binary())])


def code_lengths(counts: np.ndarray, most: int = MAX_LENGTH) -> np.ndarray:
    """Lengths of an optimal prefix code of at most ``most`` bits (package-merge); 0 for ids that don't occur.

    More than ``2 ** most`` ids get one bit more than numbering them takes.
    """
    lengths = np.zeros(len(counts), dtype=np.int64)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << most:
        most = (len(used) - 1).bit_length() + 1
    used = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[used].astype(np.float64)
    # Each level: the leaves and the pairs of the level below, by weight; leaves first among equals.
    levels, pairs = [], np.zeros(0)
    for _ in range(most):
        weights = np.concatenate((leaves, pairs))
        order = np.argsort(weights, kind="stable")
        weights = weights[order]
        levels.append(order < len(leaves))
        even = len(weights) // 2 * 2
        pairs = weights[0:even:2] + weights[1:even:2]
    take = 2 * len(used) - 2
    for is_leaf in reversed(levels):
        n = int(is_leaf[:take].sum())  # leaves come in order of weight
        lengths[used[:n]] += 1
        take = 2 * (take - n)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes by length, then id."""
    codes = np.zeros(len(lengths), dtype=np.uint64)
    code, before = 0, 0
    for size in range(1, int(lengths.max(initial=0)) + 1):
        code <<= size - before
        before = size
        own = np.flatnonzero(lengths == size)
        codes[own] = code + np.arange(len(own), dtype=np.uint64)
        code += len(own)
    return codes


def decode_table(lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For each value of the next bits: (id, code length); and how many bits that is."""
    bits = int(lengths.max(initial=1))
    ids, sizes = np.zeros(1 << bits, dtype=np.uint32), np.ones(1 << bits, dtype=np.int64)
    used = np.flatnonzero(lengths)
    used = used[np.argsort(codes[used] << (bits - lengths[used]).astype(np.uint64))]
    spans = 1 << (bits - lengths[used])
    ids[: spans.sum()] = np.repeat(used, spans)
    sizes[: spans.sum()] = np.repeat(lengths[used], spans)
    return ids, sizes, bits


def encode_block(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, bytes]:
    """(checkpoints, payload): big-endian 32-bit words of the codes one after another."""
    size = lengths[ids]
    ends = np.cumsum(size)
    begin = ends - size
    word, shift = begin >> 5, (begin & 31).astype(np.uint64)
    value = codes[ids] << (np.uint64(64) - shift - size.astype(np.uint64))
    n = int(ends[-1] + 31 >> 5) + 1
    # The bits of different ids don't overlap, so sums below 2**32 are exact.
    words = np.bincount(word, (value >> np.uint64(32)).astype(np.float64), n) + np.bincount(word + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), n)[:n]
    return begin[::STEP].astype("<u4").tobytes(), words[: int(ends[-1] + 31 >> 5)].astype(">u4").tobytes()


def decode_block(n: int, checkpoints: bytes, payload: bytes, table: tuple[np.ndarray, np.ndarray, int]) -> np.ndarray:
    """The ids of a block."""
    to_id, to_size, bits = table
    words = np.concatenate((np.frombuffer(payload, ">u4"), np.zeros(STEP * 2, np.uint32))).astype(np.uint64)
    at = np.frombuffer(checkpoints, "<u4").astype(np.int64)
    out = np.empty((STEP, len(at)), dtype=np.uint32)
    last = len(words) - 2
    for i in range(min(STEP, n)):
        word = np.minimum(at >> 5, last)  # past its end, the last lane reads zeros
        window = (words[word] << np.uint64(32) | words[word + 1]) << (at & 31).astype(np.uint64)
        value = window >> np.uint64(64 - bits)
        out[i] = to_id[value]
        at = at + to_size[value]
    return out.T.ravel()[:n] if n >= STEP else out[:n].T.ravel()[:n]


def _tokenized(path: str, keep_space: bool):
    """A slice of text at a time: a batch's ids are never held together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, rows in encoded_slices(batch.column(1), path, keep_space, SLICE):
                sizes = pa.array([len(x) for x in rows], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(rows)), sizes, pa.array([_thin(x.astype("<u4").tobytes()) for x in rows], pa.binary())], names=["doc_id", "n", "ids"])

    return run


def _thin(ids: bytes) -> bytes:
    """A flag byte, then 16-bit ids where all fit, else 32-bit ids."""
    values = np.frombuffer(ids, "<u4")
    return b"\2" + values.astype("<u2").tobytes() if values.max(initial=0) < 1 << 16 else b"\4" + ids


def _wide(kept: bytes) -> np.ndarray:
    return np.frombuffer(kept, f"<u{kept[0]}", offset=1).astype(np.int64)


def _together(rows: list[bytes], most: int) -> Iterator[list[bytes]]:
    """Rows in a row, of about ``most`` bytes together."""
    some, size = [], 0
    for x in rows:
        some.append(x)
        size += len(x)
        if size > most:
            yield some
            some, size = [], 0
    if some:
        yield some


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget()  # all ids are stored by now
    total = np.zeros(0, dtype=np.int64)
    for batch in batches:
        for some in _together(batch.column(0).to_pylist(), COUNTED):
            own = np.bincount(np.concatenate([_wide(kept) for kept in some]))
            if len(own) > len(total):
                total = np.pad(total, (0, len(own) - len(total)))
            total[: len(own)] += own
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["id", "n"])


def _encode(lengths: np.ndarray, codes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, block, start = TaskContext.get().partitionId(), 0, 0
        ids: list[np.ndarray] = []
        docs: list[dict] = []
        room = BLOCK

        def flush() -> pa.RecordBatch:
            checkpoints, payload = encode_block(np.concatenate(ids), lengths, codes)
            return pa.RecordBatch.from_pylist([{"file": file, "block": block, "docs": docs, "n_ids": BLOCK - room, "checkpoints": checkpoints, "payload": payload}], schema=_ARROW_BLOCKS)

        for batch in batches:
            for doc, kept in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                row = _wide(kept)
                cuts = _cuts(len(row), room)
                for part, (a, b) in enumerate(cuts):
                    piece = row[a:b]
                    ids.append(piece)
                    docs.append({"doc_id": doc, "start": start, "length": len(piece), "part": part, "parts": len(cuts)})
                    room -= len(piece)
                    if not room:
                        yield flush()
                        block, ids, docs, room = block + 1, [], [], BLOCK
                start += len(row)
        if ids:
            yield flush()

    return run


def _cuts(n: int, room: int) -> list[tuple[int, int]]:
    edges = [0, *range(min(room, n), n, BLOCK), n]
    return list(zip(edges[:-1], edges[1:], strict=True)) if n > room else [(0, n)]


def write(docs: DataFrame, folder: str, path: str, keep_space: bool = False, max_length: int = MAX_LENGTH) -> None:
    """Tokenizes ``docs`` (doc_id, text) and writes ``folder``/codebook and ``folder``/blocks."""
    spark = docs.sparkSession
    kept = saved(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_tokenized(path, keep_space), "doc_id long, n long, ids binary"), "ids")
    # At most one row per id of the vocabulary.
    counted = kept.select("ids").mapInArrow(_count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(int(counted["id"].max()) + 1 if len(counted) else 1, dtype=np.int64)
    counts[counted["id"]] = counted["n"]
    lengths = code_lengths(counts, max_length)
    used = np.flatnonzero(lengths)
    spark.createDataFrame(pa.table({"id": pa.array(used, pa.int64()), "length": pa.array(lengths[used], pa.int64())})).write.parquet(f"{folder}/codebook")
    files = max(1, math.ceil(kept.count() / ROWS_A_FILE))
    ordered = kept.select("doc_id", "ids").repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id", "ids")
    ordered.mapInArrow(_encode(lengths, canonical_codes(lengths)), _BLOCKS).write.parquet(f"{folder}/blocks")


def _decode(table: tuple[np.ndarray, np.ndarray, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1).to_pylist()[0]
                ids = decode_block(row["n_ids"], row["checkpoints"], row["payload"], table).astype("<u4")
                at, out = 0, []
                for doc in row["docs"]:
                    out.append({"file": row["file"], "block": row["block"], **doc, "ids": ids[at : at + doc["length"]].tobytes()})
                    at += doc["length"]
                yield pa.RecordBatch.from_pylist(out, schema=_ARROW_PARTS)

    return run


_PARTS = "file int, block int, doc_id long, start long, length int, part int, parts int, ids binary"
_ARROW_PARTS = pa.schema([("file", pa.int32()), ("block", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int32()), ("part", pa.int32()), ("parts", pa.int32()), ("ids", pa.binary())])


def _code_table(spark: SparkSession, folder: str) -> tuple[np.ndarray, np.ndarray, int]:
    book = spark.read.parquet(f"{folder}/codebook").toPandas()
    lengths = np.zeros(int(book["id"].max()) + 1 if len(book) else 1, dtype=np.int64)
    lengths[book["id"]] = book["length"]
    return decode_table(lengths, canonical_codes(lengths))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The parts of the documents in the files: file, block, doc_id, start in the file, length, part, parts, ids (bytes)."""
    return spark.read.schema(_BLOCKS).parquet(f"{folder}/blocks").mapInArrow(_decode(_code_table(spark, folder)), _PARTS)


def _digests(table: tuple[np.ndarray, np.ndarray, int]):
    """The crc of each decoded part; the ids go on only where a document spans blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _decode(table)(batches):
            ids, parts = batch.column("ids").to_pylist(), batch.column("parts").to_pylist()
            crc = pa.array([zlib.crc32(x) for x in ids], pa.int64())
            spanning = pa.array([x if n > 1 else None for x, n in zip(ids, parts, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], spanning, crc], names=[*batch.schema.names, "ids_crc32"])

    return run


def _spanning(parts: pa.Table) -> pa.Table:
    """One document that spans blocks."""
    parts = parts.sort_by("part")
    crc = 0
    for x in parts.column("ids").to_pylist():
        crc = zlib.crc32(x, crc)
    total = sum(parts.column("length").to_pylist())
    return pa.table({"file": parts.column("file")[:1], "doc_id": parts.column("doc_id")[:1], "start": parts.column("start")[:1], "n_tokens": pa.array([total], pa.int64()), "ids_crc32": pa.array([crc], pa.int64())})


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """Read back from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    blocks = spark.read.schema(_BLOCKS).parquet(f"{folder}/blocks")
    sizes = blocks.groupBy("file").agg(F.sum(F.col("n_ids").cast("long")).alias("n")).collect()  # one row a file
    base, before = [], 0
    for file, n in sorted(sizes):
        base.append((file, before))
        before += n
    bases = spark.createDataFrame(base, "file int, base long")
    parts = saved(blocks.mapInArrow(_digests(_code_table(spark, folder)), _PARTS + ", ids_crc32 long"), "parts")
    one = parts.where("parts = 1").selectExpr("file", "doc_id", "start", "CAST(length AS LONG) AS n_tokens", "ids_crc32")
    spans = parts.where("parts > 1").select("file", "doc_id", "start", "length", "part", "ids")
    many = spans.groupBy("file", "start").applyInArrow(_spanning, "file int, doc_id long, start long, n_tokens long, ids_crc32 long")
    return one.union(many).join(bases, "file").selectExpr("doc_id", "base + start AS start", "n_tokens", "ids_crc32")


def fresh_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "huffman")
