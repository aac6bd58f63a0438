"""Ranked lexical search by presence masks.

One pass over the documents keeps, of each, its number of terms and the
places and frequencies of the terms that some item asks for (a forward index
over the items' vocabulary, stored).  Counts over the whole corpus follow
from it: documents N, terms L, and each term's document frequency.

The search reads the index in blocks of documents.  Within a block:

1. every term has its documents and what it adds to their scores;
2. for an item, each of its terms sets one bit in the masks of its documents,
   and documents with equal masks are grouped;
3. a mask's maximum score is the sum, over its terms, of the most that the
   term adds anywhere in the block;
4. masks are evaluated by descending maximum: the documents of a mask get
   their exact scores; once ``top`` documents reach more than the next mask's
   maximum, no other document of the block can be among the best.

A task keeps each item's best over all of its blocks, so later blocks are
finished sooner; Spark joins the tasks' lists in two steps.  Items go to the
tasks in blocks of about ``BLOCK_TERMS`` (item, term) pairs, so what is
broadcast does not grow with the items; each block of items reads the
documents once.

Score of a document with n terms for an item, in 64-bit integers, ``div``
rounding down: the sum over the item's distinct terms of
``w * ((1000000000 * tf) div (1000 * tf + 8 * m))`` with
``m = 10 + (90 * n * N) div L`` and ``w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))``.

Defined cases: a NULL or blank text has no terms and is found by nothing; an
item without terms finds nothing; rows of one item_id are one item, of all
their terms, and so are rows without item_id; repeated documents are ranked
each, equal scores by ascending doc_id (NULL last); other columns are
ignored; empty tables give an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyho.llm.components import saved
from tallyho.llm.wordscan import byte_set, scanned

TOP = 10
BLOCK_TERMS = 1_000_000
BLOCK_DOCS = 8192
SALT = 64
LETTERS = byte_set(range(0x30, 0x3A), range(0x41, 0x5B), range(0x61, 0x7B), range(0x80, 0x100))
_INDEX = "doc_id long, n long, terms array<int>, tfs array<int>"
_FOUND = "item_id long, doc_id long, score long"


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for w in scanned(batch.column(1), LETTERS, ~LETTERS):
            pairs = np.unique(w.rows * max(1, len(w.distinct)) + w.codes)
            rows, codes = pairs // max(1, len(w.distinct)), pairs % max(1, len(w.distinct))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), w.distinct.take(pa.array(codes)).cast(pa.large_string()).cast(pa.string())], names=["item_id", "term"])


def _forward(vocabulary):
    """The documents' terms that are in a sorted vocabulary, by their places in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value.cast(pa.large_binary())
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_DOCS):
                batch = whole.slice(at, BLOCK_DOCS)
                n = np.zeros(batch.num_rows, dtype=np.int64)
                keys, counts = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
                for w in scanned(batch.column(1), LETTERS, ~LETTERS):
                    n += np.bincount(w.rows, minlength=len(n))
                    place = pc.index_in(w.distinct, known).fill_null(-1).to_numpy().astype(np.int64)[w.codes]
                    some = np.flatnonzero(place >= 0)
                    key, count = np.unique(w.rows[some] * len(known) + place[some], return_counts=True)
                    keys.append(key)
                    counts.append(count)
                key, inverse = np.unique(np.concatenate(keys), return_inverse=True)  # a long text comes in several chunks
                tf = np.zeros(len(key), dtype=np.int64)
                np.add.at(tf, inverse, np.concatenate(counts))
                size = max(1, len(known))
                bounds = pa.array(np.searchsorted(key // size, np.arange(len(n) + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(bounds, pa.array(x, pa.int32())) for x in (key % size, tf)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), *lists], names=["doc_id", "n", "terms", "tfs"])

    return run


def _frequencies(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], names=["term", "df"])

    return run


@dataclass
class Items:
    """The items of one block, each by its terms' places in the vocabulary, and the corpus counts."""

    ids: list[int | None]
    terms: list[np.ndarray]
    weights: np.ndarray
    documents: int
    words: int
    top: int


class Block:
    """Some documents by term: ``docs[begin[t]:begin[t + 1]]`` hold term t, and it adds ``adds`` to their scores."""

    def __init__(self, items: Items, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray):
        docs = np.repeat(np.arange(len(n)), sizes)
        order = np.argsort(terms, kind="stable")
        terms, tfs, self.docs = terms[order], tfs[order].astype(np.int64), docs[order]
        if 90 * int(n.max(initial=0)) * items.documents < 1 << 62:
            m = 10 + (90 * n * items.documents) // max(1, items.words)
        else:
            m = np.array([10 + 90 * x * items.documents // items.words for x in n.tolist()], dtype=np.int64)
        self.adds = items.weights[terms] * (1_000_000_000 * tfs // (1000 * tfs + 8 * m[self.docs]))
        self.begin = np.searchsorted(terms, np.arange(len(items.weights) + 1))
        self.size = len(n)
        self.most = np.zeros(len(items.weights), dtype=np.int64)
        used = np.flatnonzero(np.diff(self.begin))
        if len(used):
            self.most[used] = np.maximum.reduceat(self.adds, self.begin[:-1][used])

    def masks(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents with any of the terms, their masks: a bit for each term, 64 to a number)."""
        masks = np.zeros((-(-len(terms) // 64), self.size), dtype=np.uint64)
        for i, t in enumerate(terms.tolist()):
            masks[i >> 6, self.docs[self.begin[t] : self.begin[t + 1]]] |= np.uint64(1 << (i & 63))
        docs = np.flatnonzero(masks.any(axis=0))
        return docs, masks[:, docs]

    def scores(self, docs: np.ndarray, terms: np.ndarray) -> np.ndarray:
        """The exact scores of some documents (ascending)."""
        out = np.zeros(len(docs), dtype=np.int64)
        for t in terms.tolist():
            own = self.docs[self.begin[t] : self.begin[t + 1]]
            at = np.minimum(np.searchsorted(own, docs), len(own) - 1)
            out += np.where(own[at] == docs, self.adds[self.begin[t] + at], 0)
        return out


_BYTE = (np.arange(256)[:, None] >> np.arange(8)) & 1


def highest(masks: np.ndarray, most: np.ndarray) -> np.ndarray:
    """The maximum score of each mask: the sum of ``most`` over its bits, a byte at a time."""
    out = np.zeros(masks.shape[1], dtype=np.int64)
    for word in range(masks.shape[0]):
        octets = np.ascontiguousarray(masks[word]).astype("<u8").view(np.uint8).reshape(-1, 8)
        for b in range(8):
            own = most[64 * word + 8 * b : 64 * word + 8 * b + 8]
            if len(own):
                out += (_BYTE[:, : len(own)] @ own)[octets[:, b]]
    return out


def _by_mask(masks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(the distinct masks, documents in order of their mask, where each mask's documents begin)."""
    order = np.lexsort(masks)
    masks = masks[:, order]
    new = np.concatenate(([True], (masks[:, 1:] != masks[:, :-1]).any(axis=0))) if masks.shape[1] else np.zeros(0, dtype=bool)
    first = np.flatnonzero(new)
    return masks[:, first], order, np.append(first, masks.shape[1])


def best_of_block(block: Block, terms: np.ndarray, top: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) that hold all of the block's ``top`` best with scores of at least ``least``."""
    terms = terms[block.most[terms] > 0]
    if not len(terms):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    docs, masks = block.masks(terms)
    distinct, order, begin = _by_mask(masks)
    bound = highest(distinct, block.most[terms])
    queue = np.argsort(-bound, kind="stable")
    bound, total = bound[queue], np.cumsum(np.diff(begin)[queue])  # documents up to each mask
    found, scores = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    at, want = 0, 2 * top
    while at < len(queue) and bound[at] >= max(1, least):
        stop = int(np.searchsorted(total, (total[at - 1] if at else 0) + want)) + 1
        some = queue[at : min(stop, int(np.searchsorted(-bound, -max(1, least), side="right")))]
        own = np.sort(docs[np.concatenate([order[begin[k] : begin[k + 1]] for k in some.tolist()])])
        found.append(own)
        scores.append(block.scores(own, terms))
        at, want = at + len(some), 2 * want
        known = np.concatenate(scores)
        if len(known) >= top:  # a document with an equal score may still come first by its id
            least = max(least, int(np.partition(known, -top)[-top]))
    return np.concatenate(found), np.concatenate(scores)


def _search(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        best: dict[int, list[tuple]] = {}
        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK_DOCS):
                batch = whole.slice(start, BLOCK_DOCS)
                ids = batch.column(0).to_pylist()
                lists = batch.column(2)
                block = Block(items, batch.column(1).to_numpy(), pc.list_value_length(lists).to_numpy(), lists.flatten().to_numpy(), batch.column(3).flatten().to_numpy())
                for i, terms in enumerate(items.terms):
                    kept = best.get(i, [])
                    docs, scores = best_of_block(block, terms, items.top, -kept[-1][0] if len(kept) == items.top else 1)
                    few = np.flatnonzero(scores > 0)
                    if len(few):
                        new = [(-int(scores[j]), ids[docs[j]] is None, ids[docs[j]]) for j in few.tolist()]
                        best[i] = sorted(kept + new, key=lambda x: (x[0], x[1], x[2] or 0))[: items.top]
        rows = [(items.ids[i], doc, -score) for i, kept in best.items() for score, _, doc in kept]
        columns = list(zip(*rows, strict=True)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item_id", "doc_id", "score"])

    return run


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score of each item's ``top`` best documents with a score above 0."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    asked = saved(items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).mapInArrow(_item_terms, "item_id long, term string").distinct(), "item-terms")
    blocks = max(1, math.ceil(asked.count() / block_terms))
    parts = []
    for b in range(blocks):
        own = asked.where(F.expr(f"pmod(xxhash64(item_id), {blocks}L) = {b}")).toArrow()  # about block_terms rows
        vocabulary = own.column("term").unique().sort() if own.num_rows else pa.array([], pa.string())
        words = spark.sparkContext.broadcast(vocabulary)
        index = saved(texts.mapInArrow(_forward(words), _INDEX), f"forward-index-{b}")
        size = len(vocabulary)
        n_docs, n_words = index.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        df = np.zeros(size, dtype=np.int64)
        got = index.select("terms").mapInArrow(_frequencies(size), "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()  # at most the vocabulary
        df[got.column("term").to_numpy()] = got.column("df").to_numpy()
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], dtype=np.int64)
        places = pc.index_in(own.column("term"), vocabulary).to_numpy()
        by_item: dict[int | None, list[int]] = {}
        for item, place in zip(own.column("item_id").to_pylist(), places.tolist(), strict=True):
            by_item.setdefault(item, []).append(place)
        shared = spark.sparkContext.broadcast(Items(list(by_item), [np.array(sorted(x)) for x in by_item.values()], weights, n_docs, n_words or 0, top))
        parts.append(saved(index.mapInArrow(_search(shared), _FOUND), f"best-{b}"))
        shared.destroy()
        words.destroy()
    found = reduce(DataFrame.union, parts)
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALT)))
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "salt").orderBy(*order))).where(F.col("rank") <= top).drop("rank", "salt")
    best = few.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order)).cast("int")).where(F.col("rank") <= top)
    return best.select("item_id", "rank", "doc_id", "score")
