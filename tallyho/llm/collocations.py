"""Phrase collocations by SON partitioning.

A phrase is 1 to ``longest`` words in a row within a piece of text; counts are
per language.  The documents are dealt into ``SHARDS`` shards.

1. Local mining.  Each shard is mined completely at the lowered support
   ``ceil(support / SHARDS)``: a phrase that stays below it in every shard
   stays below ``support`` in all of them together.  Level by level, a phrase
   is counted only if its first and last words but one are locally frequent
   in its shard.  A shard is spread over many tasks: they pre-aggregate in
   arrays of 64-bit phrase hashes, and Spark adds up by (shard, hash).  A
   task's hashes hardly repeat by then, so they are dealt out before Spark
   adds up, not added up once more in front of the shuffle.
2. The locally frequent phrases of all shards are united.
3. Exact global count of every united phrase, by its own words, in one more
   pass, added up in Arrow within a task and by Spark across tasks; the
   support is applied to these counts.

Which phrases are worth counting is told to the tasks by a bitmap over phrase
hashes of bounded size (``bitmaps``).  A bit
that is set for another phrase, or a hash that two phrases share, only has
more phrases counted, as step 3 counts words, not hashes; a full bitmap costs
shuffle, never results.

Collocations.  Of a candidate of two or more words the cut (first words,
rest) with the lowest ``floor(1000000 a a / (l r))`` counts.  Candidates
within a longer candidate that occurs at least half as often are dropped.
Each language's best ``top`` are found in two steps, so no task meets more
than ``SALT`` times ``top`` rows of a language.

Defined cases: NULL text is empty, NULL language is ``und``; repeated rows
and ids count as often as they occur; other columns are ignored; a text of
any length is read in pieces that end where no phrase goes on; an empty table
gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyho.llm.bitmaps import bitmap
from tallyho.llm.columns import release
from tallyho.llm.components import saved
from tallyho.llm.hashing import mix, stream
from tallyho.llm.wordscan import Words, byte_set, scanned

SHARDS = 3
SHARDS_MOST = 64
SUPPORT = 10
LONGEST = 3
TOP = 2000
SALT = 64
BUFFER = 1 << 20  # phrase hashes added up in a task before they go on
PHRASES = 1 << 19  # rows of counted phrases held in a task before they are added up, and their bytes
PHRASE_BYTES = 32 << 20
CHUNK = 2 << 20
BREAKS = byte_set(*b".,;:!?", range(0x0A, 0x0E))
LETTERS = ~(BREAKS | byte_set(0x20, 0x09))
_U = np.uint64
_PLACE = stream(41, 64) | _U(1)
_SHARD = stream(42, 256)
_ALL = _SHARD[-1]  # stands for all shards together


def _distinct(keys: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys in order, a place of each, number of each key among them, how often each occurs); keys are under ``below``."""
    if below <= 4 * len(keys):
        n = np.bincount(keys, minlength=below)
        distinct = np.flatnonzero(n)
        number = np.empty(below, dtype=np.int64)
        number[keys] = np.arange(len(keys))
        at = number[distinct]
        number[distinct] = np.arange(len(distinct))
        return distinct, at, number[keys], n[distinct]
    order = np.argsort(keys)
    ranked = keys[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = ranked[1:] != ranked[:-1]
    begin = np.flatnonzero(new)
    inverse = np.empty(len(keys), dtype=np.int64)
    inverse[order] = np.cumsum(new) - 1
    return ranked[begin], order[begin], inverse, np.diff(begin, append=len(keys))


def _grams(w: Words, group: np.ndarray, seeds: np.ndarray, salts: np.ndarray, longest: int, known: list) -> Iterator[tuple]:
    """For each number of words k: (first word of an occurrence of each distinct phrase of a group, its group, its hash, how often it occurs).

    ``group``: the group of each word; ``seeds`` and ``salts``: what its
    language adds to the hash, and its shard to the bitmap's key.  A phrase
    is met only if both its parts of k - 1 words are in ``known[k - 2]``.
    """
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, w.distinct.to_numpy(zero_copy_only=False)), dtype=np.uint64, count=len(w.distinct))
    size = max(1, len(hashed))
    at = np.arange(len(w.codes))
    ids = group  # of the phrase's first k - 1 words
    hashes, groups = mix(seeds), np.arange(len(seeds))
    for k in range(1, longest + 1):
        if k > 1:
            fit = known[k - 2].holds(hashes ^ salts[groups])
            good = np.zeros(len(w.codes) + 1, dtype=bool)
            good[at] = fit[ids[at]]
            at = at[:-1] if len(at) and at[-1] + k > len(w.codes) else at
            at = at[good[at] & good[at + 1] & (w.pieces[at] == w.pieces[at + k - 1])]
        distinct, first, inverse, n = _distinct(ids[at] * size + w.codes[at + k - 1], len(hashes) * size)
        before, last = distinct // size, distinct % size
        hashes = mix(hashes[before] * _PLACE[k] + hashed[last])
        groups = groups[before]
        ids = np.zeros(len(w.codes), dtype=np.int64)
        ids[at] = inverse
        yield k, at[first], groups, hashes, n


def _grouped(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    """(the group of each row, language seeds, shard salts, (language, shard) of each group)."""
    keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
    place = {k: i for i, k in enumerate(dict.fromkeys(keys))}
    seeds = np.array([xxhash.xxh3_64_intdigest(lang) for lang, _ in place], dtype=np.uint64)
    return np.array([place[k] for k in keys], dtype=np.int64), seeds, np.array([_SHARD[shard] for _, shard in place], dtype=np.uint64), list(place)


class _Sums:
    """Counts of phrase hashes by shard, added up in arrays."""

    def __init__(self) -> None:
        self.parts: dict[int, list] = {}
        self.held = 0

    def add(self, shard: int, hashes: np.ndarray, n: np.ndarray) -> None:
        self.parts.setdefault(shard, []).append((hashes, n))
        self.held += len(hashes)

    def drained(self) -> Iterator[pa.RecordBatch]:
        for shard, parts in self.parts.items():
            hashes, inverse = np.unique(np.concatenate([h for h, _ in parts]), return_inverse=True)
            sums = np.zeros(len(hashes), dtype=np.int64)
            np.add.at(sums, inverse, np.concatenate([n for _, n in parts]))
            for i in range(0, len(hashes), 65_536):
                own = hashes[i : i + 65_536]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), shard), pa.int32()), pa.array(own.view(np.int64)), pa.array(sums[i : i + 65_536])], names=["shard", "gram", "n"])
        self.parts, self.held = {}, 0


class _Phrases:
    """Counts by lang, k and phrase, added up in a task as long as few enough are distinct."""

    def __init__(self) -> None:
        self.parts: list[pa.Table] = []
        self.rows = self.bytes = 0

    def add(self, lang: pa.Array, k: int, phrase: pa.Array, n: np.ndarray) -> None:
        part = pa.table({"lang": lang, "k": pa.array(np.full(len(n), k), pa.int32()), "phrase": phrase, "n": pa.array(n, pa.int64())})
        self.parts.append(part)
        self.rows += part.num_rows
        self.bytes += part.nbytes

    def drained(self, rows: int = 0, size: int = 0) -> Iterator[pa.RecordBatch]:
        """Nothing up to so many rows and bytes; else the sums, unless those are less than half as many and are held."""
        if self.rows <= rows and self.bytes <= size:
            return
        sums = pa.concat_tables(self.parts).group_by(["lang", "k", "phrase"], use_threads=False).aggregate([("n", "sum")]).rename_columns(["lang", "k", "phrase", "n"])
        self.parts, self.rows, self.bytes = [sums], sums.num_rows, sums.nbytes
        if 2 * self.rows <= rows and 2 * self.bytes <= size:
            return
        for batch in sums.to_batches(max_chunksize=65_536):
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2).cast(pa.large_string()).cast(pa.string()), batch.column(3)], names=batch.schema.names)
        self.parts, self.rows, self.bytes = [], 0, 0


def _mine(level: int, known):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, maps = _Sums(), [b.value for b in known]
        for batch in batches:
            group, seeds, salts, own = _grouped(batch)
            shards = np.array([shard for _, shard in own])
            for w in scanned(batch.column(2), LETTERS, BREAKS, CHUNK):
                for k, _, groups, hashes, n in _grams(w, group[w.rows], seeds, salts, level, maps):
                    if k == level:
                        for shard in np.unique(shards[groups]).tolist():
                            mine = shards[groups] == shard
                            sums.add(shard, hashes[mine], n[mine])
                if sums.held > BUFFER:
                    yield from sums.drained()
            release()
        yield from sums.drained()

    return run


def _count(longest: int, united):
    """Counts by the words themselves: lang, k, phrase, n; k 0 has the number of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sums = united.value, _Phrases()
        for batch in batches:
            langs = batch.column(0).to_pylist()
            place = {x: i for i, x in enumerate(dict.fromkeys(langs))}
            names = pa.array(list(place), pa.string())
            group = np.array([place[x] for x in langs], dtype=np.int64)
            seeds = np.array([xxhash.xxh3_64_intdigest(x) for x in place], dtype=np.uint64)
            salts = np.full(len(place), _ALL)
            for w in scanned(batch.column(2), LETTERS, BREAKS, CHUNK):
                sums.add(names, 0, pa.array([b""] * len(place), pa.large_binary()), np.bincount(group[w.rows], minlength=len(place)))
                for k, first, groups, hashes, n in _grams(w, group[w.rows], seeds, salts, longest, [known] * (longest - 1)):
                    own = np.flatnonzero(known.holds(hashes ^ _ALL))
                    words = [w.distinct.take(pa.array(w.codes[first[own] + j])) for j in range(k)]
                    phrase = pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.large_binary())) if k > 1 else words[0]
                    sums.add(names.take(pa.array(groups[own])), k, phrase, n[own])
                yield from sums.drained(PHRASES, PHRASE_BYTES)
            release()
        yield from sums.drained()

    return run


def _bitmap_of(spark: SparkSession, mined: DataFrame, n: int, by_shard: bool):
    """A broadcast bitmap of phrase hashes."""
    salts = F.array(*(F.lit(int(x)) for x in _SHARD[:SHARDS_MOST].view(np.int64)))
    salt = F.get(salts, F.col("shard")) if by_shard else F.lit(int(_ALL.view(np.int64)))
    return spark.sparkContext.broadcast(bitmap(mined.select(F.col("gram").bitwiseXOR(salt).alias("key")), n))


def frequent(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, shards: int = SHARDS) -> DataFrame:
    """lang, k, phrase, n of every phrase of k words with n >= ``support``; k 0 gives all words of a language.

    ``shards``: more of them lower the local support, which is at least 1.
    """
    if not 1 <= shards <= SHARDS_MOST:
        raise ValueError(f"1 to {SHARDS_MOST} shards")
    spark = docs.sparkSession
    local = math.ceil(support / shards)
    dealt = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(shards)).cast("int").alias("shard"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    levels, known = [], []
    for level in range(1, longest + 1):
        counts = dealt.mapInArrow(_mine(level, known), "shard int, gram long, n long")
        mined = saved(counts.repartition("shard", "gram").groupBy("shard", "gram").agg(F.sum("n").alias("n")).where(F.col("n") >= local).select("shard", "gram"), f"locally-frequent-{level}")
        levels.append((mined, mined.count()))
        if level < longest:
            known.append(_bitmap_of(spark, *levels[-1], True))
    union = levels[0][0]
    for mined, _ in levels[1:]:
        union = union.union(mined)
    united = _bitmap_of(spark, union, sum(n for _, n in levels), False)
    counted = dealt.mapInArrow(_count(longest, united), "lang string, k int, phrase string, n long").groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n"))
    found = saved(counted.where((F.col("k") == 0) | (F.col("n") >= support)), "phrases")
    for b in (*known, united):
        b.destroy()
    return found


def collocations(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, top: int = TOP, shards: int = SHARDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best phrases of 2 to ``longest`` words."""
    counts = frequent(docs, support, longest, shards)
    words = counts.where("k = 0").select("lang", F.col("n").alias("words"))
    parts = counts.where("k > 0").select("lang", "phrase", "n")
    candidates = counts.where("k > 1").select("lang", "phrase", "k", F.col("n").alias("a"))

    cuts = candidates.withColumn("cut", F.explode(F.expr("sequence(1, k - 1)"))).withColumn("head", F.expr("substring_index(phrase, ' ', cut)")).withColumn("tail", F.expr("substring_index(phrase, ' ', cut - k)"))
    cuts = cuts.join(parts.selectExpr("lang", "phrase AS head", "n AS l"), ["lang", "head"]).join(parts.selectExpr("lang", "phrase AS tail", "n AS r"), ["lang", "tail"])
    # Exact: the products have 38 digits, for counts below 10^16.
    square = "CAST(1000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(16,0)) * CAST(a AS DECIMAL(16,0))"
    score = f"({square}) div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))"
    lowest = cuts.withColumn("score", F.expr(score)).groupBy("lang", "phrase", "k", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("low"))

    inner = "flatten(transform(sequence(2, k - 1), m -> transform(sequence(1, k - m + 1), i -> array_join(slice(split(phrase, ' '), i, m), ' '))))"
    around = candidates.where("k > 2").select("lang", "a", F.explode(F.expr(inner)).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    kept = lowest.join(around, ["lang", "phrase"], "left").where("around IS NULL OR 100 * around < 50 * a").select("lang", "phrase", "a", "low.l", "low.r", "low.score")

    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    salted = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALT)))
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top).drop("rank", "salt")
    best = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return best.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("words").alias("n"), "score")
