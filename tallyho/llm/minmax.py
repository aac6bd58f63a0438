"""Near-duplicate groups by min-max hashing.

Every document is a set of distinct word shingles.  One pass hashes the set
under ``PERMUTATIONS`` permutations and keeps both the least and the greatest
value of each, so 80 hash evaluations give a signature of 160 unbiased
values.  Five values make a band: a pair at similarity 0.8 shares none of the
32 bands with probability 3e-6.

1. Equal sets are collapsed to their smallest id by a digest of the set.
2. A bucket is the documents that share a band.  Each member is compared with
   one member only, the bucket's hub (another hub for each band), on its full
   shingle set; the links found give first components.  This is linear in the
   bucket's size and settles a group of copies however large it is.
3. Only buckets whose members still lie in several components go on: members
   outside the bucket's largest component are compared, in blocks of at most
   ``BLOCK`` rows a side, with the members of other components.  The signature
   estimate drops hopeless pairs (more than four standard errors below the
   threshold), the full sets confirm the rest, and a block returns no more
   than a spanning forest of the links it confirms.

No pair of a bucket is left out (one that met in an earlier band, by the whole
64-bit bucket key, was compared there), so the components are those of all links
that share a band.  Defined cases: NULL or blank text has an empty set and
is linked with nothing; rows that share an id are one document of several
texts, whatever their order; extra columns are ignored; an empty table gives
an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyho.llm import hashing as H
from tallyho.llm.components import components, row_keyed, saved

PERMUTATIONS = 80
BAND = 5
BANDS = 2 * PERMUTATIONS // BAND
BLOCK = 1024
_STEP = 1024  # shingles hashed at a time, so a long document needs no more memory

_A, _B = H.stream(11, PERMUTATIONS) | np.uint64(1), H.stream(12, PERMUTATIONS)
_BAND_PLACE, _BAND_SEED = H.stream(13, BAND) | np.uint64(1), H.stream(14, BANDS)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least values of every permutation, then the greatest."""
    low = high = None
    for at in range(0, len(shingles), _STEP):
        values = shingles[at : at + _STEP, None] * _A + _B
        least, most = values.min(axis=0), values.max(axis=0)
        low = least if low is None else np.minimum(low, least)
        high = most if high is None else np.maximum(high, most)
    return np.concatenate((low, high))


def bands(values: np.ndarray) -> np.ndarray:
    """One bucket key for each band."""
    return H.mix((values.reshape(BANDS, BAND) * _BAND_PLACE).sum(axis=1, dtype=np.uint64) + _BAND_SEED).view(np.int64)


def _sketches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, signs, keys = [], [], [], []
            for one in H.shingle_sets(batch.column(1), width):
                sizes.append(len(one))
                digests.append(H.digest(one) if len(one) else None)
                values = signature(one) if len(one) else None
                signs.append(None if values is None else (values >> np.uint64(40)).astype(np.uint16).tobytes())
                keys.append(None if values is None else bands(values))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(signs, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "digest", "sign", "bands"],
            )

    return run


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, digest of the set, signature (16 bits a value), band keys."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_sketches(width), "doc_id long, n_shingles long, digest binary, sign binary, bands array<long>")


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [one.tobytes() for one in H.shingle_sets(batch.column(1), width)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary()), batch.column(2), batch.column(3)], names=["id", "shingles", "sign", "bands"])

    return run


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    few, many = sorted((len(a), len(b)))
    if 100 * few < percent * many:
        return False
    both = _shared(a, b)
    return 100 * both >= percent * (few + many - both)


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [_linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def _block_links(percent: int, least_estimate: float):
    """Compares the left rows of one block with its right rows; gives a forest of their links."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, int]] = []
        if left.num_rows and right.num_rows:
            band = left.column("band")[0].as_py()
            lid, rid = (t.column("id").to_numpy() for t in (left, right))
            lroot, rroot = (t.column("root").to_numpy() for t in (left, right))
            rleft = right.column("is_left").to_numpy(zero_copy_only=False)
            ls, rs = (np.frombuffer(b"".join(t.column("sign").to_pylist()), np.uint16).reshape(t.num_rows, -1) for t in (left, right))
            lmet, rmet = (t.column("bands").combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)[:, :band] for t in (left, right))
            lset, rset = ([np.frombuffer(x, np.uint64) for x in t.column("shingles").to_pylist()] for t in (left, right))
            parent = {int(x): int(x) for x in (*lroot, *rroot)}

            def top(x: int) -> int:
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            for i in range(len(lid)):
                first = (rmet == lmet[i]).any(axis=1)  # met in the bucket of an earlier band
                fit = ((rs == ls[i]).mean(axis=1) >= least_estimate) & ~first & (rroot != lroot[i]) & (~rleft | (rid > lid[i]))
                for j in np.flatnonzero(fit).tolist():
                    x, y = top(int(lroot[i])), top(int(rroot[j]))
                    if x != y and _linked(lset[i], rset[j], percent):
                        parent[max(x, y)] = min(x, y)
                        out.append((int(lid[i]), int(rid[j])))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return run


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every distinct doc_id of ``docs`` (doc_id, text).

    Two documents are linked when 100 * intersection >= percent * union of
    their ``width``-word shingle sets.  NULL ids are left out.  Rows that share
    an id are one document of several texts: each text counts for its links,
    and n_shingles is that of the largest.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id IS NOT NULL")
    if docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        return _groups(docs, width, percent)
    rows = row_keyed(docs)
    groups = saved(_groups(rows.select(F.col("__row_key").alias("doc_id"), "text"), width, percent).select(F.col("doc_id").alias("__row_key"), "n_shingles", "component_id"), "row-groups")
    owned = saved(rows.select("doc_id", "__row_key").join(groups, "__row_key"), "owned-groups")
    # The groups that meet in a document are one.
    firsts = owned.groupBy("doc_id").agg(F.min("component_id").alias("a"))
    joined = components(owned.join(firsts, "doc_id").select("a", F.col("component_id").alias("b")).distinct())
    placed = owned.join(joined, owned.component_id == joined.id, "left").select("doc_id", "n_shingles", F.coalesce("root", "component_id").alias("group"))
    least = placed.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    whole = placed.groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"), F.min("group").alias("group"))
    return whole.join(least, "group").select("doc_id", "n_shingles", "component_id", F.expr("doc_id = component_id").alias("kept"))


def _groups(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``near_duplicates`` of documents with an id each."""
    drawn = saved(sketches(docs, width), "sketches")
    whole = drawn.where("digest IS NOT NULL")
    classes = whole.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    reps = whole.join(classes, "digest").where("doc_id = rep")

    entries = reps.select("doc_id", F.posexplode("bands").alias("band", "bucket"))
    # Another member is the hub in each band: the least of a hash that depends on the band.
    buckets = entries.groupBy("band", "bucket").agg(F.min(F.struct(F.xxhash64("band", "doc_id").alias("h"), "doc_id")).alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    crowded = saved(entries.join(buckets, ["band", "bucket"]).select("band", "bucket", F.col("doc_id").alias("id"), F.col("least.doc_id").alias("hub")), "buckets")

    members = crowded.select("id").distinct()
    texts = docs.join(members, docs.doc_id == members.id, "left_semi").select("doc_id", "text")
    signs = reps.select("doc_id", "sign", "bands")
    sets = saved(texts.join(signs, "doc_id").select("doc_id", "text", "sign", "bands").mapInArrow(_sets(width), "id long, shingles binary, sign binary, bands array<long>"), "sets")

    pairs = crowded.where("id <> hub").select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()
    x, y = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    stars = saved(pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_verify(percent), "a long, b long"), "star-links")

    near = components(stars)
    placed = crowded.join(near, "id", "left").select("band", "bucket", "id", F.coalesce("root", "id").alias("root"))
    per_root = placed.groupBy("band", "bucket", "root").agg(F.count(F.lit(1)).alias("k"))
    open_ = per_root.groupBy("band", "bucket").agg(F.max(F.struct("k", "root")).alias("most"), F.sum("k").alias("n")).where("n > most.k").selectExpr("band", "bucket", "most.root AS main", "n", "n - most.k AS n_left")
    rest = placed.join(open_, ["band", "bucket"]).withColumn("is_left", F.expr("root <> main"))
    rest = rest.selectExpr("*", f"CAST(ceil(n_left / {BLOCK}) AS INT) AS lefts", f"CAST(ceil(n / {BLOCK}) AS INT) AS rights")
    rest = saved(rest.join(sets, "id"), "open-buckets")
    key = ["band", "bucket", "lb", "rb"]
    cols = [F.col(c).alias(c) for c in ("band", "bucket", "lb", "rb", "id", "root", "is_left", "shingles", "sign", "bands")]
    left = rest.where("is_left").withColumn("lb", F.expr("pmod(xxhash64(id), lefts)")).withColumn("rb", F.explode(F.expr("sequence(0L, rights - 1L)"))).select(*cols)
    right = rest.withColumn("rb", F.expr("pmod(xxhash64(id, 1), rights)")).withColumn("lb", F.explode(F.expr("sequence(0L, lefts - 1L)"))).select(*cols)
    threshold = percent / 100
    margin = 4.2 * (threshold * (1 - threshold) / (2 * PERMUTATIONS)) ** 0.5
    more = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_block_links(percent, threshold - margin), "a long, b long")

    linked = components(stars.union(more))
    groups = classes.join(linked, classes.rep == linked.id, "left").select("digest", F.coalesce("root", "rep").alias("component_id"))
    found = drawn.join(groups, "digest", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return found.withColumn("kept", F.expr("doc_id = component_id"))
