"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features is shared by all grades; ordered
thresholds t1 < t2 < ... turn the score of a text into

    P(grade >= k) = sigmoid(score - t_k)

Features of a text, as shares of its tokens: the folded token, the token's
shape (letters and digits by class, runs cut to one, other characters as they
are), and whether the token repeats the one before.  A token of more than
``LONG`` characters (a text in a script without spaces, an encoded line) is
read whole, as consecutive pieces of ``LONG`` that count as a token each.
Features are hashed into ``1 << BITS`` weights, so the model has a fixed size.

Fitting takes a bounded sample: at most ``SAMPLE`` rated documents, the least
by a hash of doc_id.  Scoring covers every whole text, in slices.

Defined cases: a NULL or blank text has the score 0 (no features); documents
without a rating are scored, not learnt from; a NULL grade is no rating;
repeated rows are scored each; extra columns are ignored; with no rating, or
one grade only, every document gets that grade (0 if there is none).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyho.llm.columns import hold, row_sums, token_slices

BITS = 18
SAMPLE = 6000
STEPS = 300
DECAY = 1e-5
SCALE = 4.0  # of the shares of tokens
_LETTERS = re.compile(r"[^\W\d_]+")
_RUN = re.compile(r"(.)\1+", re.DOTALL)
LONG = 64
CACHE = 100_000


def features(token: str) -> tuple[int, int]:
    """The hashed features of a token: its folded letters and its shape."""
    shape = _LETTERS.sub(lambda m: "X" if m[0].isupper() and len(m[0]) > 1 else "Xx" if m[0][0].isupper() else "x", token)
    shape = _RUN.sub(r"\1", re.sub(r"\d", "9", shape))
    letters = "".join(_LETTERS.findall(token)).lower()
    mask = (1 << BITS) - 1
    return zlib.crc32(b"w" + letters.encode()) & mask, zlib.crc32(b"s" + shape.encode()) & mask


_REPEAT = zlib.crc32(b"repeat") & ((1 << BITS) - 1)
_known: dict[str, tuple[int, int]] = {}


def _pieces(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, list[str]]]:
    """(row offsets, code of each piece, distinct pieces) of slices of rows: a token is one piece, a long one several."""
    for _, bounds, codes, tokens in token_slices(column):
        if max(map(len, tokens), default=0) > LONG:
            place: dict[str, int] = {}
            flat = [[place.setdefault(t[i : i + LONG], len(place)) for i in range(0, len(t), LONG)] for t in tokens]
            sizes = np.array([len(f) for f in flat], dtype=np.int64)
            starts = np.cumsum(sizes) - sizes
            own = sizes[codes]
            ends = np.cumsum(own)
            codes = np.concatenate([np.array(f, dtype=np.int64) for f in flat])[np.repeat(starts[codes] - ends + own, own) + np.arange(int(ends[-1]))]
            bounds, tokens = np.concatenate(([0], ends))[bounds], list(place)
        yield bounds, codes, tokens


def _token_features(tokens: list[str]) -> np.ndarray:
    hold("features", _known.clear)
    if len(_known) + len(tokens) > CACHE:
        _known.clear()
    for t in tokens:
        if t not in _known:
            _known[t] = features(t)
    return np.array([_known[t] for t in tokens], dtype=np.int64).reshape(len(tokens), 2)


def _repeats(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    same = np.zeros(len(codes), dtype=bool)
    same[1:] = codes[1:] == codes[:-1]
    starts = bounds[:-1]
    same[starts[starts < len(codes)]] = False
    return same


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse feature shares of (text, grade) rows."""
    for batch in batches:
        at, share, grades = [], [], batch.column(1)
        for bounds, codes, tokens in _pieces(batch.column(0)):
            table, same = _token_features(tokens), _repeats(codes, bounds)
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                own = np.concatenate((table[codes[a:b]].ravel(), np.full(int(same[a:b].sum()), _REPEAT)))
                ids, n = np.unique(own, return_counts=True)
                at.append(ids.astype(np.int32))
                share.append((n * (SCALE / max(1, b - a))).astype(np.float32))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.list_(pa.int32())), pa.array(share, pa.list_(pa.float32())), grades], names=["at", "share", "grade"])


@dataclass(frozen=True)
class Model:
    """``thresholds``: one for each grade above the lowest."""

    weights: np.ndarray
    thresholds: np.ndarray
    lowest: int = 0

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for each text and each grade above the lowest."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -30, 30)))


def fit(sample: list[tuple[np.ndarray, np.ndarray, int]], grades: int) -> Model:
    """Gradient descent (Adam) on the mean negative log likelihood of grades 0 to ``grades`` - 1."""
    y = np.array([g for _, _, g in sample], dtype=np.int64)
    if grades < 2 or len(set(y.tolist())) < 2:
        only = int(y[0]) if len(y) else 0
        return Model(np.zeros(1 << BITS), np.where(np.arange(1, max(grades, 1)) <= only, -30.0, 30.0))
    sizes = np.array([len(a) for a, _, _ in sample])
    at, share = np.concatenate([a for a, _, _ in sample]), np.concatenate([s for _, s, _ in sample]).astype(np.float64)
    used, at = np.unique(at, return_inverse=True)
    rows = np.repeat(np.arange(len(sample)), sizes)
    above = np.array([(y >= k).mean() for k in range(1, grades)]).clip(1e-3, 1 - 1e-3)
    start = -np.log(above / (1 - above))  # falls in with the shares of the grades
    p = np.concatenate((np.zeros(len(used)), [start[0]], np.log(np.maximum(np.diff(start), 1e-2))))
    m, v, w = np.zeros_like(p), np.zeros_like(p), len(used)
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -30, 30)))
    for step in range(1, STEPS + 1):
        t = p[w] + np.concatenate(([0], np.cumsum(np.exp(p[w + 1 :]))))
        score = np.bincount(rows, share * p[at], len(sample))
        # P(y) = F(score - t_y) - F(score - t_{y+1}), with t_0 = -inf and t_grades = inf.
        low = np.where(y > 0, sigmoid(score - t[np.maximum(y - 1, 0)]), 1.0)
        high = np.where(y < grades - 1, sigmoid(score - t[np.minimum(y, grades - 2)]), 0.0)
        slope_low, slope_high = low * (1 - low), high * (1 - high)
        likelihood = np.maximum(low - high, 1e-9)
        d_score = -(slope_low - slope_high) / likelihood / len(y)
        d_t = np.zeros(grades - 1)
        np.add.at(d_t, np.maximum(y - 1, 0), np.where(y > 0, slope_low / likelihood, 0) / len(y))
        np.add.at(d_t, np.minimum(y, grades - 2), np.where(y < grades - 1, -slope_high / likelihood, 0) / len(y))
        # A later threshold moves with every earlier gap.
        tail = np.cumsum(d_t[::-1])[::-1]
        g = np.concatenate((np.bincount(at, share * d_score[rows], len(used)) + DECAY * p[:w], [tail[0]], tail[1:] * np.exp(p[w + 1 :])))
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        p = p - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    weights = np.zeros(1 << BITS)
    weights[used] = p[:w]
    return Model(weights, p[w] + np.concatenate(([0], np.cumsum(np.exp(p[w + 1 :])))))


def train(docs: DataFrame, ratings: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from ``ratings`` (doc_id, grade from 0 up) of ``docs`` (doc_id, text): at most ``sample`` rated documents."""
    rated = ratings.select(F.col("doc_id").cast("long"), F.col("grade").cast("int")).dropna().groupBy("doc_id").agg(F.max("grade").alias("grade"))
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    chosen = rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    top = rated.agg(F.max("grade")).first()[0]
    # At most ``sample`` ids are broadcast, and as many sparse rows come back.
    rows = texts.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).select("text", "grade").mapInArrow(_vectors, "at array<int>, share array<float>, grade int").toArrow()
    got = [(a.values.to_numpy(), s.values.to_numpy(), g.as_py()) for a, s, g in zip(*(rows.column(c) for c in ("at", "share", "grade")), strict=True)]
    got.sort(key=lambda r: (r[2], r[0].tobytes(), r[1].tobytes()))  # sums in one order, whatever order the rows came in
    return fit(got, (top or 0) + 1)


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for batch in batches:
            scores = [np.zeros(0)]
            for bounds, codes, tokens in _pieces(batch.column(1)):
                worth = model.weights[_token_features(tokens)].sum(axis=1)
                value = worth[codes] + model.weights[_REPEAT] * _repeats(codes, bounds)
                scores.append(row_sums(value, bounds) * SCALE / np.maximum(1, np.diff(bounds)))
            score = np.concatenate(scores)
            tails = model.tails(score)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array(tails.sum(axis=1)), pa.array(list(tails), pa.list_(pa.float64()))], names=["doc_id", "score", "expected_grade", "tail"])

    return run


def graded(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, expected_grade and tail (P(grade >= k) for k = 1, 2, ...) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_score(shared), "doc_id long, score double, expected_grade double, tail array<double>")


def _select(shared, at: int, grade: int, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _score(shared)
        for batch in batches:
            text = batch.column(at)
            ids = pa.nulls(len(text), pa.int64())
            (scored,) = score(iter([pa.RecordBatch.from_arrays([ids, text], names=["doc_id", "text"])]))
            tail = scored.column("tail")
            ok = pa.array([len(t) < grade or t[grade - 1] >= least for t in tail.to_pylist()], pa.bool_())
            yield batch.filter(ok)

    return run


def selected(docs: DataFrame, model: Model, grade: int = 1, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose chance of ``grade`` or better is at least ``least``; all columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_select(shared, docs.columns.index("text"), grade, least), docs.schema)
