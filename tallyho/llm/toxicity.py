"""Toxicity: a subsequence string-kernel support vector machine with Nystrom landmarks.

Kernel.  Two words are compared by their common subsequences of ``P`` letters,
gaps allowed: each occurrence weighs ``DECAY`` to the power of the letters it
spans, and the kernel is normalized, so ``id1iot`` or ``stu-p-id`` stay close
to the plain insult.  Letters are folded; a single 0, 1, 3, 4, 5, 7, @ or $
between two letters is read as the letter it looks like, other characters
inside a token are dropped, and runs of single-letter tokens are read as one word too.  Two
sentences are compared by the sum of the kernels of their words, which is
linear in the words: a sentence's score is the sum of its words' scores.

Landmarks.  ``LANDMARKS`` words with the most significant log odds of toxic
against other training documents.  The Nystrom map is K^(-1/2) of the
landmarks' kernel matrix; a value counts only where a word holds at least
``SHARED`` of the landmark's letters as a subsequence (bit-parallel test).

Training.  Labels are per document, so a toxic document's witness is its
highest sentence under the model so far, and a clean document's is the same;
hinge loss over witnesses, a few rounds; then a logistic curve turns a
document's highest sentence into a score between 0 and 1.  The sample is
bounded: at most ``SAMPLE`` documents of each label, by a hash of doc_id.

Scoring covers every sentence of every whole text, in slices; each distinct
word is scored once a worker while it is among the ``CACHE`` kept.

Defined cases: NULL or blank texts get the score of an empty sentence;
unlabelled and held-out documents are scored only; a NULL label is none;
repeated rows are scored each; extra columns are ignored; with labels of one
kind only, or none, every score is the smoothed share of toxic labels.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyho.llm.columns import coded_slices

P, DECAY = 3, 0.6
SHARED = 0.7
LANDMARKS = 64
SAMPLE = 2500
WIDTH = 24  # letters of a word looked at together; a longer one is read in overlapping windows
ROUNDS = 3
CACHE = 400_000
_NOT_LETTER = re.compile(r"[\W\d_]+")
_SENTENCE_END = re.compile(r"[.!?|;:]+$")


_LOOKS = str.maketrans("013457@$", "oieastas")
_LOOK_ALIKE = re.compile(r"(?<=[^\W\d_])[013457@$](?=[^\W\d_])")


def fold(token: str) -> str:
    """The lower-cased letters; a single sign that looks like a letter, between two letters, is read as it."""
    if not token.isalpha():
        token = _NOT_LETTER.sub("", _LOOK_ALIKE.sub(lambda m: m[0].translate(_LOOKS), token))
    return token.lower()


def windows(word: str) -> list[str]:
    if len(word) <= WIDTH:
        return [word]
    return [word[i : i + WIDTH] for i in range(0, len(word) - WIDTH // 2, WIDTH // 2)]


def _matrix(words: list[str]) -> np.ndarray:
    """Code points, 0 beyond a word's end; at most WIDTH columns."""
    width = max(1, max(map(len, words), default=1))
    return np.array(words, dtype=f"<U{width}").view(np.int32).reshape(len(words), width)


class Letters:
    """The letters of some landmarks: words as small codes (0: none of them), letter sets as bits."""

    def __init__(self, landmarks: list[str]):
        self.letters = np.array(sorted({ord(c) for w in landmarks for c in w}), dtype=np.int32)
        if len(self.letters) > 62:  # beyond one word of bits, letters share them
            self.bit = np.arange(len(self.letters) + 1) % 62
        else:
            self.bit = np.arange(len(self.letters) + 1)

    def codes(self, words: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.letters, words), len(self.letters) - 1)
        return np.where(self.letters[at] == words, at + 1, 0).astype(np.uint8 if len(self.letters) < 255 else np.int32)

    def bits(self, codes: np.ndarray) -> np.ndarray:
        one = np.where(np.arange(len(self.letters) + 1) > 0, np.uint64(1) << self.bit.astype(np.uint64), np.uint64(0))
        return np.bitwise_or.reduce(one[codes], axis=1)


def least_shared(landmark: str) -> int:
    return max(P, int(np.ceil(SHARED * len(landmark))))


def common_length(codes: np.ndarray, landmark: np.ndarray, n_codes: int) -> np.ndarray:
    """Length of the longest common subsequence of each word with a landmark, both as codes (bit-parallel, a column at a time)."""
    size = len(landmark)
    full = np.uint64((1 << size) - 1)
    masks = np.zeros(n_codes + 1, dtype=np.uint64)
    for i, c in enumerate(landmark.tolist()):
        masks[c] |= np.uint64(1 << i)
    v = np.full(len(codes), full, dtype=np.uint64)
    for j in range(codes.shape[1]):
        u = v & masks[codes[:, j]]
        v = ((v + u) | (v - u)) & full
    return size - np.bitwise_count(v).astype(np.int64)


def kernel_pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Gap-weighted subsequence kernel of length P of row i of ``a`` and row i of ``b`` (not normalized)."""
    n, la = a.shape
    lb = b.shape[1]
    # The words lie along the last axis, so every step runs over memory in order.
    a, b = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    same = ((a[:, None] == b[None]) & (a[:, None] != 0)) * (DECAY * DECAY)
    prev = np.ones((la + 1, lb + 1, n))
    for _ in range(1, P):
        now = np.zeros((la + 1, lb + 1, n))
        for i in range(1, la + 1):
            run = np.zeros(n)
            for j in range(1, lb + 1):
                run = DECAY * run + same[i - 1, j - 1] * prev[i - 1, j - 1]
                now[i, j] = DECAY * now[i - 1, j] + run
        prev = now
    return (same * prev[:la, :lb]).sum(axis=(0, 1))


def _self(words: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(kernel_pairs(words, words), 1e-30))


@dataclass
class Landmarks:
    words: list[str]

    def __post_init__(self) -> None:
        self.matrix = _matrix(self.words)
        self.norms = _self(self.matrix) if self.words else np.zeros(0)
        self.letters = Letters(self.words)
        self.coded = [self.letters.codes(_matrix([w]))[0] for w in self.words]
        self.sets = [self.letters.bits(c[None, :])[0] for c in self.coded]

    def near(self, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word, landmark) pairs with enough letters in common, in order."""
        codes = self.letters.codes(matrix)
        sets = self.letters.bits(codes)
        longest = np.where(matrix > 0, np.arange(1, matrix.shape[1] + 1), 0).max(axis=1)
        rows, cols = [], []
        for j, (word, own) in enumerate(zip(self.words, self.sets, strict=True)):
            least = least_shared(word)
            # A common subsequence that long lacks few of the landmark's distinct letters.
            distinct = int(np.bitwise_count(own)) - (len(word) - least)
            some = np.flatnonzero((np.bitwise_count(sets & own) >= distinct) & (longest >= least))
            if len(some):
                hit = some[common_length(codes[some, : longest[some].max()], self.coded[j], len(self.letters.letters)) >= least]
                rows.append(hit)
                cols.append(np.full(len(hit), j))
        none = np.zeros(0, dtype=np.int64)
        return np.concatenate((none, *rows)), np.concatenate((none, *cols))

    def kernel(self, words: list[str]) -> np.ndarray:
        """Normalized kernel of each word with each landmark: the best of a long word's windows."""
        out = np.zeros((len(words), len(self.words)))
        owner, parts = [], []
        for i, w in enumerate(words):
            for x in windows(w) if len(w) >= P else ():
                owner.append(i)
                parts.append(x)
        for at in range(0, len(parts), 50_000):
            own = np.array(owner[at : at + 50_000])
            m = _matrix(parts[at : at + 50_000])
            r, c = self.near(m)
            if not len(r):
                continue
            some, place = np.unique(r, return_inverse=True)
            norm = np.concatenate([_self(m[some[k : k + 4096]]) for k in range(0, len(some), 4096)])
            value = np.concatenate([kernel_pairs(m[r[k : k + 4096]], self.matrix[c[k : k + 4096]]) for k in range(0, len(r), 4096)])
            np.maximum.at(out, (own[r], c), value / (norm[place] * self.norms[c]))
        return out


@dataclass
class Model:
    """``dual`` maps kernel values with the landmarks to a word's score; ``curve`` is (slope, intercept)."""

    landmarks: Landmarks
    dual: np.ndarray
    curve: tuple[float, float]

    def words(self, words: list[str]) -> np.ndarray:
        return self.landmarks.kernel(words) @ self.dual if self.landmarks.words else np.zeros(len(words))

    def probability(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.curve[0] * margins + self.curve[1], -30, 30)))


def _sentences(bounds: np.ndarray, codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The first token of each sentence: after a sentence end, and at each row's start."""
    first = np.zeros(len(codes) + 1, dtype=bool)
    first[1:] = ends[codes]
    first[bounds[:-1]] = True
    return np.flatnonzero(first[: len(codes)])


def _spelled(bounds: np.ndarray, codes: np.ndarray, folded: pa.Array, single: np.ndarray) -> list[tuple[int, str]]:
    """(token, word) of runs of three or more single-letter tokens, which may spell a word."""
    one = single[codes]
    run = one[1:-1] & one[2:] & one[:-2] if len(one) > 2 else np.zeros(0, dtype=bool)
    out, at = [], -1
    row_end = bounds[np.searchsorted(bounds, np.flatnonzero(run), side="right")] if run.any() else []
    for i, stop in zip(np.flatnonzero(run).tolist(), np.asarray(row_end).tolist(), strict=True):
        if i < at or i + 3 > stop:
            continue
        at = i
        while at < stop and one[at]:
            at += 1
        out.append((i, "".join(folded.take(pa.array(codes[i:at])).to_pylist())))
    return out


def folded_tokens(tokens: pa.Array) -> pa.Array:
    """``fold`` of many tokens: in Arrow but for those with a sign that may look like a letter."""
    odd = pc.and_(pc.match_substring_regex(tokens, r"[013457@$]"), pc.match_substring_regex(tokens, r"\pL"))
    out = pc.utf8_lower(pc.replace_substring_regex(tokens, r"[^\pL\p{Nl}\p{No}]+", ""))
    some = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
    if len(some):
        out = pc.replace_with_mask(out, odd, pa.array([fold(t) for t in tokens.take(pa.array(some)).to_pylist()], out.type))
    return out


def _tokens(tokens: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Of each token: the folded word, whether it ends a sentence, whether it is a single letter."""
    folded = folded_tokens(tokens)
    return folded, pc.match_substring_regex(tokens, r"[.!?|;:]$").to_numpy(zero_copy_only=False), pc.equal(pc.utf8_length(folded), 1).to_numpy(zero_copy_only=False)


def _distinct(folded: pa.Array) -> tuple[list[str], np.ndarray]:
    coded = folded.dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy()


def _sentence_kernels(shared):
    """Of each sentence that has any: the summed kernel values of its words with the landmarks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        landmarks: Landmarks = shared.value
        for batch in batches:
            ids, out_id, out = batch.column(0).to_pylist(), [], []
            for row, bounds, codes, tokens in coded_slices(batch.column(1), 1 << 20):
                folded, ends, single = _tokens(tokens)
                words, place = _distinct(folded)
                value = landmarks.kernel(words)[place[codes]]
                spelled = _spelled(bounds, codes, folded, single)
                if spelled:
                    value[[at for at, _ in spelled]] += landmarks.kernel([word for _, word in spelled])
                starts = _sentences(bounds, codes, ends)
                if not len(starts):
                    continue
                sums = np.add.reduceat(value, starts, axis=0)
                owner = np.searchsorted(bounds, starts, side="right") - 1
                for i in np.flatnonzero(sums.any(axis=1)).tolist():
                    out_id.append(ids[row + owner[i]])
                    out.append(sums[i].astype(np.float32))
            yield pa.RecordBatch.from_arrays([pa.array(out_id, pa.int64()), pa.array(out, pa.list_(pa.float32()))], names=["doc_id", "kernels"])

    return run


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, labels = [], []
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = set(folded_tokens(pa.array(sorted(set((text or "").split())), pa.string())).to_pylist())
            own = sorted(w for w in own if P <= len(w) <= WIDTH)
            words += own
            labels += [label] * len(own)
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(labels, pa.int32())], names=["word", "toxic"])


def hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, start: np.ndarray, steps: int = 2000) -> np.ndarray:
    """Weights (the last one is the bias) of a linear SVM with squared hinge loss, by accelerated gradient steps."""
    x = np.hstack((x, np.ones((len(x), 1))))
    sign = np.where(y > 0, 1.0, -1.0)
    w = v = start
    ridge = 1e-4
    rate = 1 / (2 * np.linalg.norm(x * np.sqrt(weight)[:, None], 2) ** 2 + ridge)
    for k in range(steps):
        slack = np.maximum(0, 1 - sign * (x @ v))
        g = -2 * x.T @ (weight * sign * slack)
        g[:-1] += ridge * v[:-1]
        new = v - rate * g
        v = new + k / (k + 3) * (new - w)
        w = new
    return w


def _curve(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic fit with Platt's smoothed targets (Newton steps)."""
    n1, n0 = (y > 0).sum(), (y == 0).sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack((margins, np.ones_like(margins)), axis=1)
    w = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = x.T @ (x * np.maximum(p * (1 - p), 1e-6)[:, None]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (target - p) - 1e-6 * w)
        w = w + np.clip(step, -2, 2)
    return float(w[0]), float(w[1])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, n_landmarks: int = LANDMARKS) -> Model:
    """A model from ``labels`` (doc_id, toxic 0 or 1) of ``docs`` (doc_id, text): at most ``sample`` documents of each label."""
    spark = docs.sparkSession
    known = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).dropna().groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    pick = lambda y: known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    chosen = pick(1).union(pick(0))  # at most 2 * sample ids are broadcast
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = texts.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).persist()
    try:
        sizes = dict(rows.groupBy("toxic").count().collect())
        n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
        if not n1 or not n0:
            share = (n1 + 1) / (n1 + n0 + 2)
            return Model(Landmarks([]), np.zeros(0), (0.0, float(np.log(share / (1 - share)))))
        words = rows.select("text", "toxic").mapInArrow(_distinct_words, "word string, toxic int").groupBy("word").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
        odds = F.log((F.col("a") + 0.5) / (n1 - F.col("a") + 0.5)) - F.log((F.col("b") + 0.5) / (n0 - F.col("b") + 0.5))
        error = F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
        best = words.where("a >= 3").withColumn("z", odds / error).where("z > 3").orderBy(F.desc("z"), "word").limit(n_landmarks).collect()
        landmarks = Landmarks([r["word"] for r in best])
        if not landmarks.words:
            share = (n1 + 1) / (n1 + n0 + 2)
            return Model(landmarks, np.zeros(0), (0.0, float(np.log(share / (1 - share)))))
        shared = spark.sparkContext.broadcast(landmarks)
        table = rows.select("doc_id", "text").mapInArrow(_sentence_kernels(shared), "doc_id long, kernels array<float>").toArrow()
        marks = dict(rows.select("doc_id", "toxic").collect())
    finally:
        rows.unpersist()
    docs_ = np.array(sorted(marks))
    y = np.array([marks[d] for d in docs_.tolist()])
    owner = np.searchsorted(docs_, table.column("doc_id").to_numpy())
    kernels = np.array(table.column("kernels").combine_chunks().flatten(), dtype=np.float64).reshape(-1, len(landmarks.words)) if table.num_rows else np.zeros((0, len(landmarks.words)))
    order = np.lexsort((*kernels.T[:3], owner))
    owner, kernels = owner[order], kernels[order]
    gram = landmarks.kernel(landmarks.words)
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
    x = kernels @ root
    w = np.append(root @ np.ones(len(landmarks.words)) / len(landmarks.words), 0.0)
    weight = np.where(y > 0, 0.5 / n1, 0.5 / n0)
    for _ in range(ROUNDS):
        top, margin = _tops(owner, x @ w[:-1], len(docs_))
        witness = np.where(top[:, None] >= 0, x[np.maximum(top, 0)] if len(x) else 0.0, 0.0)
        w = hinge(witness, y, weight, w)
    _, margin = _tops(owner, x @ w[:-1], len(docs_))
    return Model(landmarks, root @ w[:-1], _curve(margin, y))


def _tops(owner: np.ndarray, score: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each document's highest sentence (-1: none above an empty one) and its score, at least the empty sentence's 0."""
    top, best = np.full(n, -1), np.zeros(n)
    order = np.lexsort((score, owner))
    last = np.append(owner[order][1:] != owner[order][:-1], True) if len(order) else np.zeros(0, dtype=bool)
    at = order[last]
    up = at[score[at] > 0]
    top[owner[up]], best[owner[up]] = up, score[up]
    return top, best


_known: dict[str, float] = {}
_known_of: list = [None]


def _word_scores(model: Model, key: int, words: list[str]) -> np.ndarray:
    """The scores of folded words; tokens that differ in case or punctuation only share one."""
    if _known_of[0] != key:
        _known.clear()
        _known_of[0] = key
    if len(_known) > CACHE:  # the older half goes
        for w in list(islice(_known, len(_known) - CACHE // 2)):
            del _known[w]
    new = [w for w in words if w not in _known]
    _known.update(zip(new, model.words(new).tolist(), strict=True))
    out = np.fromiter(map(_known.__getitem__, words), dtype=np.float64, count=len(words))
    for w in new:
        if len(w) > 64:
            del _known[w]
    return out


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        key = hash((tuple(model.landmarks.words), model.dual.tobytes()))
        for batch in batches:
            best = np.zeros(batch.num_rows)
            for row, bounds, codes, tokens in coded_slices(batch.column(1), 4 << 20):
                folded, ends, single = _tokens(tokens)
                words, place = _distinct(folded)
                value = _word_scores(model, key, words)[place][codes]
                spelled = _spelled(bounds, codes, folded, single)
                if spelled:
                    value[[at for at, _ in spelled]] += model.words([word for _, word in spelled])
                starts = _sentences(bounds, codes, ends)
                if len(starts):
                    owner = np.searchsorted(bounds, starts, side="right") - 1
                    np.maximum.at(best, row + owner, np.add.reduceat(value, starts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.probability(best))], names=["doc_id", "score"])

    return run


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_score(shared), "doc_id long, score double")


def held_out(doc_id: Column) -> Column:
    """Rows never learnt from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))
