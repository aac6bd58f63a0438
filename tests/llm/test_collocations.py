"""Phrase counts and collocations against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallyho.llm import collocations as C
from tallyho.llm.bitmaps import Bitmap
from tallyho.llm.wordscan import scanned

SCHEMA = "doc_id long, lang string, text string, k string, phrase string, n long"
_FOLD = {i: i + 32 for i in range(65, 91)}


def brute(rows, support, longest=3, top=2000):
    f, n = Counter(), Counter()
    for _, lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(_FOLD)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    candidates = {g: a for g, a in f.items() if len(g[1]) > 1 and a >= support}
    out = []
    for (lang, p), a in candidates.items():
        around = [b for (x, q), b in candidates.items() if x == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
        if any(100 * b >= 50 * a for b in around):
            continue
        cuts = [(1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
        score, _, left, right = min(cuts)
        out.append((lang, " ".join(p), a, left, right, n[lang], score))
    ranked = []
    for lang in {x[0] for x in out}:
        own = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))
        ranked += [(x[0], i, *x[1:]) for i, x in enumerate(own[:top], 1)]
    return sorted(ranked)


def corpus(seed=5):
    r = random.Random(seed)
    words = ["the", "The", "of", "Über", "über", "日本", "don't", "e-mail", "x" * 70, "\x0bq", "a b"] + [f"w{i}" for i in range(25)]
    rows = [(0, "en", None), (1, "en", ""), (2, None, "  \t "), (3, "", "...!!"), (None, "en", "the of"), (None, "en", "the of")]
    for i in range(240):
        text = " ".join(r.choice(words) + r.choice(["", "", "", ".", ",", "\n", "\t", "  "]) for _ in range(r.randrange(40)))
        rows.append((i // 2, r.choice(["en", "en", "fr", None, "und"]), text))
    rows += [(900, "en", "big data set. big data set")] * 9
    rows.append((901, "fr", " ".join(r.choice(words) for _ in range(30_000))))
    return rows


def run(spark, rows, **options):
    docs = spark.createDataFrame([(*x, "x", "y", 7) for x in rows], SCHEMA).repartition(5)
    got = C.collocations(docs, **options).collect()
    return sorted((x["lang"], x["rank"], x["phrase"], x["a"], x["l"], x["r"], x["n"], x["score"]) for x in got)


@pytest.mark.parametrize("shards", [1, 3, 20])
def test_collocations_equal_brute_force(spark, shards):
    rows = corpus()
    want = brute(rows, 6)
    assert len(want) > 50
    assert run(spark, rows, support=6, shards=shards) == want


def test_longer_phrases_ties_and_top(spark):
    rows = [(i, "en", "a b c d e. x y; p q") for i in range(12)] + [(99, "en", "x y x z")]
    assert run(spark, rows, support=10, longest=4, top=3) == brute(rows, 10, 4, 3)
    assert run(spark, [], support=10) == []


def test_a_full_bitmap_changes_nothing(spark, monkeypatch):
    rows = corpus(8)
    monkeypatch.setattr(C, "bitmap", lambda hashes, n: Bitmap(np.full(1, 2**64 - 1, dtype=np.uint64)))
    assert run(spark, rows, support=6) == brute(rows, 6)


def test_long_texts_are_read_in_pieces():
    text = "ab cd, ef gh. " * 500
    column = pa.array(["x y", None, text, "", "z"])
    whole = [(int(w.rows[i]), w.distinct[int(c)].as_py()) for w in scanned(column, C.LETTERS, C.BREAKS) for i, c in enumerate(w.codes)]
    parts = [(int(w.rows[i]), w.distinct[int(c)].as_py()) for w in scanned(column, C.LETTERS, C.BREAKS, 100) for i, c in enumerate(w.codes)]
    assert parts == whole and len(whole) == 2003


@pytest.mark.parametrize("rows,size,once", [(C.PHRASES, C.PHRASE_BYTES, True), (40, C.PHRASE_BYTES, False), (C.PHRASES, 900, False)])
def test_a_task_adds_up_the_phrases_of_its_chunks(monkeypatch, rows, size, once):
    class Everything:
        value = Bitmap(np.full(1, 2**64 - 1, dtype=np.uint64))

    monkeypatch.setattr(C, "CHUNK", 200)
    monkeypatch.setattr(C, "PHRASES", rows)
    monkeypatch.setattr(C, "PHRASE_BYTES", size)
    texts = [("en", "a b c. É b a " * 60), ("fr", "a b"), ("en", ""), ("en", "a b. q%d")] * 20
    texts = [(lang, t % i if "%" in t else t) for i, (lang, t) in enumerate(texts)]
    batches = [pa.record_batch([[x for x, _ in texts[i : i + 16]], [0] * len(texts[i : i + 16]), [t for _, t in texts[i : i + 16]]], names=["lang", "shard", "text"]) for i in range(0, 80, 16)]
    out = [x for b in C._count(3, Everything)(iter(batches)) for x in b.to_pylist()]
    got, want = Counter(), Counter()
    for x in out:
        got[x["lang"], x["k"], x["phrase"]] += x["n"]
    for lang, text in texts:
        for piece in text.translate(_FOLD).split("."):
            w = piece.split()
            want[lang, 0, ""] += len(w)
            for k in (1, 2, 3):
                want.update((lang, k, " ".join(w[i : i + k])) for i in range(len(w) - k + 1))
    assert +got == +want
    assert (len(out) == len(got)) == once  # a row for a phrase, unless too many are held


@pytest.mark.parametrize("below", [50, 100_000])
def test_distinct_keys(below):
    keys = np.random.default_rng(3).integers(0, 50, 2000)
    distinct, at, inverse, n = C._distinct(keys, below)
    want, number, times = np.unique(keys, return_inverse=True, return_counts=True)
    assert (distinct == want).all() and (inverse == number).all() and (n == times).all() and (keys[at] == want).all()
    assert [len(x) for x in C._distinct(keys[:0], below)] == [0, 0, 0, 0]


def test_pieces_end_at_cuts_and_rows():
    column = pa.array(["a,b c", None, "", ",,d.e. f", ",", "g h,"])
    for cuts in (C.BREAKS, None, ~C.LETTERS, C.LETTERS):
        w = next(scanned(column, C.LETTERS, cuts))
        breaks = np.zeros(256, dtype=bool) if cuts is None else cuts
        assert (w.pieces == np.cumsum(breaks[w.data])[w.starts] + w.rows).all()
