"""Ranked search by presence masks against brute force."""

import math
import random
import re

import numpy as np
import pytest

from tallyho.llm import mask_search as M

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return _TERM.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def brute(docs, items, top=10):
    texts = [(i, terms(t)) for i, t in docs]
    n_docs, n_words = sum(bool(t) for _, t in texts), sum(len(t) for _, t in texts)
    asked = {}
    for item, t in items:
        asked.setdefault(item, set()).update(terms(t))
    out = []
    for item, own in asked.items():
        found = []
        for doc, t in texts:
            score = 0
            for x in own & set(t):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(x in set(u) for _, u in texts) + 1)))
                m = 10 + 90 * len(t) * n_docs // n_words
                score += w * (1000000000 * t.count(x) // (1000 * t.count(x) + 8 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, i, doc, -s) for i, (s, _, _, doc) in enumerate(sorted(found, key=lambda x: x[:3])[:top], 1)]
    return sorted(out, key=repr)


def corpus(seed=4):
    r = random.Random(seed)
    words = ["the", "The", "of", "Über", "über", "日本", "don't", "e-mail", "x_y"] + [f"w{i}" for i in range(90)]
    draw = lambda n: " ".join(words[min(int(r.expovariate(0.08)), len(words) - 1)] for _ in range(n))
    docs = [(0, None), (1, ""), (2, " .,;\x7f\n"), (None, "w1 w2 the"), (7, "w1 w2 the"), (7, "w1 w2 the"), (9, "W1;w2|THE")]
    docs += [(10 + i, draw(r.choice([1, 3, 20, 60]))) for i in range(150)]
    docs.append((400, draw(20_000)))
    items = [(1, draw(12)), (2, draw(3)), (3, None), (4, "..."), (5, "nowhere"), (None, draw(5)), (6, "the the THE"), (6, "w1"), (7, " ".join(words))]
    return docs, items


def run(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, score int, rank string").repartition(4)
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, n int")
    return sorted((tuple(x) for x in M.ranked(d, q, **options).collect()), key=repr)


@pytest.mark.parametrize(("block_docs", "block_terms"), [(8192, 10**6), (7, 30)])
def test_ranked_equals_brute_force(spark, monkeypatch, block_docs, block_terms):
    docs, items = corpus()
    monkeypatch.setattr(M, "BLOCK_DOCS", block_docs)
    assert run(spark, docs, items, block_terms=block_terms) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = corpus()
    assert run(spark, [], items) == [] and run(spark, docs, []) == []


def test_no_document_outside_the_evaluated_masks_is_better():
    r = np.random.default_rng(1)
    for _ in range(50):
        n_docs, n_terms = int(r.integers(1, 200)), int(r.integers(1, 90))
        held = r.random((n_docs, n_terms)) < r.random(n_terms) * 0.6
        rows, cols = np.nonzero(held)
        items = M.Items([1], [np.arange(n_terms)], r.integers(0, 9000, n_terms), n_docs, int(held.sum()) + 1, 10)
        block = M.Block(items, held.sum(axis=1), held.sum(axis=1), cols, r.integers(1, 9, len(cols)))
        exact = block.scores(np.arange(n_docs), np.flatnonzero(block.most > 0))
        docs, scores = M.best_of_block(block, np.arange(n_terms), 10, 1)
        assert (exact[docs] == scores).all()
        floor = max(1, np.sort(exact)[-10:][0] if n_docs >= 10 else 1)
        assert set(np.flatnonzero(exact >= floor)) <= set(docs.tolist())


def test_most_documents_are_not_evaluated():
    r = np.random.default_rng(2)
    n_docs = 5000
    common = np.stack((np.arange(n_docs), np.zeros(n_docs, np.int64)))
    rare = np.stack((np.arange(40), np.ones(40, np.int64)))
    rows, cols = np.concatenate((common, rare), axis=1)
    order = np.lexsort((cols, rows))
    items = M.Items([1], [np.arange(2)], np.array([1, 9000]), n_docs, 100_000, 10)
    block = M.Block(items, np.full(n_docs, 20), np.bincount(rows), cols[order], r.integers(1, 3, len(rows)))
    assert len(M.best_of_block(block, np.arange(2), 10, 1)[0]) == 40
