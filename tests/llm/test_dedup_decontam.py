"""Shingle hashing, near-duplicate groups and containment against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tallyho.llm import decontam, minmax
from tallyho.llm import hashing as H
from tallyho.llm.components import components

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    words = _WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def groups(sets, percent):
    root = {k: k for k in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {k: top(k) for k in ids}


def corpus(seed=3):
    r = random.Random(seed)
    vocabulary = ["ab", "Çé", "x1", "Über", "日本", "foo.", "bar,", "the", "of"] + [f"w{i}" for i in range(300)]
    draw = lambda n: [r.choice(vocabulary) for _ in range(n)]
    base = [draw(60) for _ in range(6)]
    texts = [None, "", "  \t\n", "one", "ONE", "two words", "two  words", "a b c d", "a b c", " ".join(draw(30_000))]
    for b in base:
        for _ in range(12):
            t = list(b)
            for _ in range(r.choice([0, 0, 1, 2, 3, 5])):
                t[r.randrange(len(t))] = r.choice(vocabulary)
            texts.append(r.choice([" ", "\n", "  "]).join(t))
    star = draw(100)  # a hub whose copies differ from each other more than from it
    texts.append(" ".join(star))
    for i in range(40):
        t = list(star)
        t[(i * 13) % 90] = f"n{i}"
        t[(i * 29 + 7) % 90] = f"m{i}"
        texts.append(" ".join(t))
    ids = list(range(5, 5 + len(texts)))
    r.shuffle(ids)
    return list(zip(ids, texts))


@pytest.mark.parametrize("k", [1, 4, 5])
def test_shingle_sets_match_words(k, monkeypatch):
    monkeypatch.setattr(H, "CHUNK", 64)  # rows longer than a chunk too
    texts = [t for _, t in corpus()]
    seen = {}
    for text, got in zip(texts, H.shingle_sets(pa.array(texts, pa.string()), k)):
        want = shingles(text, k)
        assert len(got) == len(want)
        seen.setdefault(frozenset(want), got.tobytes())
        assert seen[frozenset(want)] == got.tobytes()
    assert len(set(seen.values())) == len(seen)
    flat = {}
    for hashes, rows in H.flat_shingles(pa.array(texts, pa.string()), k):
        for h, row in zip(hashes.tolist(), rows.tolist()):
            flat.setdefault(row, set()).add(h)
    assert [len(flat.get(i, ())) for i in range(len(texts))] == [len(shingles(t, k)) for t in texts]


@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates_are_those_of_brute_force(spark, k):
    rows = corpus()
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows + rows[:9]], "doc_id long, text string, band string, root int").repartition(5)
    got = {r["doc_id"]: r for r in minmax.near_duplicates(df, k).collect()}
    sets = {d: shingles(t, k) for d, t in rows}
    want = groups(sets, 80)
    assert {d: r["component_id"] for d, r in got.items()} == want
    assert all(r["n_shingles"] == len(sets[d]) and r["kept"] == (want[d] == d) for d, r in got.items())


def test_near_duplicates_of_nothing(spark):
    assert minmax.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    blank = spark.createDataFrame([(1, None), (2, ""), (None, "x")], "doc_id long, text string")
    assert sorted(map(tuple, minmax.near_duplicates(blank).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_open_buckets_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(minmax, "BLOCK", 3)
    rows = corpus(5)
    got = minmax.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == groups({d: shingles(t, 4) for d, t in rows}, 80)


def test_pairs_with_one_bucket_only_are_compared_in_it():
    # Minima of large sets agree in the bits that the signature keeps; the band keys still differ.
    keys = np.arange(2 * minmax.BANDS).reshape(2, -1)
    keys[1, 7] = keys[0, 7]
    words = np.arange(100, dtype=np.uint64)
    sign = np.zeros(2 * minmax.PERMUTATIONS, np.uint16).tobytes()
    row = lambda i, left: pa.table({"band": pa.array([7], pa.int32()), "id": [i], "root": [i], "is_left": [left], "shingles": [words[i:].tobytes()], "sign": [sign], "bands": pa.array([keys[i].tolist()], pa.list_(pa.int64()))})
    compare = minmax._block_links(80, 0.6)
    assert compare(row(0, True), row(1, False)).to_pylist() == [{"a": 0, "b": 1}]
    keys[1, 3] = keys[0, 3]  # a pair that met in an earlier bucket was compared there
    assert compare(row(0, True), row(1, False)).to_pylist() == []


def test_components_of_chains_stars_and_repeats(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 150)] + [(7, 3), (200, 200), (None, 4), (149, 300)]
    got = {r["id"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in (*range(100, 150), 300)}}


def test_containment_is_that_of_brute_force(spark):
    r = random.Random(8)
    words = [f"q{i}" for i in range(500)]
    items = [(i, " ".join(r.choice(words) for _ in range(n))) for i, n in enumerate([3, 5, 8, 16, 31, 32, 33, 59, 200])] + [(50, None), (51, " "), (0, "q1 q2 q3")]
    docs = []
    for d in range(120):
        i, text = r.choice(items[:9])
        part = text.split()
        for _ in range(r.choice([0, 0, 0, 1, 2, 4])):
            part[r.randrange(len(part))] = "changed"
        around = lambda: [r.choice(words) for _ in range(r.choice([0, 5, 400]))]
        docs.append((d, " ".join(around() + part + around())))
    docs += [(900, None), (901, ""), (902, items[4][1].upper().replace(" ", "\n"))]
    df = spark.createDataFrame([(d, t, 0) for d, t in docs + docs[:3]], "doc_id long, text string, item_id int")
    want = {}
    for d, t in docs:
        own = shingles(t, 5)
        for i, text in items:
            item = shingles(text, 5)
            both = len(own & item)
            if item and 100 * both >= 80 * len(item):
                want[d, i] = max(want.get((d, i), (0, 0)), (len(item), both))
    bench = spark.createDataFrame(items[:-1], "item_id long, text string")
    want = {k: v for k, v in want.items() if k[1] != 0 or v[0] == len(shingles(items[0][1], 5)) and items[0][1] in " ".join(_WORD.findall(dict(docs)[k[0]]))}
    for block in (1_000_000, 40):  # one block, and many
        got = decontam.contained(df, bench, block_shingles=block).collect()
        found = {(x["doc_id"], x["item_id"]): (x["n_item"], x["n_shared"]) for x in got}
        assert len(found) == len(got)
        assert {k: v for k, v in found.items() if k[1]} == {k: v for k, v in want.items() if k[1]}
    clean = decontam.decontaminated(df, bench)
    assert clean.columns == df.columns
    assert {x["doc_id"] for x in clean.collect()} == {d for d, _ in docs} - {d for d, _ in found}
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contained(df, empty).collect() == []


def test_items_below_the_shingle_width_are_found_inside_documents(spark):
    items = [(1, "Paris"), (2, "forty  two"), (3, "a b c"), (4, "w x y z"), (5, "one two three four five"), (6, "b c"), (6, "c d")]
    docs = [
        (1, "the capital is PARIS of course and nothing else " + "pad " * 40),
        (2, "forty two"),
        (3, "pad " * 30 + "forty\ntwo"),
        (4, "forty pad two a b pad c paris. " * 9),
        (5, "a b c d"),
        (6, "say w x y z again and w x y z again"),
        (7, "zero one two three four five six"),
        (8, "one two three four"),
        (9, "w x y"),
        (10, None),
        (11, " "),
        (12, "paris"),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(2)
    bench = spark.createDataFrame(items, "item_id long, text string")
    spread = lambda t: f" {' '.join(_WORD.findall((t or '').lower()))} "
    want = {(d, i) for d, t in docs for i, item in items if spread(item) in spread(t)}
    assert {(3, 2), (1, 1), (6, 4), (5, 6)} < want
    for block in (1_000_000, 1):
        got = decontam.contained(df, bench, block_shingles=block).collect()
        assert sorted((r["doc_id"], r["item_id"]) for r in got) == sorted(want)
        assert all(r["n_item"] == r["n_shared"] == 1 for r in got)
    assert {r["doc_id"] for r in decontam.decontaminated(df, bench).collect()} == {d for d, _ in docs} - {d for d, _ in want}


def test_one_block_of_items_is_held_at_a_time(spark, monkeypatch):
    live, most = set(), []
    make = type(spark.sparkContext).broadcast

    def broadcast(context, value):
        shared = make(context, value)
        live.add(id(shared))
        most.append(len(live))
        destroy = shared.destroy
        shared.destroy = lambda *a: (live.discard(id(shared)), destroy(*a))
        return shared

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", broadcast)
    text = lambda a: " ".join(f"w{i}" for i in range(a, a + 20))
    items = spark.createDataFrame([(i, text(100 * i)) for i in range(12)], "item_id long, text string")
    docs = spark.createDataFrame([(i, "x " + text(100 * i) + " y") for i in range(12)], "doc_id long, text string")
    got = decontam.contained(docs, items, block_shingles=40)
    assert len(most) == 5 and max(most) == 1 and not live
    assert sorted((r["doc_id"], r["item_id"]) for r in got.collect()) == [(i, i) for i in range(12)]


def test_rows_that_share_an_id_are_one_document_in_any_order(spark):
    r = random.Random(11)
    draw = lambda: [f"v{r.randrange(10**6)}" for _ in range(60)]
    a, b, c = draw(), draw(), draw()
    near = lambda t: " ".join([*t[:59], "x"])
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, near(a)), (3, near(b)), (4, " ".join(c)), (4, None), (4, " ".join(c)), (5, near(c)), (6, "alone"), (None, near(a))]
    want = [(1, 57, 1), (2, 57, 1), (3, 57, 1), (4, 57, 4), (5, 57, 4), (6, 1, 6)]
    for order in (rows, rows[::-1], sorted(rows, key=str)):
        df = spark.createDataFrame(order, "doc_id long, text string").coalesce(1)
        got = sorted((x["doc_id"], x["n_shingles"], x["component_id"]) for x in minmax.near_duplicates(df, 4, 80).collect())
        assert got == want
