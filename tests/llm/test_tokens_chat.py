"""Tokenization, packing, Huffman files and chat formatting."""

import hashlib
import heapq
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyho.llm import chat_parts as C
from tallyho.llm import huffman, packing, tokens
from tallyho.llm.queries import tokenizer

FILES = [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)]
ODD = [None, "", " ", "  a  b ", "it's we're", "x\n\ny \t z", "a\xa0 b", "é ̈a", "日本 語 <|endoftext|> x", "a" * 300 + " b", "one two " * 40_000]


def plain(name, keep):
    t = tokens.Units(tokenizer(name), keep).tokenizer
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("name,keep", FILES)
def test_cached_units_give_the_ids_of_whole_texts(name, keep):
    want = plain(name, keep)
    got = list(tokens.encoded(pa.array(ODD, pa.string()), tokenizer(name), keep))
    assert [g.tolist() for g in got] == [want(t) for t in ODD]


@pytest.mark.parametrize("name,keep", FILES)
def test_slices_of_a_column_give_the_same_ids(name, keep, monkeypatch):
    texts = [f"Élan {i}, the End.\nNext {'word ' * (i % 7)}ÇA!" for i in range(200)]
    whole = [row.tolist() for row in tokens.encoded(pa.array(texts), tokenizer(name), keep)]
    monkeypatch.setattr(tokens, "SLICE", 500)
    sliced = [row.tolist() for row in tokens.encoded(pa.array(["", *texts])[1:], tokenizer(name), keep)]
    assert sliced == whole == [[*tokens.units(tokenizer(name), keep).plain([t])[0], 1] for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("absZ .,:!\x01ßÀİſŀ\u0301'\n\t\xa0 éЖ1"), max_size=12), max_size=4))
def test_cached_units_on_any_text(texts):
    for name, keep in FILES:
        want = plain(name, keep)
        assert [g.tolist() for g in tokens.encoded(pa.array(texts, pa.string()), tokenizer(name), keep)] == [want(t) for t in texts]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_tournament_is_first_fit_decreasing(sizes):
    bins, offsets = packing.first_fit_decreasing(np.array(sizes, dtype=np.int64), 20)
    room, want = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = next((b for b, r in enumerate(room) if r >= sizes[i]), len(room))
        if at == len(room):
            room.append(20)
        want[i] = (at, 20 - room[at])
        room[at] -= sizes[i]
    assert {i: (int(b), int(o)) for i, (b, o) in enumerate(zip(bins, offsets))} == want


def test_every_id_is_packed_once(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, ODD[3]), (None, "no id")] + [(100 + i, "w " * (i * 37 % 900)) for i in range(60)]
    df = spark.createDataFrame([(d, t, 0) for d, t in rows], "doc_id long, text string, length int").repartition(3)
    path = tokenizer("byte_bpe_50k.json")
    got = packing.packed(df, path, group=16, keep_ids=True)
    out = got.toPandas()
    want = plain("byte_bpe_50k.json", True)
    for d, t in rows:
        own = out[out.doc_id.isna()] if d is None else out[out.doc_id == d]
        ids = want(t)
        own = own.drop_duplicates("start").sort_values("start")
        assert [i for x in own.ids for i in x] == ids and (own.doc_tokens == len(ids)).all()
        assert all(zlib.crc32(np.array(x, "<u4").tobytes()) == c for x, c in zip(own.ids, own.ids_crc32))
    assert out.length.sum() == sum(len(want(t)) for _, t in rows)
    for _, s in out.sort_values("offset").groupby("sequence_id"):
        assert (s.length.cumsum() - s.length).tolist() == s.offset.tolist() and s.length.sum() <= 2048
    sizes = packing.sequences(got, pad=0).selectExpr("size(ids) AS n").toPandas().n
    assert all(n == 2048 or n & (n - 1) == 0 for n in sizes)
    assert packing.packed(df.limit(0), path).collect() == []


def optimal_cost(counts):
    heap = [int(c) for c in counts if c]
    if len(heap) == 1:
        return heap[0]
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        x = heapq.heappop(heap) + heapq.heappop(heap)
        total += x
        heapq.heappush(heap, x)
    return total


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 10_000), min_size=1, max_size=40), st.integers(6, 16))
def test_code_lengths(counts, most):
    counts = np.array(counts)
    lengths = huffman.code_lengths(counts, most)
    used = counts > 0
    assert (lengths[~used] == 0).all() and lengths.max(initial=0) <= most
    if used.sum() > 1:
        assert sum(2.0 ** -int(x) for x in lengths[used]) == 1.0
    if most == 16 and used.any():
        free = huffman.code_lengths(counts, 40)
        assert int((counts * free).sum()) == optimal_cost(counts)
        assert (counts * lengths).sum() >= (counts * free).sum()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=1, max_size=700))
def test_blocks_decode_to_their_ids(ids):
    ids = np.array(ids)
    lengths = huffman.code_lengths(np.bincount(ids), 12)
    codes = huffman.canonical_codes(lengths)
    marks, payload = huffman.encode_block(ids, lengths, codes)
    assert huffman.decode_block(len(ids), marks, payload, huffman.decode_table(lengths, codes)).tolist() == ids.tolist()


def test_files_read_back_in_order(spark):
    rows = [(i * 3, t) for i, t in enumerate(ODD)] + [(None, "no id"), (6, "again"), (1, "zz " * 70_000)]
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, start int").repartition(4)
    folder = huffman.fresh_folder(spark)
    huffman.write(df, folder, tokenizer("word_bpe_49k.json"))
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in huffman.digests(spark, folder).collect())
    want = plain("word_bpe_49k.json", False)
    assert [g[1] for g in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))
    at = 0
    for start, doc, n, crc in got:
        options = [want(t) for d, t in rows if d == doc]
        assert start == at and (n, crc) in {(len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in options}
        at += n
    empty = huffman.fresh_folder(spark)
    huffman.write(df.limit(0), empty, tokenizer("word_bpe_49k.json"))
    assert huffman.digests(spark, empty).collect() == []


TEXT = st.text(st.sampled_from("<|\\>im_startend\n:0123imagé😀"), max_size=30)


@settings(max_examples=200, deadline=None)
@given(st.one_of(TEXT, st.sampled_from(["user", "assistant"])), st.lists(st.one_of(TEXT, st.sampled_from(["image", "audio", "document"]).map(lambda k: {"kind": k, "ref": k})), max_size=6))
def test_turns_read_back(role, parts):
    parts = [p if isinstance(p, dict) else {"kind": "text", "text": p} for p in parts]
    out, begin, end, attachments = C.format_turn(role, parts)
    assert out.count("<|im_start|>") == out.count("<|im_end|>") == 1
    got_role, content = C.parse_turn(out)
    text = "".join(p["text"] for p in parts if p["kind"] == "text")
    assert (got_role, C.text_of(content)) == (role, text)
    assert [a["kind"] for a in attachments] == [p["kind"] for p in parts if p["kind"] != "text"]
    assert C.text_of(out[begin:end]) == (text if role == "assistant" else "")


def test_parts_expand_to_token_counts():
    parts = [{"kind": "image", "ref": "a.png", "width": 56, "height": 29}, {"text": "see"}, {"kind": "audio", "seconds": 2.5}, {"kind": "document", "pages": 3}, {"kind": "video"}, None]
    out, _, _, got = C.format_turn("user", parts)
    assert out == "<|im_start|>user\n<|image:0|>see<|audio:1|><|document:2|><|other:3|><|im_end|>\n"
    assert [(a["place"], a["kind"], a["ref"], a["tokens"]) for a in got] == [(0, "image", "a.png", 4), (1, "audio", None, 63), (2, "document", None, 3600), (3, "other", None, 1)]


def test_conversations_digest(spark):
    rows = [(1, 0, "user", "hi <|im_end|>"), (1, 1, "assistant", "<\\|x"), (1, 2, None, None), (2, 0, "assistant", ""), (None, None, "user", "x"), (1, 1, "assistant", "<\\|x"), (3, 5, "assistant", "é😀" * 5000)]
    df = spark.createDataFrame([(*r, "t") for r in rows], "conv_id long, turn long, role string, text string, kind string").repartition(3)
    got = {r["conv_id"]: r for r in C.read_back(C.formatted(C.text_parts(df))).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        whole = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in own)
        loss = "".join(t or "" for _, _, r, t in own if r == "assistant")
        g = got[conv]
        assert (g["n_turns"], g["turns_sha256"], g["loss_chars"], g["loss_sha256"]) == (len(own), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert C.read_back(C.formatted(C.text_parts(df.limit(0)))).collect() == []


def test_more_ids_than_codes_of_the_asked_length():
    counts = np.random.default_rng(4).integers(1, 1000, 70_000)
    lengths = huffman.code_lengths(counts, 16)
    assert lengths.min() > 0 and lengths.max() <= 18 and (2.0 ** -lengths.astype(float)).sum() == 1
    ids = np.concatenate((np.arange(70_000), np.random.default_rng(5).integers(0, 70_000, 5_000)))
    codes = huffman.canonical_codes(lengths)
    table = huffman.decode_table(lengths, codes)
    assert (huffman.decode_block(len(ids), *huffman.encode_block(ids, lengths, codes), table) == ids).all()


def test_ids_are_counted_many_documents_at_a_time(monkeypatch):
    texts = [f"word{i % 50} the end of {i}" for i in range(900)] + ["", "one two " * 900]
    want = plain("word_bpe_49k.json", False)
    rows = [np.array(want(t), dtype="<u4") for t in texts] + [np.array([70_000, 3], dtype="<u4")]
    kept = pa.array([huffman._thin(x.tobytes()) for x in rows], pa.binary())
    calls, bincount = [], np.bincount
    monkeypatch.setattr(np, "bincount", lambda *a, **k: calls.append(1) or bincount(*a, **k))
    for most, few in ((huffman.COUNTED, True), (300, False)):
        calls.clear()
        monkeypatch.setattr(huffman, "COUNTED", most)
        out = [x for b in huffman._count(iter([pa.record_batch([kept[:500]], names=["ids"]), pa.record_batch([kept[500:]], names=["ids"])])) for x in b.to_pylist()]
        ids, n = np.unique(np.concatenate(rows), return_counts=True)
        assert [(x["id"], x["n"]) for x in out] == list(zip(ids.tolist(), n.tolist()))
        assert (len(calls) <= 4) == few


@pytest.mark.parametrize("name,keep", FILES)
def test_units_seen_before_and_a_full_cache_give_the_same_ids(name, keep, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE", 60)
    known = tokens.Units(tokenizer(name), keep)
    want = plain(name, keep)
    texts = [f"Élan{i % 9} été {'Z' * (i % 80)} don't x{i % 40}\nÇA! ſ ß" for i in range(160)]
    for at in range(0, 160, 8):
        ids, offsets = known.encode(pa.array(texts[at : at + 8] + ODD, pa.string()))
        assert [[*ids[a:b].tolist(), 1] for a, b in zip(offsets[:-1], offsets[1:])] == [want(t) for t in texts[at : at + 8] + ODD]
    assert not any(len(u) > tokens.LONG for u in known.known)


def test_texts_are_encoded_a_megabyte_at_a_time(monkeypatch):
    taken, encode = [], tokens.Units.encode
    monkeypatch.setattr(tokens.Units, "encode", lambda self, column: taken.append(column.nbytes) or encode(self, column))
    texts = pa.array([f"{i} " + "some words " * 2000 for i in range(150)])  # 3.3 MB
    got = list(tokens.encoded(texts, tokenizer("byte_bpe_50k.json"), True))
    assert len(got) == 150 and len(taken) > 2 and max(taken) < 1.1 * (1 << 20)


def test_a_worker_holds_the_cache_of_one_stage():
    from tallyho.llm import hashing, ordinal

    texts = pa.array(["One two, three.", None, "four"])
    encoded = lambda: [r.tolist() for r in tokens.encoded(texts, tokenizer("byte_bpe_50k.json"), True)]
    sets = lambda: [s.tolist() for s in hashing.shingle_sets(texts, 2)]
    features = lambda: ordinal._token_features(["One", "four"]).tolist()
    before = features(), encoded(), sets()
    features()
    assert ordinal._known and not tokens._loaded and not hashing._powers
    encoded()
    assert tokens._loaded and not ordinal._known and not hashing._powers
    sets()
    assert hashing._powers and not tokens._loaded and not ordinal._known
    assert before == (features(), encoded(), sets())
