"""Toxicity, quality, fingerprints and the pipeline."""

import hashlib
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyho.llm import imatch, ordinal, toxicity
from tallyho.llm.queries import QUERIES, grades, table

SF = "/root/testdata/sf0.01"


def naive_kernel(s, t):
    total = 0.0
    for a in itertools.combinations(range(len(s)), toxicity.P):
        for b in itertools.combinations(range(len(t)), toxicity.P):
            if all(s[i] == t[j] for i, j in zip(a, b)):
                total += toxicity.DECAY ** (a[-1] - a[0] + 1 + b[-1] - b[0] + 1)
    return total


def test_kernel_counts_gapped_subsequences():
    words = ["idiot", "idxiot", "diot", "abc", "cab", "aaaa", "éclair"]
    m = toxicity._matrix(words)
    for (i, s), (j, t) in itertools.product(enumerate(words), repeat=2):
        assert toxicity.kernel_pairs(m[i : i + 1], m[j : j + 1])[0] == pytest.approx(naive_kernel(s, t))


def test_prefilter_is_the_common_subsequence_length():
    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            row = [0, *itertools.accumulate(range(len(b)), lambda m, j: max(m, row[j + 1], row[j] + (x == b[j])), initial=0)][1:]
        return row[-1]

    landmarks = ["worthless", "idiot", "réeux"]
    words = ["wxorthless", "the", "idi", "toidi", "", "reeux", "réexux", "less" * 6]
    for w in landmarks:
        one = toxicity.Letters(landmarks)
        got = toxicity.common_length(one.codes(toxicity._matrix(words)), one.codes(toxicity._matrix([w]))[0], len(one.letters))
        assert got.tolist() == [lcs(x, w) for x in words]


def test_look_alikes_in_place_of_letters_score_as_the_word():
    marks = toxicity.Landmarks(["moron", "loser", "stupid"])
    hidden = ["m0r0n", "L0s3r", "s7up1d", "lo$er", "mor0n!"]
    assert marks.kernel([toxicity.fold(w) for w in hidden]).max(axis=1) == pytest.approx(np.ones(len(hidden)))
    assert [toxicity.fold(w) for w in ("5th", "2019", "c3", "i-d-i-o-t", "x100y", "Éa_b")] == ["th", "", "c", "idiot", "xy", "éab"]


def test_held_out_toxicity_and_inserted_characters(spark):
    big = SF.replace("0.01", "0.1")
    docs, labels = table(spark, big, "documents"), table(spark, big, "labels")
    out = toxicity.held_out(F.col("doc_id"))
    model = toxicity.train(docs, labels.where(~out))
    held = labels.where(out)
    got = toxicity.scored(docs.join(held, "doc_id", "left_semi"), model).join(held, "doc_id").toPandas()
    flagged, toxic = got.score >= 0.3, got.toxic == 1
    assert (flagged & toxic).sum() / flagged.sum() > 0.75 and (flagged & toxic).sum() / toxic.sum() > 0.7
    plain, *hidden = model.words([toxicity.fold(w) for w in ("idiot", "id1iot", "i-d-i-o-t", "idxiot", "idiiot")])
    assert all(h > 0.4 * plain for h in hidden) and abs(model.words(["ertion"])[0]) < 0.4 * plain
    odd = spark.createDataFrame([(1, None, 1), (2, "", 1), (None, "idiot", 0), (4, "s t u p i d", 0), (4, "s t u p i d", 0)], "doc_id long, text string, score int")
    rows = toxicity.scored(odd, model).collect()
    score = {r["doc_id"]: r["score"] for r in rows}
    assert len(rows) == 5 and score[1] == score[2] and 0 <= min(score.values()) and score[4] > score[1]


def test_labels_of_one_kind_or_none(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (3, "")], "doc_id long, text string")
    for rows in ([], [(1, 0), (2, 0), (3, None)], [(1, 1)]):
        model = toxicity.train(docs, spark.createDataFrame(rows, "doc_id long, toxic int"))
        assert len({r["score"] for r in toxicity.scored(docs, model).collect()}) == 1
        quality = ordinal.train(docs, spark.createDataFrame(rows, "doc_id long, grade int"))
        got = {round(r["expected_grade"], 6) for r in ordinal.graded(docs, quality).collect()}
        assert got == {float(max((g for _, g in rows if g is not None), default=0))}
    assert toxicity.scored(docs.limit(0), model).collect() == []


def test_ordinal_thresholds_are_ordered_and_grades_follow():
    r = np.random.default_rng(1)
    sample = []
    for _ in range(900):
        z = r.normal()
        grade = int(z > -0.5) + int(z > 0.3) + int(z > 1.2)
        sample.append((np.array([3, 9], np.int32), np.array([z, 1.0], np.float32), grade))
    model = ordinal.fit(sample, 4)
    assert (np.diff(model.thresholds) > 0).all()
    scores = np.array([float(s @ model.weights[a]) for a, s, _ in sample])
    tails = model.tails(scores)
    assert (np.diff(tails, axis=1) <= 0).all()
    hit = np.abs(tails.sum(axis=1) - np.array([g for *_, g in sample])) < 0.5
    assert hit.mean() > 0.85


def test_quality_reads_long_tokens_whole():
    from types import SimpleNamespace

    import pyarrow as pa

    head = "".join(chr(0x4E00 + i) for i in range(ordinal.LONG))
    pieces = [head, "好。" * 32, "A9!" * 5]
    texts = [head, head + "好" * 70, head + "A9!" * 30, "".join(pieces), " ".join(pieces), "a b " + head + "x y", None, "a b"]
    model = ordinal.Model(np.random.default_rng(2).normal(size=1 << ordinal.BITS), np.array([0.0]))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])
    (out,) = ordinal._score(SimpleNamespace(value=model))(iter([batch]))
    score = out.column("score").to_pylist()
    assert len({round(x, 9) for x in score[:4]}) == 4  # all share their first LONG characters
    assert score[3] == pytest.approx(score[4]) and score[6] == 0
    (rows,) = ordinal._vectors(iter([pa.RecordBatch.from_arrays([batch.column(1), pa.array([0] * len(texts), pa.int32())], names=["text", "grade"])]))
    at, share = rows.column("at").to_pylist(), rows.column("share").to_pylist()
    assert len({tuple(a) for a in at[:4]}) == 4 and at[3] == at[4]
    assert [model.weights[a] @ np.array(s) for a, s in zip(at[:6], share)] == pytest.approx(score[:6], rel=1e-5)


def test_held_out_quality(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    out = toxicity.held_out(F.col("doc_id"))
    model = ordinal.train(docs, grades(labels).where(~out))
    held = docs.join(labels.where(out), "doc_id").withColumn("score", F.lit(1))
    kept = ordinal.selected(held, model)
    assert kept.columns == held.columns
    ids = {r["doc_id"] for r in kept.collect()}
    rows = held.collect()
    assert np.mean([(r["doc_id"] in ids) == (r["quality"] == 1) for r in rows]) > 0.93
    assert ordinal.selected(spark.createDataFrame([(None, None, 1), (2, "", 1)], "doc_id long, text string, tail int"), model).count() in (0, 2)


def test_fingerprints_against_brute_force(spark):
    import re

    import xxhash

    signed = lambda v: v - (1 << 64) if v >> 63 else v
    slot = lambda w: signed(xxhash.xxh64(w.encode(), seed=42).intdigest()) % (1 << imatch.BITS)
    terms = lambda t: {slot(w) for w in re.split(r"[^\w]+|_", t.lower()) if w}
    rows = sorted((r["doc_id"], r["text"]) for r in table(spark, "/root/testdata/sf0.001", "documents").collect())
    rows = [(d, t) for d, t in rows if t.isascii()][:80]
    rows += [(1000, ""), (1001, "zq"), (1002, rows[0][1]), (1003, "ab")]
    df = spark.createDataFrame([(d, t or None, "b") for d, t in rows], "doc_id long, text string, bucket string").repartition(4)
    got = {r["doc_id"]: r for r in imatch.edits(df).collect()}
    assert len(got) == len(rows)
    df_of = {}
    for _, t in rows:
        for s in terms(t):
            df_of[s] = df_of.get(s, 0) + 1
    n = len(rows)
    band = {s for s, k in df_of.items() if max(2, -(-n * 5 // 1000)) <= k <= max(2, n // 10)}

    def fingerprint(t):
        kept = sorted(terms(t) & band)
        if not kept:
            return "T;" + hashlib.sha256(t.encode()).hexdigest()
        level = len(kept).bit_length() - 1
        out = []
        for r in range(imatch.SUBSETS):
            h = {k: hash_int(r, hash_int(k, 42)) for k in kept}
            for by in range(imatch.LEVELS):
                own = [k for k in kept if h[k] & ((1 << level + by) - 1) == 0]
                if own:
                    v = 42
                    for k in own:
                        v = hash_int(k, v)
                    out.append(f"{r}.{level + by}:{v & (1 << 64) - 1:x}")
        return f"L{level};" + ",".join(out)

    def hash_int(i, seed):
        mask, p1, p2, p3 = (1 << 64) - 1, 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9
        h = (seed + 0x27D4EB2F165667C5 + 4) & mask
        h ^= (i & 0xFFFFFFFF) * p1 & mask
        h = ((h << 23 | h >> 41) & mask) * p2 + p3 & mask
        h = (h ^ h >> 33) * p2 & mask
        h = (h ^ h >> 29) * p3 & mask
        return h ^ h >> 32

    def likeness(a, b):
        if a == b:
            return 1.0
        if a[0] == "T" or b[0] == "T":
            return 0.0
        la, lb = (int(x[1 : x.index(";")]) for x in (a, b))
        ok = range(max(la, lb), min(la, lb) + imatch.LEVELS)
        entries = [{e for e in x.split(";")[1].split(",") if e} for x in (a, b)]
        keys = set().union(*({e.split(":")[0] for e in x if int(e.split(":")[0].split(".")[1]) in ok} for x in entries))
        return len(entries[0] & entries[1]) / len(keys) if keys else 0.0

    for i, (d, t) in enumerate(rows):
        following = rows[(i + 1) % n][1]
        edited = t[: len(t) - len(t) // 4] + following[: len(t) // 4]
        r = got[d]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == fingerprint(t) and r["edited_fingerprint"] == fingerprint(edited)
        assert r["near_edited"] == pytest.approx(likeness(r["fingerprint"], r["edited_fingerprint"]))
        assert r["near_next"] == pytest.approx(likeness(r["fingerprint"], fingerprint(following)))
    assert got[1002]["fingerprint"] == got[rows[0][0]]["fingerprint"]
    assert imatch.edits(df.limit(0)).collect() == []


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_stages_take_effect(spark, tmp_path):
    import corpus_pipeline as P
    from tallyho.llm import blob_ledger, decontam, minmax

    docs = table(spark, SF, "documents")
    extra = docs.limit(0).unionByName(spark.createDataFrame([(10**6, None, None, None, None), (10**6 + 1, "", "en", "s", 0)], docs.schema))
    docs = docs.unionByName(extra)
    before, seen = docs, {}
    for i, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, before, SF)
        if i < 4:
            assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
        out.write.parquet(f"{tmp_path}/{i}")
        seen[i] = (before, spark.read.parquet(f"{tmp_path}/{i}"))
        before = seen[i][1]
    quality = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    kept = {r["doc_id"] for r in seen[0][1].select("doc_id").collect()}
    assert np.mean([(d in kept) == (q == 1) for d, q in quality.items()]) > 0.95
    groups = minmax.near_duplicates(seen[1][0]).collect()
    assert {r["doc_id"] for r in seen[1][1].collect()} == {r["doc_id"] for r in groups if r["kept"]}
    leaks = {r["doc_id"] for r in decontam.contained(seen[2][0], table(spark, SF, "benchmark")).collect()}
    assert leaks and {r["doc_id"] for r in seen[2][1].collect()} == {r["doc_id"] for r in seen[2][0].collect()} - leaks
    assert seen[3][1].count() == seen[3][0].count()
    again = blob_ledger.findings(seen[3][1], f"{tmp_path}/ledger").where("size(found) > 0").count()
    assert again == 0 and seen[3][1].where("text LIKE '%[SECRET]%'").count() > 0
    packed = seen[4][1].groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m")).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in seen[3][1].collect()} and all(r["n"] == r["m"] for r in packed)


def test_stages_judge_rows_that_share_an_id_or_have_none(spark):
    import corpus_pipeline as P
    from tallyho.llm import decontam

    words = lambda a, b: " ".join(f"w{i}" for i in range(a, b))
    rows = [
        (7, words(0, 60), 0),
        (7, words(0, 60), 0),
        (3, words(0, 59), 1),
        (None, words(0, 60), 2),
        (None, words(100, 160), 3),
        (None, words(100, 160), 3),
        (9, words(200, 260), 4),
        (9, words(300, 360), 5),
        (None, None, 6),
        (None, None, 6),
        (2**62, words(100, 161), 7),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(4)
    kept = P.near_dedup(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted(r["n"] for r in kept.collect()) == [1, 4, 5, 6, 6, 7]  # the least id, NULL last, and blank rows as they are
    items = spark.createDataFrame([(1, words(110, 130)), (2, words(310, 330))], "item_id long, text string")
    clean = decontam.decontaminated(docs, items)
    assert clean.columns == docs.columns
    assert sorted(r["n"] for r in clean.collect()) == [0, 0, 1, 2, 4, 6, 6]
    assert decontam.decontaminated(docs.limit(0), items).collect() == []


def test_stages_give_python_small_batches(spark):
    import corpus_pipeline as P

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    try:
        docs = spark.createDataFrame([(i, f"text {i}") for i in range(3)], "doc_id long, text string")
        for setting, most in (("10000", 1000), ("0", 1000), ("200", 200)):
            spark.conf.set(key, setting)
            assert P.pack(spark, docs, SF).count() == 3
            assert max(r["n"] for r in spark.range(0, 2500, 1, 1).mapInArrow(sizes, "n long").collect()) == most
    finally:
        spark.conf.set(key, before)
