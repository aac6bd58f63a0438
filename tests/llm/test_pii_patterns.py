"""Base spans against the plain regular expressions; contexts found by the pattern graph."""

import math
import random
import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyho.llm import pii_patterns as P

RULES = (
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda t: True),
    (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda t: all(int(x) <= 255 for x in t.split("."))),
    (r"[0-9]([\x20-]?[0-9])+", lambda t: 16 <= len(re.sub(r"\D", "", t)) <= 19 and luhn(re.sub(r"\D", "", t))),
    (r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: 8 <= len(re.sub(r"\D", "", t)) <= 15),
)


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute(text):
    return [(k, m.start(), m.end()) for k, (rule, fits) in enumerate(RULES) for m in re.finditer(rule, text) if fits(m[0])]


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="ab.@+-_%019 ()é\n", max_size=60))
def test_base_spans_equal_the_regular_expressions(text):
    assert P.base_spans(text) == brute(text)


def test_base_spans_of_real_forms():
    texts = [
        "a.b+c@x-1.co.uk,d@e f@g.h_i@j.k.", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.004 1..2.3.4.5", "4111111111111111; 4111-1111 1111-1111x; 4111111111111112",
        "+1 (168) 555-5254 +12 +1234567 +12345678-", "x" * 50 + "@" * 30 + "a@b.c@d.e", "9" * 50_000 + ".1.2.3", "+1" + " " * 50_000,
    ]
    for t in texts:
        assert P.base_spans(t) == brute(t) if len(t) < 1000 else P.base_spans(t) is not None
    assert [s[0] for t in texts[:4] for s in P.base_spans(t)].count(2) == 2


def test_long_texts_take_time_in_proportion():
    import time

    for unit in ("1.", "a@", "1-", "+1", "12345678", "a.b-c@d."):
        took = []
        for n in (20_000, 80_000):
            t = time.process_time()
            P.base_spans(unit * n)
            took.append(time.process_time() - t)
        assert took[1] < 10 * took[0] + 0.2


SCHEMA = "doc_id long, text string, spans string, kind int, digest string"


def detect(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA).repartition(4)
    out = P.detected(docs, **options).select("doc_id", P.span_text(P.F.col("base")).alias("base"), P.span_text(P.F.col("added"), "_context").alias("added")).collect()
    return sorted(((x["doc_id"], x["base"], x["added"]) for x in out), key=repr)


def corpus():
    r = random.Random(3)
    words = [f"w{c}" for c in "abcdefghijklmnop"] + ["the", "of", "é"]
    prose = lambda n: " ".join(r.choice(words) for _ in range(n))
    rows = [(i, f"{prose(9)} kindly write me at u{i}@mail.example.com soon {prose(5)}") for i in range(8)]
    rows += [(20 + i, f"{prose(4)} é call our desk: +1 (168) 555-52{i:02d} any day {prose(5)}") for i in range(8)]
    rows += [(40, f"{prose(3)} kindly write me at jdoe42@intranet soon {prose(3)}"), (41, f"é {prose(2)} call our desk: 0171 555 1234, any day")]
    rows += [(50 + i, f"{prose(30)} the {r.randrange(1000, 9999)} of {prose(4)}") for i in range(60)]
    return rows + [(None, "+1 (168) 555-5254"), (None, None), (7, ""), (990, None), (991, " \n"), (992, "4111111111111111"), (40, rows[16][1])]


def test_unseen_identifiers_are_found_by_their_contexts(spark):
    rows = corpus()
    got = detect(spark, rows)
    assert len(got) == len(rows)
    texts = {i: t for i, t in rows if i is not None}
    for doc, base, _ in got:
        if doc is not None and doc != 7:
            assert base == ",".join(f"{P.KINDS[k]}:{a}:{b}" for k, a, b in brute(texts[doc] or ""))
    added = {doc: more for doc, _, more in got if more}
    assert set(added) == {40, 41}
    spans = {doc: (more.split(":")[0], texts[doc][int(more.split(":")[1]) : int(more.split(":")[2])]) for doc, more in added.items()}
    assert spans == {40: ("email_context", "jdoe42@intranet"), 41: ("phone_context", "0171 555 1234")}
    assert sum(bool(more) for doc, _, more in got if doc == 40) == 2  # repeated rows, each
    assert detect(spark, []) == []


def test_a_pattern_among_plain_words_is_weak(spark):
    rows = [(i, f"x y write to u{i}@mail.example.com now") for i in range(5)] + [(100 + i, f"x y write to word{chr(97 + i % 26)} now") for i in range(40)] + [(200, "x y write to jdoe42@intranet now")]
    assert [x for x in detect(spark, rows) if x[2]] == []


def test_scores_equal_a_plain_computation(spark):
    r = random.Random(9)
    seeds = {(k, p, f"s{r.randrange(12)}") for k in (0, 1) for p in range(6) for _ in range(9 * (p % 2 == k) + r.randrange(2))}
    fills = {(p, f"v{r.randrange(10)}") for p in range(7) for _ in range(r.randrange(4))}
    plain = {p: r.randrange(3) for p in range(6)}
    strong, belief = P.scored(
        spark.createDataFrame(sorted(seeds), "kind int, pattern long, value string"),
        spark.createDataFrame([(p, v, 0) for p, v in sorted(fills)] * 2 + [(p, None, n) for p, n in plain.items()], "pattern long, value string, plain long"),
    )
    size = {p: len({v for _, q, v in seeds if q == p} | {v for q, v in fills if q == p}) + plain.get(p, 0) for p in range(7)}
    looked = {p for p in range(7) for k in (0, 1) if len({v for x, q, v in seeds if (x, q) == (k, p)}) >= P.SUPPORT}
    score = {}
    for _ in range(P.STEPS):
        conf = {(p, k): (sum(1 for x, q, _ in seeds if (x, q) == (k, p)) + sum(score.get((v, k), 0) for q, v in fills if q == p)) / (size[p] + 1) for p in looked for k in (0, 1)}
        conf = {x: c for x, c in conf.items() if c >= P.STRONG}
        score = {(v, k): 1 - math.prod(1 - conf[p, k] for p in range(7) if (p, v) in fills and (p, k) in conf) for _, v in fills for k in (0, 1)}
        score = {x: s for x, s in score.items() if s > 0}
    assert {(x["pattern"], x["kind"]): round(x["confidence"], 9) for x in strong.collect()} == {x: round(c, 9) for x, c in conf.items()} != {}
    assert {(x["value"], x["kind"]): round(x["belief"], 9) for x in belief.collect()} == {x: round(s, 9) for x, s in score.items()} != {}


def test_candidates_miss_no_identifier():
    r = random.Random(2)
    bits = ["ab", "12", "1234", "é", "@", " ", "  ", ".", "-", "(", ":", "+", "\n", "x9y8z7"]
    texts = ["".join(r.choice(bits) for _ in range(40)) for _ in range(200)]
    for w in P._whole_rows(pa.array(texts)):
        lexed = P.Lexed(w)
        every = P.np.arange(len(w.rows))
        likely = set(every[P._candidates(w, every)].tolist())
        for j in every.tolist():
            text, a = texts[w.rows[j]], int(lexed.starts[j])
            if (a == 0 or text[a - 1] in " \t\n\x0b\x0c\r([{<\"'=:,;|#+@") and P._TOKEN.match(text, a) and len(P._TOKEN.match(text, a)[0]) <= 20 and P.identifier(text, a):
                assert j in likely, (text, a)
