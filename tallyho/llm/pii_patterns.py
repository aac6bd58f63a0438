"""Personal data by bootstrapped contextual extraction.

Seeds.  E-mail and IP addresses, card and phone numbers are found by their
form (the base spans; all of them stay).

Patterns.  The words around a seed induce lexical patterns: the two words
before it, the three words before it, the word before with the word behind.
A pattern that ``SUPPORT`` different values of a kind induced is looked for in
all documents; what fills its slot is a base span, another identifier (a
token with an ``@`` or digits, and the digit groups that follow it, three
digits in all), or
plain text, which is counted only.

Graph.  Patterns and identifiers form a graph that Spark scores in ``STEPS``
turns.  A pattern's confidence in a kind is the belief in its values, 1 for a
seed, over all different values and plain words in its slot and one more; an
identifier's belief is 1 less the product of (1 - confidence) over its
patterns of at least ``STRONG`` confidence.  Identifiers whose belief reaches
``STRONG`` are unseen personal data; all their contexts induce patterns as
seeds do, for ``ROUNDS`` rounds, each one reading of the documents.

The pattern set reaches the tasks as a bitmap of bounded size; the exact join
is on the stored tables.  Plain words are added up in the tasks, so a pattern
in a third of all rows sends one row a task.

Spans are in code points, the end exclusive.  Added spans carry the kind with
``_context`` behind it; of added spans that overlap, the first stays, and none
overlaps a base span.  Defined cases: NULL text is empty; repeated rows get
the same result each, NULL ids are ids like others; other columns are
ignored; a text is read whole, its working arrays grow with it (about 30
bytes a byte); an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyho.llm.bitmaps import bitmap
from tallyho.llm.components import saved
from tallyho.llm.hashing import mix, stream
from tallyho.llm.wordscan import Words, byte_set, scanned

KINDS = ("email", "ip", "card", "phone")
SUPPORT = 3
STRONG = 0.6
STEPS = 3
ROUNDS = 2
ROOM = 1024  # bits for each pattern, so one context in a thousand is taken for a pattern and sent on
BUFFER = 1 << 19  # patterns whose plain words a task adds up before they go on
LETTERS = byte_set(range(0x30, 0x3A), range(0x41, 0x5B), range(0x61, 0x7B), range(0x80, 0x100))
_U = np.uint64
_PLACE, _FORM = stream(51, 3) | _U(1), stream(52, 3)

# ── base spans ──────────────────────────────────────────────────────────────

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_NUMBERS = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """An ``@`` with the run of local characters before it: no other run can match, so each character is read a bounded number of times."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            last = domain.end()
            yield start, last
        at = text.find("@", max(last, at + 1))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Each four numbers of a chain of numbers joined by full stops."""
    for chain in _NUMBERS.finditer(text):
        if chain[0].count(".") < 3:
            continue
        parts, at = chain[0].split("."), chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in four):
                yield at, end
            at = end + 1


def _luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                yield m.span()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(place of the kind, start, end), by kind, then start."""
    return [(k, a, b) for k, find in enumerate((emails, addresses, cards, phones)) for a, b in find(text)]


# ── contexts ────────────────────────────────────────────────────────────────


class Lexed:
    """The words of a chunk of whole rows: their hashes, and their places in code points of their row."""

    def __init__(self, w: Words):
        self.w = w
        hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, w.distinct.to_pylist()), dtype=np.uint64, count=len(w.distinct))
        self.hash = hashed[w.codes]
        total = np.concatenate((np.zeros(1, np.int64), np.cumsum((w.data & 0xC0) != 0x80, dtype=np.int64)))
        base = total[w.bounds[:-1]][w.rows - w.first]
        self.starts, self.ends = total[w.starts] - base, total[w.ends] - base
        self.firsts = np.searchsorted(w.rows, np.arange(w.first, w.first + len(w.bounds)))  # the first word of each row, and the end

    def _pattern(self, form: int, *words: np.ndarray) -> np.ndarray:
        return mix(sum((self.hash[x] * _PLACE[i] for i, x in enumerate(words)), _FORM[form]))

    def contexts(self, before: np.ndarray, behind: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For slots with word ``before`` - 1 in front and word ``behind`` next, in rows of words lo to hi: (slot, pattern) of every pattern that the row has room for."""
        slots, patterns = [], []
        for form, (least, words) in enumerate(((2, lambda s: (before[s] - 2, before[s] - 1)), (3, lambda s: (before[s] - 3, before[s] - 2, before[s] - 1)), (1, lambda s: (before[s] - 1, behind[s])))):
            some = np.flatnonzero((before - lo >= least) & ((form != 2) | (behind < hi)))
            slots.append(some)
            patterns.append(self._pattern(form, *words(some)))
        return np.concatenate(slots), np.concatenate(patterns)


def _digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode(), digest_size=16).digest()


_BASE = "doc_id long, digest binary, spans array<struct<kind: int, start: long, end: long>>, contexts array<struct<kind: int, pattern: long, value: string>>"
_ARROW_BASE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("digest", pa.binary()),
        ("spans", pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))),
        ("contexts", pa.list_(pa.struct([("kind", pa.int32()), ("pattern", pa.int64()), ("value", pa.string())]))),
    ]
)


def _slots(lexed: Lexed, row: int, spans: list[tuple[int, int]]) -> tuple[np.ndarray, ...]:
    """before, behind, lo, hi of spans (start, end) of one row."""
    lo, hi = int(lexed.firsts[row - lexed.w.first]), int(lexed.firsts[row - lexed.w.first + 1])
    before = lo + np.searchsorted(lexed.ends[lo:hi], [a for a, _ in spans], side="right")
    behind = lo + np.searchsorted(lexed.starts[lo:hi], [b for _, b in spans], side="left")
    return before, behind, np.full(len(spans), lo), np.full(len(spans), hi)


def _seeded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The base spans of every row, and the patterns they induce."""
    for batch in batches:
        texts = batch.column(1).fill_null("")
        for w in _whole_rows(texts):
            lexed, out = Lexed(w), []
            for row in range(w.first, w.first + len(w.bounds) - 1):
                text = texts[row].as_py()
                spans = base_spans(text)
                contexts = []
                if spans:
                    slots, patterns = lexed.contexts(*_slots(lexed, row, [s[1:] for s in spans]))
                    own = zip((spans[i] for i in slots.tolist()), patterns.view(np.int64).tolist(), strict=True)
                    contexts = [{"kind": k, "pattern": p, "value": v} for k, p, v in {(k, p, text[a:b].lower()) for (k, a, b), p in own}]
                out.append({"doc_id": batch.column(0)[row].as_py(), "digest": _digest(text), "spans": [{"kind": k, "start": a, "end": b} for k, a, b in spans], "contexts": contexts})
            yield pa.RecordBatch.from_pylist(out, schema=_ARROW_BASE)


def _whole_rows(texts: pa.Array) -> Iterator[Words]:
    return scanned(texts, LETTERS, None, 2 << 20)


# ── identifiers in the slots of patterns ────────────────────────────────────

_FILLS = "pattern long, value string, plain long, doc_id long, digest binary, start long, end long, contexts array<long>"
_ARROW_FILLS = pa.schema(
    [("pattern", pa.int64()), ("value", pa.string()), ("plain", pa.int64()), ("doc_id", pa.int64()), ("digest", pa.binary()), ("start", pa.int64()), ("end", pa.int64()), ("contexts", pa.list_(pa.int64()))]
)
_BLANK = byte_set(0x20, range(0x09, 0x0E))
_OPENING = byte_set(0x20, range(0x09, 0x0E), *b"([{<\"'=:,;|#+@")
_TOKEN = re.compile(r"\S+(?: [0-9][0-9().-]*+(?![^\s,;:!?]))*+")
_BEHIND = ".,;:!?)]}\"'>|"


def identifier(text: str, start: int) -> tuple[int, int] | None:
    """The identifier that begins with the word at ``start``: its token without the punctuation behind it, and digit groups that follow."""
    if start and text[start - 1] in "+@#":
        start -= 1
    value = _TOKEN.match(text, start)[0].rstrip(_BEHIND)
    digits = [sum("0" <= c <= "9" for c in part) for part in value.split(" ")]
    return (start, start + len(value)) if "@" in value or digits[0] and sum(digits) >= 3 else None


def _candidates(w: Words, words: np.ndarray) -> np.ndarray:
    """Which of some words begin a token, or a part of one behind an opening sign, with an ``@`` or three digits in reach."""
    n = len(w.data)
    digits = np.concatenate((np.zeros(1, np.int64), np.cumsum((w.data >= 0x30) & (w.data < 0x3A), dtype=np.int64)))
    signs = np.concatenate((np.zeros(1, np.int64), np.cumsum(w.data == 0x40, dtype=np.int64)))
    blank = np.append(np.flatnonzero(_BLANK[w.data]), n)
    ends = np.minimum(blank[np.searchsorted(blank, w.starts[words])], w.bounds[1:][w.rows[words] - w.first])
    first = w.starts[words]
    at_row = first == w.bounds[:-1][w.rows[words] - w.first]
    opened = at_row | _OPENING[w.data[np.maximum(first - 1, 0)]]
    before = np.maximum(first - 1, 0)  # a sign just before the word belongs to it
    few = digits[ends] - digits[first]
    # Digit groups behind a token of digits count with it.
    return opened & ((few >= 3) | (signs[ends] - signs[before] > 0) | ((few > 0) & (digits[np.minimum(ends + 24, n)] - digits[first] >= 3)))


def _filled(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        sums: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            texts = batch.column(1).fill_null("")
            for w in _whole_rows(texts):
                lexed = Lexed(w)
                every = np.arange(len(w.rows))
                row = w.rows - w.first
                slots, patterns = lexed.contexts(every, every + 1, lexed.firsts[row], lexed.firsts[row + 1])
                hit = known.holds(patterns)
                slots, patterns = slots[hit], patterns[hit]
                words = np.unique(slots)
                likely = words[_candidates(w, words)] if len(words) else words
                out, taken = [], []
                for r in np.unique(w.rows[likely]).tolist():
                    text = texts[r].as_py()
                    base = sorted((a, b) for _, a, b in base_spans(text))
                    own = likely[w.rows[likely] == r]
                    for j in own.tolist():
                        found = identifier(text, int(lexed.starts[j]))
                        inside = _overlaps(base, *(found or (int(lexed.starts[j]), int(lexed.ends[j]))))
                        if found or inside:
                            taken.append(j)  # not plain text
                        if found and not inside:
                            out.append((r, found, j))
                yield from _identifiers(batch, texts, lexed, out, slots, patterns)
                base_words = _base_words(texts, lexed, words)
                plain = ~np.isin(slots, np.concatenate((np.array(taken, dtype=np.int64), base_words)))
                sums.append(np.unique(patterns[plain], return_counts=True))
                if sum(len(x) for x, _ in sums) > BUFFER:
                    sums = [_added(sums)]
                    if len(sums[0][0]) > BUFFER // 2:
                        yield _plain(*sums.pop())
        if sums:
            yield _plain(*_added(sums))

    return run


def _added(sums: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    patterns, inverse = np.unique(np.concatenate([x for x, _ in sums]), return_inverse=True)
    return patterns, np.bincount(inverse, np.concatenate([n for _, n in sums]), len(patterns)).astype(np.int64)


def _plain(patterns: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(patterns.view(np.int64)), pa.nulls(len(n), pa.string()), pa.array(n, pa.int64()), *(pa.nulls(len(n), f.type) for f in list(_ARROW_FILLS)[3:])], schema=_ARROW_FILLS)


def _overlaps(base: list[tuple[int, int]], start: int, end: int) -> bool:
    """``base``: spans in order; those of different kinds may overlap each other, so a few before are looked at too."""
    i = bisect_right(base, (end - 1, 1 << 62))
    return any(a < end and start < b for a, b in base[max(0, i - 8) : i])


def _base_words(texts: pa.Array, lexed: Lexed, words: np.ndarray) -> np.ndarray:
    """Those of ``words`` that begin within a base span."""
    w, out = lexed.w, [np.zeros(0, dtype=np.int64)]
    marked = np.flatnonzero(_marks(w))
    for r in np.unique(np.searchsorted(w.bounds, marked, side="right") - 1).tolist() if len(marked) else []:
        spans = base_spans(texts[r + w.first].as_py())
        if spans:
            lo, hi = np.searchsorted(words, lexed.firsts[r : r + 2])
            own = words[lo:hi]
            begin = lexed.starts[own]
            inside = np.zeros(len(own) + 1, dtype=np.int64)
            np.add.at(inside, np.searchsorted(begin, [a for _, a, _ in spans]), 1)
            np.add.at(inside, np.searchsorted(begin, [b for _, _, b in spans]), -1)
            out.append(own[np.cumsum(inside)[:-1] > 0])
    return np.concatenate(out)


def _marks(w: Words) -> np.ndarray:
    """Bytes without which a row has no base span: an ``@``, or a digit beside a digit or a full stop."""
    digit = (w.data >= 0x30) & (w.data < 0x3A)
    marks = w.data == 0x40
    marks[1:] |= digit[1:] & (digit[:-1] | (w.data[:-1] == 0x2E) | (w.data[:-1] == 0x2B))
    return marks


def _identifiers(batch: pa.RecordBatch, texts: pa.Array, lexed: Lexed, found: list[tuple], slots: np.ndarray, patterns: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row for each identifier and known pattern around it, with all of its contexts."""
    order = np.argsort(slots, kind="stable")
    slots, patterns = slots[order], patterns[order].view(np.int64)
    rows = []
    for r, (a, b), j in found:
        text = texts[r].as_py()
        around = lexed.contexts(*_slots(lexed, r, [(a, b)]))[1].view(np.int64).tolist()
        key = {"value": text[a:b].lower(), "plain": 0, "doc_id": batch.column(0)[r].as_py(), "digest": _digest(text), "start": a, "end": b, "contexts": around}
        lo, hi = np.searchsorted(slots, [j, j + 1])
        rows += [{"pattern": p, **key} for p in sorted({*patterns[lo:hi].tolist(), *around})]
    yield pa.RecordBatch.from_pylist(rows, schema=_ARROW_FILLS)


# ── the graph ───────────────────────────────────────────────────────────────


def _induced(seeds: DataFrame) -> DataFrame:
    """Patterns that enough different values of one kind induced."""
    return seeds.groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= SUPPORT).select("pattern").distinct()


def scored(seeds: DataFrame, fills: DataFrame, steps: int = STEPS) -> tuple[DataFrame, DataFrame]:
    """(strong patterns: pattern, kind, confidence; beliefs: value, kind, belief).

    ``seeds``: distinct (kind, pattern, value); ``fills``: (pattern, value or
    NULL, plain) of the patterns' slots.
    """
    found = saved(fills.where("value IS NOT NULL").select("pattern", "value").distinct(), "identifiers")
    values = seeds.select("pattern", "value").union(found).distinct().groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    plain = fills.where("value IS NULL").groupBy("pattern").agg(F.sum("plain").alias("n"))
    # Only patterns that were looked for have their plain words counted.
    sizes = saved(values.union(plain).groupBy("pattern").agg(F.sum("n").alias("size")), "pattern-sizes")
    sure = seeds.groupBy("pattern", "kind").agg(F.count(F.lit(1)).cast("double").alias("s"))
    looked = _induced(seeds)
    belief = None
    for _ in range(steps):
        support = sure if belief is None else sure.union(found.join(belief, "value").groupBy("pattern", "kind").agg(F.sum("belief").alias("s"))).groupBy("pattern", "kind").agg(F.sum("s").alias("s"))
        confident = support.join(looked, "pattern", "left_semi").join(sizes, "pattern").withColumn("confidence", F.col("s") / (F.col("size") + 1))
        strong = saved(confident.where(F.col("confidence") >= STRONG).select("pattern", "kind", "confidence"), "strong-patterns")
        doubt = found.join(strong, "pattern").groupBy("value", "kind").agg(F.sum(F.log1p(-F.col("confidence"))).alias("doubt"))
        belief = saved(doubt.select("value", "kind", (1 - F.exp("doubt")).alias("belief")), "beliefs")
    return strong, belief


def discovered(docs: DataFrame, base: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, digest, kind, start, end of unseen identifiers. ``base``: the stored rows of the seeds."""
    spark = docs.sparkSession
    seeds = base.select(F.explode("contexts").alias("c")).select("c.kind", "c.pattern", "c.value").distinct()
    spans = None
    for _ in range(rounds):
        seeds = saved(seeds, "seeds")
        patterns = saved(_induced(seeds), "patterns")
        shared = spark.sparkContext.broadcast(bitmap(patterns, patterns.count(), ROOM))
        fills = saved(docs.mapInArrow(_filled(shared), _FILLS).join(patterns, "pattern", "left_semi"), "fills")
        shared.destroy()
        strong, belief = scored(seeds, fills)
        sure = belief.where(F.col("belief") >= STRONG)
        spans = saved(fills.where("value IS NOT NULL").join(strong, "pattern").join(sure, ["value", "kind"]), "spans")
        seeds = seeds.union(spans.select("kind", F.explode("contexts").alias("pattern"), "value")).distinct()
    best = spans.groupBy("doc_id", "digest", "start", "end").agg(F.max_by("kind", F.struct("belief", -F.col("kind"))).alias("kind"))
    before = Window.partitionBy("doc_id", "digest").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    return best.withColumn("reach", F.max("end").over(before)).where("reach IS NULL OR reach <= start").select("doc_id", "digest", "kind", "start", "end")


def detected(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, base and added of every row: arrays of (kind, start, end), ``kind`` the place in ``KINDS``."""
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    base = saved(texts.mapInArrow(_seeded, _BASE), "base-spans")
    found = discovered(texts, base, rounds).groupBy("doc_id", "digest").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "end"))).alias("added"))
    rows = base.select("doc_id", "digest", "spans")
    # Equal rows have an equal key and an equal result; few rows have any.
    joined = rows.alias("r").join(found.alias("f"), F.col("r.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("r.digest") == F.col("f.digest")), "left")
    none = F.array().cast("array<struct<kind: int, start: long, end: long>>")
    return joined.select("r.doc_id", F.col("r.spans").alias("base"), F.coalesce("f.added", none).alias("added"))


def span_text(spans: Column, suffix: str = "") -> Column:
    """kind:start:end, comma-joined, in the order of the array."""
    names = F.array(*(F.lit(k + suffix) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
