"""I-Match document fingerprints.

Terms (runs of letters and digits, lower-cased) are hashed to ``1 << BITS``
slots, so the document frequencies of any corpus are a table of bounded size.
The lexicon keeps the slots whose document frequency lies within a band of
inverse document frequency.  The band bounds it whatever the corpus: terms in
at least a share s of the documents number at most (terms of a mean document)
/ s.  A document's sorted distinct lexicon terms are hashed for ``SUBSETS`` randomised subsets of the
lexicon.  Each subset is nested in thinner ones (halved from level to level),
and a document uses the three levels at which one or two, or fewer, of its
terms remain on average, so a
long text is as tolerant to an edit as a short one.

A fingerprint lists subset.level:hash of each subset that holds any of its
terms.  Likeness is the share of equal hashes among the subsets, at levels
both documents use, that hold terms of either.

Only DataFrame functions run here.  The text is shuffled once, by ranges of
doc_id, for the neighbour's text.

Defined cases: NULL text is empty; a document without lexicon terms has the
hash of its text as its fingerprint, like itself only; order is by doc_id
(NULL first), then text, and the row after the last is the first; extra
columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyho.llm.components import saved

BITS = 22
LEAST_SHARE, MOST_SHARE = 0.005, 0.1
SUBSETS = 12
LEVELS = 3
BUCKET_ROWS = 2000
_QUANTILES = 64


def terms(text: Column) -> Column:
    """The distinct slots of a text's terms."""
    words = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")
    return F.array_distinct(F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(1 << BITS)).cast("int")))


def lexicon(docs: DataFrame, least: float = LEAST_SHARE, most: float = MOST_SHARE) -> DataFrame:
    """One row, ``slots``: sorted, those with a document frequency of at least max(2, least * N) and at most max(2, most * N)."""
    n = docs.count()
    low, high = max(2, math.ceil(least * n)), max(2, math.floor(most * n))
    slots = docs.select(F.explode(terms(F.col("text"))).alias("slot")).groupBy("slot").agg(F.count(F.lit(1)).alias("df")).where(f"df BETWEEN {low} AND {high}")
    return saved(slots.agg(F.array_sort(F.collect_list("slot")).alias("slots")), "lexicon")


def kept_terms(text: Column, slots: Column) -> Column:
    """The sorted distinct lexicon terms of a text: the lexicon's order is kept."""
    return F.array_intersect(slots, terms(text))


def level_of(kept: Column) -> Column:
    """The level at which one or two of the kept terms remain on average."""
    return F.floor(F.log2(F.size(kept))).cast("int")


def with_fingerprint(df: DataFrame, text: str, slots: Column, name: str, subsets: int = SUBSETS) -> DataFrame:
    """``df`` with the fingerprint of a text column; NULL where that is NULL."""
    columns = df.columns
    df = df.withColumn("__kept", F.when(F.col(text).isNotNull(), kept_terms(F.col(text), slots))).withColumn("__level", level_of(F.col("__kept")))
    # The masks are columns of their own: lambdas read them for every term.
    mask = [F.call_function("shiftleft", F.lit(1).cast("long"), F.col("__level") + by) - 1 for by in range(LEVELS)]
    df = df.withColumns({f"__mask_{by}": m for by, m in enumerate(mask)})

    def thinner(terms: Column | str, r: Column, by: int) -> Column:
        return F.filter(terms, lambda t: F.xxhash64(t, r).bitwiseAND(F.col(f"__mask_{by}")) == 0)

    def entry(terms: Column, r: Column, by: int) -> Column:
        return F.when(F.size(terms) > 0, F.concat(r.cast("string"), F.lit("."), (F.col("__level") + by).cast("string"), F.lit(":"), F.lower(F.hex(F.xxhash64(terms)))))

    widest = F.transform(F.sequence(F.lit(0), F.lit(subsets - 1)), lambda r: thinner("__kept", r, 0))
    df = df.withColumn("__widest", widest)
    entries = F.flatten(F.transform("__widest", lambda terms, r: F.array(*(entry(thinner(terms, r, by), r, by) for by in range(LEVELS)))))
    body = F.concat(F.lit("L"), F.col("__level").cast("string"), F.lit(";"), F.concat_ws(",", entries))
    whole = F.when(F.size("__kept") > 0, body).otherwise(F.concat(F.lit("T;"), F.sha2(text, 256)))
    return df.select(*columns, F.when(F.col(text).isNotNull(), whole).alias(name))


def with_likeness(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """``df`` with the likeness, 0 to 1, of two fingerprint columns; fingerprints that are equal are alike."""
    columns = df.columns
    level = lambda f: F.regexp_extract(f, r"^L(-?\d+);", 1).try_cast("int")
    df = df.withColumns({"__a": level(F.col(a)), "__b": level(F.col(b))})
    # Columns of their own: lambdas read them for every entry.
    df = df.withColumns({"__low": F.greatest("__a", "__b"), "__high": F.least("__a", "__b") + (LEVELS - 1)})
    body = lambda f: F.split(F.substring_index(f, ";", -1), ",")
    at = lambda t: F.substring_index(t, ":", 1)
    shared = lambda f: F.filter(F.transform(body(f), at), lambda k: F.substring_index(k, ".", -1).try_cast("int").between(F.col("__low"), F.col("__high")))
    df = df.withColumn("__either", F.size(F.array_union(shared(F.col(a)), shared(F.col(b)))))
    equal = F.size(F.array_intersect(body(F.col(a)), body(F.col(b))))
    alike = F.when(F.col(a) == F.col(b), F.lit(1.0)).when(F.col("__a").isNull() | F.col("__b").isNull() | (F.col("__either") == 0), F.lit(0.0)).otherwise(equal / F.col("__either"))
    return df.select(*columns, alike.alias(name))


def _bucketed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``bucket``: ascending ranges of doc_id of about BUCKET_ROWS rows, from quantiles and even steps between them."""
    row = docs.agg(F.count(F.lit(1)), F.percentile_approx("doc_id", [i / _QUANTILES for i in range(_QUANTILES + 1)], 10_000)).first()
    n, bounds = row[0], row[1] or [0] * (_QUANTILES + 1)
    steps = max(1, math.ceil(n / _QUANTILES / BUCKET_ROWS))
    widths = [max(1, -(-(b - a) // steps)) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    q = F.size(F.filter(F.array(*map(F.lit, bounds[1:-1])), lambda b: F.col("doc_id") >= b))
    at = lambda values: F.get(F.array(*(F.lit(v).cast("long") for v in values)), F.col("q"))
    placed = docs.withColumn("q", q).withColumn("step", F.greatest(F.lit(0).cast("long"), F.floor((F.col("doc_id") - at(bounds[:-1])) / at(widths))))
    return placed.withColumn("bucket", F.coalesce(F.col("q") * F.lit(1 << 32) + F.least("step", F.lit((1 << 32) - 1)), F.lit(-1).cast("long"))).drop("q", "step")


def fingerprints(docs: DataFrame, least: float = LEAST_SHARE, most: float = MOST_SHARE) -> DataFrame:
    """doc_id, text, fingerprint of every row."""
    own = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    slots = lexicon(own, least, most).scalar()
    return with_fingerprint(own, "text", slots, "fingerprint").select("doc_id", "text", "fingerprint")


def edits(docs: DataFrame, least: float = LEAST_SHARE, most: float = MOST_SHARE) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, where the edited text has its last
    quarter (in code points, rounded down) replaced by the start of the next document."""
    own = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    slots = lexicon(own, least, most).scalar()
    ranged = _bucketed(own)
    order = Window.partitionBy("bucket").orderBy(F.asc_nulls_first("doc_id"), "text")
    placed = ranged.withColumn("next_text", F.lead("text").over(order)).withColumn("place", F.row_number().over(order))

    firsts = placed.where("place = 1").select("bucket", F.col("text").alias("first_text"))
    buckets = firsts.select("bucket")
    ring = Window.orderBy("bucket")  # one row per BUCKET_ROWS documents
    after = buckets.select("bucket", F.lead("bucket").over(ring).alias("after"), F.min("bucket").over(Window.partitionBy()).alias("first"))
    follow = after.select("bucket", F.coalesce("after", "first").alias("following")).join(firsts.withColumnRenamed("bucket", "following"), "following")
    follow = follow.select(F.col("bucket").alias("b"), "first_text")

    n = F.char_length("text")
    joined = placed.join(follow, (placed.bucket == follow.b) & placed.next_text.isNull(), "left")
    following = F.coalesce("next_text", "first_text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - quarter), F.substring(following, F.lit(1), quarter))
    texts = F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("body")), F.struct(F.lit(1).alias("which"), edited.alias("body")), F.struct(F.lit(2).alias("which"), F.col("first_text").alias("body")))
    rows = joined.select("bucket", "place", "doc_id", n.cast("long").alias("n_chars"), F.sha2(edited, 256).alias("edited_sha256"), F.explode(texts).alias("t"))
    rows = with_fingerprint(rows.select("*", "t.which", "t.body").drop("t").where("body IS NOT NULL"), "body", slots, "print").drop("body")
    # The rows of a document are still together: this needs no shuffle.
    pick = lambda which, name: F.max(F.when(F.col("which") == which, F.col("print"))).alias(name)
    rows = rows.groupBy("bucket", "place", "doc_id", "n_chars", "edited_sha256").agg(pick(0, "fingerprint"), pick(1, "edited_fingerprint"), pick(2, "first_fingerprint"))
    order = Window.partitionBy("bucket").orderBy("place")
    rows = rows.withColumn("next_fingerprint", F.coalesce(F.col("first_fingerprint"), F.lead("fingerprint").over(order)))
    rows = with_likeness(rows, "fingerprint", "edited_fingerprint", "near_edited")
    rows = with_likeness(rows, "fingerprint", "next_fingerprint", "near_next")
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
