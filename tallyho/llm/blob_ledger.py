"""Secret scans over every historical version, kept in a blob ledger.

A version's content is a blob, addressed by its SHA-256.  The ledger is a
Parquet folder with one row per (blob, rule kind, rule version): the spans
that the rule found there, none included.  A scan groups the versions' texts
by blob, takes away the pairs that the ledger knows, runs each remaining rule
on each remaining blob once, appends the new rows, and joins findings back to
all paths by blob.  A new rule version scans old blobs again; a new path to
an old blob scans nothing.

Only DataFrame functions run here.  Spans come from the texts between and of
the matches, both by the same regular expression: their lengths in code
points add up to the places.

A blob that a third of the paths share is combined map-side when blobs are
gathered, and adaptive execution splits its paths in the join back.  Rows
appended twice by a repeated write change nothing: rows are read distinct.

Defined cases: NULL text is the empty blob; NULL paths are paths like others;
repeated rows give repeated results; extra columns are carried along; an
empty table gives an empty table and an unchanged ledger.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPAN = "struct<start: bigint, end: bigint>"
LEDGER = f"blob string, kind string, rule_version int, spans array<{SPAN}>"


@dataclass(frozen=True)
class Rule:
    """``least``: the shortest length of ``group`` that counts."""

    kind: str
    pattern: str
    version: int = 1
    group: int = 0
    least: int = 0

    @property
    def key(self) -> str:
        return f"{self.kind}:{self.version}"


#: The base rules.  A run of hex digits or of an access key is greedy, so its least length may
#: stand in the pattern; the value of an assignment may not, for a failing match still uses up its text.
BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=2, least=6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: What the ledger scans besides: private key headers and bearer credentials.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----"),
    Rule("bearer", r"Bearer\x20+[A-Za-z0-9+/_.=~-]{20,}"),
)


def rule_spans(text: Column, rule: Rule) -> Column:
    """Leftmost non-overlapping matches of a rule as (start, end) in code points."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    between = F.split(text, rule.pattern, -1)
    group = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    # Running totals by one fold; then each match's place.
    steps = F.arrays_zip(F.transform(between, F.char_length).alias("gap"), F.transform(found, F.char_length).alias("size"), F.transform(group, F.char_length).alias("value"))
    empty = F.array().cast("array<struct<start: bigint, end: bigint, value: int>>")
    start = lambda acc, x: acc["at"] + x["gap"]
    end = lambda acc, x: acc["at"] + x["gap"] + F.coalesce(x["size"], F.lit(0))
    fold = F.aggregate(
        steps,
        F.struct(F.lit(0).cast("bigint").alias("at"), empty.alias("out")),
        lambda acc, x: F.struct(
            end(acc, x).alias("at"),
            F.when(x["size"].isNull(), acc["out"]).otherwise(F.array_append(acc["out"], F.struct(start(acc, x).alias("start"), end(acc, x).alias("end"), x["value"].alias("value")))).alias("out"),
        ),
        lambda acc: acc["out"],
    )
    kept = F.transform(F.filter(fold, lambda s: s["value"] >= rule.least), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    none = F.array().cast(f"array<{SPAN}>")
    return F.when(F.rlike(text, F.lit(rule.pattern)), kept).otherwise(none)


def _ledger(spark: SparkSession, folder: str) -> DataFrame | None:
    try:
        return spark.read.schema(LEDGER).parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def scan(versions: DataFrame, folder: str, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES, text: str = "text") -> DataFrame:
    """Scans the unseen (blob, rule version) pairs of ``versions``, appends them to the ledger in
    ``folder``, and returns the ledger's rows of these rules: blob, and one array of spans per kind."""
    spark = versions.sparkSession
    blobs = versions.select(blob_of(text).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("body")).groupBy("blob").agg(F.first("body").alias("body"))
    todo = F.array(*(F.lit(r.key) for r in rules))
    known = _ledger(spark, folder)
    if known is not None:
        seen = known.groupBy("blob").agg(F.collect_set(F.concat_ws(":", "kind", "rule_version")).alias("seen"))  # at most one per rule
        blobs = blobs.join(seen, "blob", "left")
        todo = F.when(F.col("seen").isNull(), todo).otherwise(F.array_except(todo, "seen"))
    unseen = blobs.withColumn("todo", todo).where("size(todo) > 0")
    results = F.array(*(F.when(F.array_contains("todo", r.key), F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("rule_version"), rule_spans(F.col("body"), r).alias("spans"))) for r in rules))
    unseen.select("blob", F.explode(results).alias("r")).where("r IS NOT NULL").select("blob", "r.kind", "r.rule_version", "r.spans").write.mode("append").parquet(folder)
    wanted = spark.read.schema(LEDGER).parquet(folder).where(F.concat_ws(":", "kind", "rule_version").isin([r.key for r in rules]))
    return wanted.groupBy("blob").agg(*(F.first(F.when(F.col("kind") == r.kind, F.col("spans")), ignorenulls=True).alias(r.kind) for r in rules))


def blob_of(text: str = "text") -> Column:
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


def findings(versions: DataFrame, folder: str, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` (all, if none are named) of every version, its blob, and ``found``:
    an array of (start, rank of the rule, kind, end) in that order."""
    ledger = scan(versions, folder, rules, text)
    none = F.array().cast(f"array<{SPAN}>")
    all_ = F.flatten(F.array(*(_ranked(F.coalesce(F.col(f"l.`{r.kind}`"), none), i, r.kind) for i, r in enumerate(rules))))
    paths = versions.select(*(carry or versions.columns), blob_of(text).alias("__blob"))
    joined = paths.alias("p").join(ledger.alias("l"), F.col("p.__blob") == F.col("l.blob"), "left")
    return joined.select(*(F.col(f"p.`{c}`") for c in carry or versions.columns), F.col("p.__blob").alias("blob"), F.array_sort(all_).alias("found"))


def _ranked(spans: Column, rank: int, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def joined_spans(found: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.concat_ws(",", F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def redacted(text: Column, found: Column, mark: str = "[SECRET]") -> Column:
    """The text with every found span replaced; spans that overlap become one."""
    state = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    piece = lambda a, b: F.substring(text, (a + 1).cast("int"), (b - a).cast("int"))
    fold = F.aggregate(
        found,
        state,
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] < acc["at"], acc["out"]).otherwise(F.concat(acc["out"], piece(acc["at"], s["start"]), F.lit(mark))).alias("out"),
        ),
        lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.char_length(text))),
    )
    return F.when(F.size(found) > 0, fold).otherwise(text)
