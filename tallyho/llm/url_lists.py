"""URL filters by a temporal list join.

A list is a table of dated events: an entry is added to a list, or removed
from it, at some time.  Events become validity intervals (from an addition to
the entry's next event), and each capture is judged by the entries that were
active when it was fetched, not by today's list.

An entry is a host name; with scope ``domain`` it covers subdomains too.  A
capture is looked up by its host and each parent domain, so the join is an
equi-join on (name, month, salt): intervals are cut into the months they
touch, captures have one month, and a hot host's captures are dealt over
``salts`` keys with its few intervals repeated for each.  The interval test
finishes the as-of join.  Only DataFrame functions run here.

Captures are looked up by (key, host, fetch time), null-safely and once each:
several fetches of a page are judged each as of its own time, repeated rows
and rows without a key like any other, and every row stays.

Defined cases: a NULL url or fetch time, or a url without a host, matches
nothing and is kept; of an entry's events at one time a removal counts last;
repeated events count once; events with a NULL are ignored; extra columns of
captures are carried along, those of events ignored; empty tables are fine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 16
#: Fixed value: the host of a URL.
HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def host_of(url: Column) -> Column:
    """The lower-cased host, or NULL."""
    host = F.lower(F.regexp_extract(url, HOST, 1))
    return F.when(host != "", F.rtrim(host, F.lit(".")))


def intervals(events: DataFrame) -> DataFrame:
    """list_name, verdict, scope, name, active_from, active_to (NULL: still active) from dated
    events (list_name, verdict block or allow, scope host or domain, name, event add or remove, at)."""
    columns = ["list_name", "verdict", "scope", "name", "event", "at"]
    clean = events.select(*columns).dropna().withColumn("name", F.lower("name")).distinct()
    entry = Window.partitionBy("list_name", "verdict", "scope", "name").orderBy("at", "event")  # add comes before remove
    following = clean.withColumn("active_to", F.lead("at").over(entry))
    return following.where("event = 'add' AND (active_to IS NULL OR active_to > at)").selectExpr("list_name", "verdict", "scope", "name", "at AS active_from", "active_to")


def judged(captures: DataFrame, events: DataFrame, key: str = "page_id", url: str = "url", at: str = "fetched_at", salts: int = SALTS) -> DataFrame:
    """``captures`` and, as of each row's fetch time: host, n_active (entries that covered it), block_lists and
    allow_lists (names, sorted), blocked (covered by a block entry and by no allow entry)."""
    own = captures.withColumn("host", host_of(F.col(url)))
    last = own.agg(F.max(at)).first()[0]
    lookups = own.where(F.col("host").isNotNull() & F.col(at).isNotNull()).select(F.col(key).alias("of_key"), F.col("host").alias("of_host"), F.col(at).alias("fetched")).distinct()
    labels = F.split("of_host", r"\.")
    names = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.struct(F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("name"), (i == 1).alias("own")))
    looked = lookups.select("*", F.xxhash64("of_key", "fetched").alias("h"), F.explode(names).alias("n"))
    looked = looked.select("of_key", "of_host", "fetched", F.col("n.name").alias("name"), F.col("n.own").alias("own"), F.trunc("fetched", "month").alias("month"), F.pmod("h", F.lit(salts)).cast("int").alias("salt"))
    open_end = F.coalesce(F.col("active_to"), F.lit(last) if last is not None else F.col("active_from"))
    until = F.greatest(F.col("active_from"), open_end)
    months = F.sequence(F.trunc("active_from", "month"), F.trunc(until, "month"), F.expr("interval 1 month"))
    active = intervals(events).withColumn("month", F.explode(months)).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    hits = looked.join(active, ["name", "month", "salt"]).where("fetched >= active_from AND (active_to IS NULL OR fetched < active_to) AND (own OR scope = 'domain')")
    found = hits.groupBy("of_key", "of_host", "fetched").agg(  # a lookup meets at most one interval per entry of its host's names
        F.count(F.lit(1)).alias("n_active"),
        F.array_sort(F.collect_set(F.when(F.col("verdict") == "block", F.col("list_name")))).alias("block_lists"),
        F.array_sort(F.collect_set(F.when(F.col("verdict") == "allow", F.col("list_name")))).alias("allow_lists"),
    )
    none = F.array().cast("array<string>")
    found = found.withColumnsRenamed({c: f"found_{c}" for c in ("n_active", "block_lists", "allow_lists")})
    same = own[key].eqNullSafe(found["of_key"]) & (own["host"] == found["of_host"]) & (own[at] == found["fetched"])
    out = own.join(found, same, "left").select(own[key], *(own[c] for c in own.columns if c != key), *(found[f"found_{c}"].alias(c) for c in ("n_active", "block_lists", "allow_lists")))
    for c in ("block_lists", "allow_lists"):
        out = out.withColumn(c, F.coalesce(c, none))
    return out.withColumn("n_active", F.coalesce("n_active", F.lit(0))).withColumn("blocked", (F.size("block_lists") > 0) & (F.size("allow_lists") == 0))
