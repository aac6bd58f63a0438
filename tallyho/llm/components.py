"""Connected components of an edge table, by alternating large-star and small-star rounds.

Each round is two grouped minima joined back on the node, written to the
shared scratch folder, so lineage stays short and a lost executor costs one
round at most.  A node with very many neighbours is never gathered in one
place: its minimum is combined map-side, and the join back is an equi-join
that adaptive execution may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyho.session import scratch_path


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return least.select("u", F.col("m").alias("v")).union(moved).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (id, root): the smallest id reachable, for every id that has an edge to another id.

    Rows with a NULL end or two equal ends are no links.  An empty table gives
    an empty table; repeated and reversed edges change nothing.
    """
    now = saved(edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v"), "edges")
    state = None
    while True:
        now = saved(_small_star(_large_star(now)), "stars")
        row = now.agg(F.count(F.lit(1)), F.sum(F.col("v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(row) == state:
            return now.select(F.col("u").alias("id"), F.col("v").alias("root")).union(now.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())
        state = tuple(row)


def row_keyed(docs: DataFrame, column: str = "__row_key") -> DataFrame:
    """``docs`` with a key of its own for each row, in the order of doc_id (NULL last).

    The key is doc_id where that is unique and not NULL; else the rows are
    sorted and stored with a number, so a reread gives the same keys.
    """
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if ids.where("n > 1 OR doc_id IS NULL").isEmpty():
        return docs.withColumn(column, F.col("doc_id").cast("long"))
    ordered = docs.withColumn(column, F.monotonically_increasing_id()).orderBy(F.asc_nulls_last("doc_id"), column)
    return saved(ordered.withColumn(column, F.monotonically_increasing_id()), "row-keyed")
