"""Item log: the single values behind a check's result.

One row per failing group of a parts check, per missing required value and
per new value, numbered within its check, so that a run's items can be stored
next to its log rows and read back in order.  Nothing is concatenated without
bound: ``item_texts`` joins at most ``chunk`` items to a text and gives as
many texts as there are chunks.

Numbering scales with the groups of one check: all items are sorted by range
over the cluster, each sorted part numbers its own rows, and only the parts'
row counts (one row a part and check) are added up in order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyho.functions import messages as M
from tallyho.functions.scoring import round2_sql
from tallyho.operators import checks as C
from tallyho.operators.base import Base
from tallyho.operators.base import str_literal as L
from tallyho.session import scratch_path

FAILING, MISSING, NEW = "failing_group", "missing_value", "new_value"
CHUNK = 100
_CHECK = ["dashboard", "run_week", "check_seq", "check_name", "metric", "item_kind"]
ITEM_COLUMNS = [*_CHECK, "position", "item", "expected_num", "actual_num", "gap_pct", "text"]
ITEM_SCHEMA = (
    "run_id string, run_timestamp string, dashboard string, run_week string, check_seq int, check_name string, metric string, "
    "item_kind string, position long, item string, expected_num double, actual_num double, gap_pct double, text string"
)


def _unnumbered(spark: SparkSession, base: Base) -> DataFrame | None:
    """Items with what orders them: ``place`` for missing values, else the value itself, NULL last."""
    frames = []
    compared = C.parts_compare(spark, base)
    if compared is not None:
        text = f"format_string({L(M.PARTS_ITEM)}, coalesce(pivot_value, 'None'), source_total, dashboard_total, gap_pct)"
        frames.append(
            compared.where("is_failing").selectExpr(
                "dashboard", "run_week", "check_seq", "'parts_sum' AS check_name", "concat(metric, '_by_', pivot) AS metric", f"'{FAILING}' AS item_kind", "0 AS place", "pivot_value AS item",
                f"{round2_sql('source_total')} AS expected_num", f"{round2_sql('dashboard_total')} AS actual_num", f"{round2_sql('gap_pct')} AS gap_pct", f"{text} AS text",
            )
        )
    values = C.completeness_values(spark, base)
    if values is not None:
        for kind, place, df in ((MISSING, "pos", values[0]), (NEW, "0", values[1])):
            none = "CAST(NULL AS DOUBLE)"
            frames.append(
                df.selectExpr(
                    "dashboard", "run_week", "check_seq", "'completeness' AS check_name", "concat(dimension, '_completeness') AS metric", f"'{kind}' AS item_kind", f"{place} AS place", "value AS item",
                    f"{none} AS expected_num", f"{none} AS actual_num", f"{none} AS gap_pct", "coalesce(value, 'None') AS text",
                )
            )
    return reduce(DataFrame.unionByName, frames) if frames else None


def run_items(spark: SparkSession, base: Base) -> DataFrame:
    """Every item of every run in ``ITEM_COLUMNS``; an empty frame if no check itemises."""
    items = _unnumbered(spark, base)
    if items is None:
        return spark.createDataFrame([], ITEM_SCHEMA).select(*ITEM_COLUMNS)
    order = ["place", "unset", "item"]
    # A stored global sort: parts of equal size, however many items one check has.
    path = scratch_path(spark, "items")
    items.withColumn("unset", F.col("item").isNull()).orderBy(*_CHECK, *order).withColumn("part", F.spark_partition_id()).write.parquet(path)
    stored = spark.read.parquet(path)
    sizes = stored.groupBy(*_CHECK, "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(*_CHECK).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    own = F.row_number().over(Window.partitionBy(*_CHECK, "part").orderBy(*order))
    return stored.withColumn("own", own).join(offsets, [*_CHECK, "part"]).withColumn("position", F.col("own") + F.col("offset")).select(*ITEM_COLUMNS)


def item_texts(items: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The items of each check as ordered texts of at most ``chunk`` items: chunk (from 0), n_items, text."""
    numbered = items.withColumn("chunk", F.expr(f"(position - 1) div {int(chunk)}"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "text"))), lambda x: x["text"]), "; ")
    return numbered.groupBy(*_CHECK, "chunk").agg(F.count(F.lit(1)).alias("n_items"), joined.alias("text"))


def item_rows(items: DataFrame, run_timestamp: str) -> DataFrame:
    """Items with the fields of their run, as the item log holds them."""
    ts = F.lit(run_timestamp)
    return items.select(F.concat_ws("_", "dashboard", "run_week", ts).alias("run_id"), ts.alias("run_timestamp"), *ITEM_COLUMNS)


def append_items(rows: DataFrame, path: str) -> None:
    """Writes the items of runs next to their log, a folder for each run; a repeated write of a run replaces it."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dashboard", "run_id").parquet(path)


def read_items(spark: SparkSession, path: str) -> DataFrame:
    schema = spark.createDataFrame([], ITEM_SCHEMA).schema
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
