"""Run log: flat rows per check, append-only sink, latest-run and drift-frequency reads.

Grain of the log: one row per check of a run, with the run's fields repeated
on every row.  Reruns of a period are appended, never overwritten, so the
"latest run" of a period is a query over the log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyho.functions.scoring import DRIFT, FAIL

LOG_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("dashboard", T.StringType(), False),
        T.StructField("run_week", T.StringType(), False),
        T.StructField("run_timestamp", T.StringType(), False),
        T.StructField("overall_status", T.StringType(), False),
        T.StructField("check_name", T.StringType(), False),
        T.StructField("metric", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("severity", T.StringType(), True),
        T.StructField("expected", T.StringType(), True),
        T.StructField("actual", T.StringType(), True),
        T.StructField("gap", T.DoubleType(), True),
        T.StructField("tolerance", T.DoubleType(), True),
        T.StructField("detail", T.StringType(), True),
        T.StructField("triage_analysis", T.StringType(), True),
    ]
)
LOG_COLUMNS = [f.name for f in LOG_SCHEMA.fields]


def _status_rank(status):
    return F.when(status == FAIL, 2).when(status == DRIFT, 1).otherwise(0)


def log_rows(results: DataFrame, run_timestamp: str, triage: DataFrame | None = None, run_key: str | None = None) -> DataFrame:
    """Flatten check results into log rows (explicit schema, never inferred).

    The run id ends in the run's timestamp, or in ``run_key`` where a run must
    keep its id when it is repeated at another time.

    The overall status is a window over the checks of one run (bounded by the
    registry size), so no join back to a summary is needed.  ``triage``
    optionally supplies (dashboard, run_week, triage_analysis).
    """
    run = Window.partitionBy("dashboard", "run_week")
    worst = F.max(_status_rank(F.col("status"))).over(run)
    df = results.withColumn(
        "overall_status", F.when(worst == 2, F.lit(FAIL)).when(worst == 1, F.lit(DRIFT)).otherwise(F.lit("PASS"))
    )
    if triage is not None:
        df = df.join(triage.select("dashboard", "run_week", "triage_analysis"), ["dashboard", "run_week"], "left")
        analysis = F.coalesce(F.col("triage_analysis"), F.lit(""))
    else:
        analysis = F.lit("")
    ts = F.lit(run_timestamp)
    return df.select(
        F.concat_ws("_", F.col("dashboard"), F.col("run_week"), ts if run_key is None else F.lit(run_key)).alias("run_id"),
        "dashboard",
        "run_week",
        ts.alias("run_timestamp"),
        "overall_status",
        "check_name",
        "metric",
        "status",
        "severity",
        "expected",
        "actual",
        "gap",
        "tolerance",
        "detail",
        analysis.alias("triage_analysis"),
    )


def _ordered(df: DataFrame) -> DataFrame:
    return df.select(*LOG_COLUMNS, *(c for c in df.columns if c not in LOG_COLUMNS))


def append_log(df: DataFrame, path: str) -> None:
    """Append runs to a parquet log with a folder for each dashboard and run; further columns are kept.

    A run that is written again (a replayed micro-batch, a retried job)
    replaces the rows of its own ``run_id`` and of no other, so a write that
    failed half-way is mended by repeating it.
    """
    _ordered(df).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dashboard", "run_id").parquet(path)


def append_log_table(df: DataFrame, table: str) -> None:
    """Append to a catalog table with a partition for each dashboard and run, replacing a run that is written again.

    Columns that the table lacks are added to it first (NULL in older rows);
    those that ``df`` lacks are NULL in its rows.
    """
    spark, rows = df.sparkSession, _ordered(df)
    keys = ["dashboard", "run_id"]
    if not spark.catalog.tableExists(table):
        rows.write.partitionBy(*keys).saveAsTable(table)
        return
    there = spark.table(table).schema
    more = [f for f in rows.schema.fields if f.name not in there.names]
    if more:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in more)})")
        there = spark.table(table).schema
    named = rows.select(*(F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in there.fields))
    # A table insert takes the mode from the session only; without it, all partitions would be replaced.
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "dynamic")
    try:
        named.write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Read the log: its fixed columns, then those that some appends added (NULL elsewhere)."""
    merged = spark.read.option("mergeSchema", "true").parquet(path).schema
    more = [f for f in merged.fields if f.name not in LOG_COLUMNS]
    return spark.read.schema(T.StructType([*LOG_SCHEMA.fields, *more])).parquet(path).select(*LOG_COLUMNS, *(f.name for f in more))


def latest_run(log: DataFrame) -> DataFrame:
    """Every check row of the latest run of each (dashboard, period).

    The run with the greatest timestamp is kept whole; of runs at one
    timestamp, the one with the greatest ``run_id``.
    """
    last = _last_runs(log).select("dashboard", "run_week", F.col("last.run_id").alias("run_id"))
    return log.join(last, ["dashboard", "run_week", "run_id"], "left_semi")


def _last_runs(log: DataFrame) -> DataFrame:
    """A maximum per period, combined map-side: a period that was rerun very often is no hot key."""
    return log.groupBy("dashboard", "run_week").agg(F.max(F.struct("run_timestamp", "run_id", "overall_status")).alias("last"))


def latest_run_summary(log: DataFrame) -> DataFrame:
    """One row per (dashboard, period): the latest run, with ``run_id`` breaking ties."""
    return _last_runs(log).select("last.run_id", "dashboard", "run_week", "last.run_timestamp", "last.overall_status")


def quarter_of(label) -> F.Column:
    """``YYYY-Qn`` of a period label: a ``YYYY-MM-DD`` day lies in its calendar quarter, a ``YYYY-WW`` week in one of 13 weeks (week 53 in Q4)."""
    week = F.substring_index(label, "-", -1).try_cast("int")
    by_week = F.concat(F.substring_index(label, "-", 1), F.lit("-Q"), F.least(F.ceil(week / F.lit(13.0)), F.lit(4)).cast("int").cast("string"))
    day = F.when(F.length(label) == 10, label.try_cast("date"))
    by_day = F.concat(F.year(day).cast("string"), F.lit("-Q"), F.quarter(day).cast("string"))
    return F.coalesce(by_day, by_week)


def drift_frequency(log: DataFrame) -> DataFrame:
    """How often each check drifted or failed per dashboard and quarter (latest run per period)."""
    latest = latest_run(log)
    return (
        latest.withColumn("quarter", quarter_of(F.col("run_week")))
        .groupBy("dashboard", "quarter", "check_name")
        .agg(
            F.countDistinct("run_id").alias("n_runs"),
            F.count(F.lit(1)).alias("n_checks"),
            F.count_if(F.col("status") == DRIFT).alias("n_drift"),
            F.count_if(F.col("status") == FAIL).alias("n_fail"),
        )
    )
