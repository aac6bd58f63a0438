"""The base aggregate: one scan per table serves every check of a run set.

For each side (dashboard, source) the rows that survive the row filter and
the period filter are reduced by a single ``GROUPING SETS`` aggregate::

    GROUP BY GROUPING SETS ((wk), (wk, pivot_1), ..., (wk, dim_k))

computing the row count, the exact sum of every metric and, on the
dashboard side, the count of rows violating every sanity rule.  Spark plans
this as Scan → Project → Expand → partial HashAggregate → Exchange → final
HashAggregate, so a hot key is combined map-side before the shuffle and the
shuffle carries at most (partitions × groups) rows.

The output is small (periods × Σ group cardinalities) and is written once to
the shared checkpoint folder: every check then reads that table, never the
facts, and a lost executor cannot force a rescan.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyho.config import CheckSpec
from tallyho.functions.periods import grain_of, lookback_labels_py
from tallyho.session import scratch_path
from tallyho.sources.tables import keep, resolve

DASH, SRC, LATEST, RUN = "dash", "src", "latest", "run"
WEEK_LEVEL = ""  # ``dim`` value of the (wk) grouping set

RUNS_SCHEMA = T.StructType([T.StructField("run_week", T.StringType(), False)])


def sum_input(df: DataFrame, expr: str) -> Column:
    """Metric expression prepared for an exact, overflow-free SUM.

    Integers are summed as DECIMAL(38,0) (a BIGINT sum overflows under ANSI),
    decimals stay decimal, floating values stay double; every total is cast
    to DOUBLE only after summation.
    """
    col = F.expr(expr)
    dtype = df.select(col).schema.fields[0].dataType
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return col.cast("decimal(38,0)")
    if isinstance(dtype, T.DecimalType):
        return col
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return col.cast("double")
    if isinstance(dtype, T.BooleanType):
        return col.cast("decimal(38,0)")
    raise TypeError(f"metric {expr!r} has non-numeric type {dtype.simpleString()}")


def _period_type(df: DataFrame, column: str) -> T.DataType:
    return df.select(F.expr(quote(column))).schema.fields[0].dataType


def period_text(df: DataFrame, column: str) -> str:
    """SQL for the period label of a row: a timestamp counts as its day."""
    if isinstance(_period_type(df, column), (T.TimestampType, T.TimestampNTZType)):
        return f"CAST(CAST({quote(column)} AS DATE) AS STRING)"
    return f"CAST({quote(column)} AS STRING)"


def period_in(df: DataFrame, column: str, labels: list[str]) -> Column:
    """The rows of some periods, as a predicate on the bare column that reaches the parquet scan."""
    dtype, c = _period_type(df, column), F.col(quote(column))
    if isinstance(dtype, T.DateType):
        return c.isin([_dt.date.fromisoformat(w) for w in labels])
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return period_between(df, column, min(labels), max(labels)) & c.cast("date").isin([_dt.date.fromisoformat(w) for w in labels]) if labels else F.lit(False)
    return c.isin(list(labels))


def period_between(df: DataFrame, column: str, first: str, last: str) -> Column:
    """A typed range on the bare column: it prunes files; equality on the label stays the exact test."""
    dtype, c = _period_type(df, column), F.col(quote(column))
    if isinstance(dtype, T.DateType):
        return c.between(_dt.date.fromisoformat(first), _dt.date.fromisoformat(last))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return (c >= F.lit(first).cast(dtype)) & (c < F.lit((_dt.date.fromisoformat(last) + _dt.timedelta(days=1)).isoformat()).cast(dtype))
    return c.between(first, last)


def period_from(df: DataFrame, column: str, first: str) -> Column:
    """A typed lower bound on the bare column."""
    dtype, c = _period_type(df, column), F.col(quote(column))
    return c >= (F.lit(first) if isinstance(dtype, T.StringType) else F.lit(first).cast(dtype))


def quote(name: str) -> str:
    """A column name as a SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def str_literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sum_inputs_sql(df: DataFrame, exprs: list[str]) -> list[str]:
    """SQL for each metric prepared for an exact, overflow-free SUM (types from one analysis)."""
    if not exprs:
        return []
    fields = df.selectExpr(*[f"({e}) AS m{i}" for i, e in enumerate(exprs)]).schema.fields
    out = []
    for e, f in zip(exprs, fields):
        dtype = f.dataType
        if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
            out.append(f"CAST(({e}) AS DECIMAL(38,0))")
        elif isinstance(dtype, T.DecimalType):
            out.append(f"({e})")
        elif isinstance(dtype, (T.FloatType, T.DoubleType)):
            out.append(f"CAST(({e}) AS DOUBLE)")
        else:
            raise TypeError(f"metric {e!r} has non-numeric type {dtype.simpleString()}")
    return out


def side_aggregate(
    df: DataFrame,
    *,
    side: str,
    spec: CheckSpec,
    period_filter: Column | None,
    period_frame: DataFrame | None,
    with_rules: bool,
    by_file: bool = False,
) -> DataFrame:
    """(side, wk, dim, key, n_rows, m0.., r0..) for one table.

    ``by_file``: one such set for each file of the table (column ``file``),
    its sums left in their exact type, so that they can be added up later.
    """
    t = keep(df, spec.row_filter)
    if period_filter is not None:
        t = t.where(period_filter)
    if period_frame is not None:
        t = t.join(period_frame, F.expr(period_text(df, spec.date_column)) == period_frame["_wk"], "left_semi")

    dims = spec.dimensions if side == DASH else spec.source_dimensions
    metrics = spec.metrics if side == DASH else spec.source_metrics
    rules = spec.sanity if with_rules else []
    cols = [f"{period_text(df, spec.date_column)} AS wk"]
    cols += [f"CAST({quote(d)} AS STRING) AS k{i}" for i, d in enumerate(dims)]
    at = [spec.metrics.index(m) for m in metrics]  # a metric has one column on both sides
    cols += [f"{s} AS m{i}" for i, s in zip(at, sum_inputs_sql(t, metrics))]
    cols += [f"CAST(({r.expression}) AS BOOLEAN) AS r{j}" for j, r in enumerate(rules)]
    if by_file:
        cols.append("_metadata.file_path AS file")
    p = t.selectExpr(*cols)
    level = ["file", "wk"] if by_file else ["wk"]

    aggs = ["count(1) AS n_rows"]
    aggs += [f"sum(m{i}) AS m{i}" if by_file else f"CAST(coalesce(sum(m{i}), 0) AS DOUBLE) AS m{i}" for i in at]
    aggs += [f"count_if(r{j}) AS r{j}" for j in range(len(rules))]
    keys = [f"k{i}" for i in range(len(dims))]
    if keys:
        aggs += [f"grouping(k{i}) AS g{i}" for i in range(len(dims))]
        sets = [level] + [[*level, k] for k in keys]
        g = p.groupingSets(sets, *level, *keys).agg(*[F.expr(a) for a in aggs])
        dim = "CASE " + " ".join(f"WHEN g{i} = 0 THEN {str_literal(d)}" for i, d in enumerate(dims)) + f" ELSE '{WEEK_LEVEL}' END"
        key = "CASE " + " ".join(f"WHEN g{i} = 0 THEN k{i}" for i in range(len(dims))) + " END"
    else:
        g = p.groupBy(*level).agg(*[F.expr(a) for a in aggs])
        dim, key = f"'{WEEK_LEVEL}'", "CAST(NULL AS STRING)"
    out = [*(["file"] if by_file else []), f"{str_literal(side)} AS side", "wk", f"{dim} AS dim", f"{key} AS key", "n_rows"]
    out += [f"m{i}" for i in at]
    out += [f"r{j}" for j in range(len(rules))]
    return g.selectExpr(*out)


def latest_period(df: DataFrame, spec: CheckSpec) -> DataFrame:
    """MAX(period) over all filtered rows: a two-column scan, no period filter."""
    t = keep(df, spec.row_filter)
    # Labels and dates sort as their texts do.
    return t.agg(F.max(F.expr(period_text(df, spec.date_column))).alias("wk"), F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(LATEST).alias("side"), "wk", F.lit(WEEK_LEVEL).alias("dim"), F.lit(None).cast("string").alias("key"), "n_rows"
    )


def latest_from(df: DataFrame, spec: CheckSpec, first: str | None) -> DataFrame:
    """The latest period, looked for from the first period of the runs on.

    One scalar comes to the driver.  Rows from there on, which the run reads
    anyway, nearly always have it; only a table without any such row is
    scanned whole.
    """
    if first is not None:
        probe = keep(df, spec.row_filter).where(period_from(df, spec.date_column, first))
        latest = probe.agg(F.max(F.expr(period_text(df, spec.date_column)))).first()[0]
        if latest is not None:
            return df.sparkSession.createDataFrame([(LATEST, latest, WEEK_LEVEL)], "side string, wk string, dim string")
    return latest_period(df, spec)


@dataclass
class Base:
    """Materialized base aggregate of one dashboard plus its run set."""

    spec: CheckSpec
    runs: DataFrame  # dashboard, run_week
    groups: DataFrame  # dashboard, side, wk, dim, key, n_rows, r0..
    totals: DataFrame  # dashboard, side, wk, dim, key, metric, total
    latest: DataFrame  # dashboard, latest
    path: str | None

    def under(self, spec: CheckSpec) -> Base:
        """The same aggregate for other tolerances, limits, values or changes; what was aggregated must be the same."""
        if aggregated(spec) != aggregated(self.spec):
            raise ValueError("the base was aggregated for other columns, rules or filters")
        return replace(self, spec=spec)


def aggregated(spec: CheckSpec) -> dict:
    """Those settings of a registry that decide what a base aggregate holds, but for the tables themselves."""
    return {
        "dashboard": spec.dashboard,
        "date_column": spec.date_column,
        "grain": spec.grain,
        "lookback": spec.lookback,
        "row_filter": spec.row_filter,
        "metrics": spec.metrics,
        "source_metrics": spec.source_metrics,
        "dimensions": spec.dimensions,
        "source_dimensions": spec.source_dimensions,
        "rules": [r.expression for r in spec.sanity],
    }


def _runs_frame(spark: SparkSession, runs) -> DataFrame:
    if isinstance(runs, DataFrame):
        return runs.select(F.col("run_week").cast("string").alias("run_week")).where(F.col("run_week").isNotNull()).distinct()
    uniq = list(dict.fromkeys(str(r) for r in runs))
    return spark.createDataFrame([(w,) for w in uniq], RUNS_SCHEMA)


def _stored(df: DataFrame, name: str) -> tuple[DataFrame, str | None, str | None]:
    """A frame of labels written once to the shared folder, so Spark knows its size, and its first and last label."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    back = df.sparkSession.read.parquet(path)
    first, last = back.agg(F.min("_wk"), F.max("_wk")).first()
    return back, first, last


def aggregate_plan(spark: SparkSession, spec: CheckSpec, runs=None) -> DataFrame:
    """The (unmaterialized) union of both side aggregates for a run set.

    ``runs``: a list of period labels (literal IN filters, pushed to the
    scan), a DataFrame with a ``run_week`` column (semi-join on the needed
    periods), or ``None`` for every period present in either table.
    """
    grain = grain_of(spec.grain)
    dash_df = resolve(spark, spec.dashboard_table)
    src_df = resolve(spark, spec.source_table) if spec.reconciliation or spec.parts or spec.periods_of_source else None
    dc = spec.date_column

    parts: list[DataFrame] = []
    begin: str | None = None  # the first period that the runs read
    if runs is None:
        dash_agg = side_aggregate(dash_df, side=DASH, spec=spec, period_filter=None, period_frame=None, with_rules=True)
        parts = [dash_agg]
        if src_df is not None:
            parts.append(side_aggregate(src_df, side=SRC, spec=spec, period_filter=None, period_frame=None, with_rules=False))
    elif isinstance(runs, DataFrame):
        # Stored first: whatever made the labels runs once, and every scan below is bounded by their range.
        run_weeks, first, last = _stored(_runs_frame(spark, runs).select(F.col("run_week").alias("_wk")), "run-weeks")
        runs = run_weeks.select(F.col("_wk").alias("run_week"))
        needed, earliest, _ = _stored(run_weeks.union(run_weeks.select(F.explode(grain.lookback(F.col("_wk"), spec.lookback)))).distinct(), "needed-weeks")
        begin = earliest
        within = lambda df, a: period_between(df, dc, a, last) if last is not None else F.lit(False)
        dash_agg = side_aggregate(dash_df, side=DASH, spec=spec, period_filter=within(dash_df, earliest), period_frame=needed, with_rules=True)
        parts = [dash_agg]
        if src_df is not None:
            parts.append(side_aggregate(src_df, side=SRC, spec=spec, period_filter=within(src_df, first), period_frame=run_weeks, with_rules=False))
    else:
        run_list = list(dict.fromkeys(str(r) for r in runs))
        needed = list(dict.fromkeys(run_list + [w for r in run_list for w in lookback_labels_py(r, spec.lookback, spec.grain)]))
        begin = min(needed, default=None)
        dash_agg = side_aggregate(
            dash_df,
            side=DASH,
            spec=spec,
            period_filter=period_in(dash_df, dc, needed),
            period_frame=None,
            with_rules=True,
        )
        parts = [dash_agg]
        if src_df is not None:
            parts.append(side_aggregate(src_df, side=SRC, spec=spec, period_filter=period_in(src_df, dc, run_list), period_frame=None, with_rules=False))
    # An explicit run set travels with the aggregate (stored with its dashboard
    # as data); so does the latest period, which needs its own two-column scan
    # because the aggregate only covers the requested periods; it is bounded by
    # their first one.  For "every
    # period" both are derived from the small materialized table instead:
    # deriving them here would re-scan the facts (column pruning makes the
    # branches differ, so no exchange is reused).
    if runs is not None:
        parts.append(_runs_frame(spark, runs).select(F.lit(RUN).alias("side"), F.col("run_week").alias("wk")))
        if spec.freshness_seq is not None:
            parts.append(latest_from(dash_df, spec, begin))

    combined = parts[0]
    for p in parts[1:]:
        combined = combined.unionByName(p, allowMissingColumns=True)

    # ``dashboard`` is stored as data so joins on it stay equi-joins after reading back.
    return combined.withColumn("dashboard", F.lit(spec.dashboard))


def build_base(spark: SparkSession, spec: CheckSpec, runs=None, materialize: bool = True) -> Base:
    """Aggregate both tables once and write the result to the shared scratch folder."""
    combined = aggregate_plan(spark, spec, runs)
    path = None
    if materialize:
        path = scratch_path(spark, f"base-{spec.dashboard}")
        combined.write.mode("error").parquet(path)
        combined = spark.read.parquet(path)

    meta = combined
    if runs is None:
        # Every period present is a run; the run set and the latest period are
        # derived from the small materialized table (never from the facts) and
        # written next to it, so each check starts from a plain scan.
        weeks = combined.where(F.col("side").isin(DASH, SRC) & (F.col("dim") == WEEK_LEVEL) & F.col("wk").isNotNull())
        run_rows = weeks.select("dashboard", F.lit(RUN).alias("side"), "wk").distinct()
        latest_rows = (
            weeks.where(F.col("side") == DASH).groupBy("dashboard").agg(F.max("wk").alias("wk")).select("dashboard", F.lit(LATEST).alias("side"), "wk")
        )
        meta = run_rows.unionByName(latest_rows)
        if materialize:
            meta_path = f"{path}-runs"
            meta.write.mode("error").parquet(meta_path)
            meta = spark.read.parquet(meta_path)
    return as_base(spec, combined, meta, path)


def as_base(spec: CheckSpec, combined: DataFrame, meta: DataFrame, path: str | None) -> Base:
    """The views that checks read of a stored aggregate and its run and latest rows."""
    facts = combined.where(f"side IN ('{DASH}', '{SRC}')")
    groups = facts.selectExpr("dashboard", "side", "wk", "dim", "key", "n_rows", *[f"r{j}" for j in range(len(spec.sanity))])
    metrics = spec.metrics
    if metrics:
        # wide m0..mk → (metric, total) rows
        pairs = ", ".join(f"{str_literal(m)}, m{i}" for i, m in enumerate(metrics))
        totals = facts.selectExpr("dashboard", "side", "wk", "dim", "key", f"stack({len(metrics)}, {pairs}) AS (metric, total)")
    else:
        totals = combined.where("false").selectExpr(
            "dashboard", "side", "wk", "dim", "key", "CAST(NULL AS STRING) AS metric", "CAST(NULL AS DOUBLE) AS total"
        )

    latest = meta.where(F.col("side") == LATEST).select("dashboard", F.col("wk").alias("latest"))
    run_frame = meta.where(F.col("side") == RUN).select("dashboard", F.col("wk").alias("run_week"))
    return Base(spec=spec, runs=run_frame, groups=groups, totals=totals, latest=latest, path=path)
