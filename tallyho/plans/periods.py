"""Period plans: run-week resolution, label arithmetic over data, totals, windowed trend."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyho.functions.periods import grain_of
from tallyho.functions.scoring import PASS, TREND_DRIFT_FACTOR, round2, tier_ladder
from tallyho.operators.base import DASH, WEEK_LEVEL, Base, sum_input


def resolve_run_week(dim_date: DataFrame, as_of: list[str], date_col: str = "full_date", label_col: str = "fiscal_yr_and_wk_desc") -> DataFrame:
    """MAX(label) over dimension dates ≤ each as-of date, all as-of dates in one pass.

    The as-of dates are parameters (driver-side, a handful); each becomes one
    conditional MAX in a single aggregation over the dimension.
    """
    days = [_dt.date.fromisoformat(d) for d in as_of]
    aggs = [F.max(F.when(F.col(date_col) <= F.lit(d), F.col(label_col))).alias(f"a{i}") for i, d in enumerate(days)]
    wide = dim_date.agg(*aggs)
    stacked = F.inline(
        F.array(*[F.struct(F.lit(d).alias("as_of"), F.col(f"a{i}").alias("run_week")) for i, d in enumerate(as_of)])
    )
    return wide.select(stacked)


def run_week_for(dim_date: DataFrame, run_week: str | None, today: str, date_col: str = "full_date", label_col: str = "fiscal_yr_and_wk_desc") -> str | None:
    """The run week: the given parameter, else the latest label dated on or before ``today``.

    Only the single resolved label reaches the driver.
    """
    if run_week:
        return run_week
    row = resolve_run_week(dim_date, [today], date_col, label_col).first()
    return None if row is None else row["run_week"]


def previous_labels(labels: DataFrame, n: int, grain: str = "week", label_col: str = "run_week") -> DataFrame:
    """(run_week, pos, prev_week): the n labels before each label, pos 1 = most recent."""
    g = grain_of(grain)
    return (
        labels.select(F.col(label_col).alias("run_week"))
        .select("run_week", F.posexplode(g.lookback(F.col("run_week"), n)))
        .select("run_week", (F.col("pos") + 1).alias("pos"), F.col("col").alias("prev_week"))
    )


def weekly_totals(base: Base) -> DataFrame:
    """Filtered dashboard totals per period and metric (from the base aggregate)."""
    return base.totals.where((F.col("side") == DASH) & (F.col("dim") == WEEK_LEVEL)).select(
        "dashboard", F.col("wk").alias("week"), "metric", "total"
    )


def verify_totals(spark: SparkSession, dashboard: DataFrame, source: DataFrame, date_column: str, metrics: list[str]) -> DataFrame:
    """Side-by-side labelled totals per period and metric, no row filter (manual check)."""

    def side(df: DataFrame, label: str) -> DataFrame:
        sums = [F.coalesce(F.sum(sum_input(df, m)), F.lit(0)).cast("double").alias(f"m{i}") for i, m in enumerate(metrics)]
        g = df.groupBy(F.col(date_column).cast("string").alias("run_week")).agg(*sums)
        stacked = F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"m{i}").alias("total")) for i, m in enumerate(metrics)]))
        return g.select(F.lit(label).alias("source"), "run_week", stacked)

    return side(dashboard, "dashboard").unionByName(side(source, "silver"))


def trend_window(base: Base, n: int, limit: float) -> DataFrame:
    """Trailing-n-period baseline with a range window, for every period with data.

    The frame covers period indexes [idx-n, idx-1]; week-53 rows are excluded
    from history because the previous-week rule never produces them (their
    index coincides with week 01 of the next year).  Each window partition
    holds one metric's periods only.
    """
    g = grain_of(base.spec.grain)
    t = weekly_totals(base)
    idx = g.index(F.col("week"))
    w = Window.partitionBy("dashboard", "metric").orderBy(idx).rangeBetween(-n, -1)
    hist = F.when(g.is_history_label(F.col("week")), F.col("total"))
    df = t.select(
        "dashboard",
        F.col("week").alias("run_week"),
        "metric",
        F.col("total").alias("cur"),
        F.avg(hist).over(w).alias("base"),
        F.count(hist).over(w).alias("n_weeks"),
        # Only for the reported figure, and only where every total has a decimal text.
        F.avg(hist.try_cast("decimal(38,10)")).over(w).alias("dec"),
        F.count(hist.try_cast("decimal(38,10)")).over(w).alias("n_dec"),
    )
    baseline = F.col("base")
    graded = (F.col("n_weeks") > 0) & (baseline != 0)
    wow = F.when(graded, (F.col("cur") - baseline) / F.abs(baseline) * F.lit(100.0))
    return df.select(
        "dashboard",
        "run_week",
        "metric",
        F.when(F.col("n_dec") == F.col("n_weeks"), F.round(F.col("dec"), 2).cast("double")).otherwise(F.round(baseline, 2)).alias("baseline"),
        round2(F.col("cur")).alias("current"),
        round2(wow).alias("change_pct"),
        F.col("n_weeks").cast("bigint").alias("n_weeks"),
        F.when(graded, tier_ladder(F.abs(wow), F.lit(float(limit)), TREND_DRIFT_FACTOR)).otherwise(F.lit(PASS)).alias("status"),
    )


def trend_segments(base: Base, n: int, limit: float, dimension: str) -> DataFrame:
    """Trailing-n-period baselines of the whole table (``dimension`` '') and of every value of one dimension.

    Each (value, metric) has a row for every period of the table from its own
    first period on; a period without its rows counts 0, so a value that
    vanishes shows as -100 %.  The baseline is the mean over those of the n
    preceding labels that have rows.  It is the difference of two exact prefix
    sums over a dense index of periods, so any n costs the same, and each
    window partition holds one value's and metric's periods only.

    Week 53 is graded like other periods and never history.  A window with a
    total that no DECIMAL(38,10) holds (NaN, infinite, beyond 28 digits) has
    the baseline NaN and grades FAIL.
    """
    g = grain_of(base.spec.grain)
    keys = ["dashboard", "dim", "key", "metric"]
    totals = base.totals.where(f"side = '{DASH}' AND wk IS NOT NULL").where(F.col("dim").isin(WEEK_LEVEL, dimension))
    label = F.col("wk")
    seen = totals.select(*keys, g.index(label).alias("idx"), "wk", "total", g.is_history_label(label).alias("past"))
    ends = seen.groupBy("dashboard").agg(F.max("idx").alias("last"))
    own = seen.groupBy(*keys).agg(F.min("idx").alias("first")).join(ends, "dashboard")
    empty = own.select(*keys, F.explode(F.sequence("first", "last")).alias("idx"))
    exact = F.when(F.col("past"), F.col("total").try_cast("decimal(38,10)"))
    # Weeks 53 and 01 share an index, so a cell has two totals at most.
    cells = seen.unionByName(empty, allowMissingColumns=True).groupBy(*keys, "idx").agg(
        F.collect_list(F.when(label.isNotNull(), F.struct("wk", "total"))).alias("totals"),
        F.coalesce(F.sum(exact).cast("decimal(38,10)"), F.lit(0).cast("decimal(38,10)")).alias("s"),
        F.count_if("past").alias("c"),
        F.count(exact).alias("d"),
    )
    line = Window.partitionBy(*keys).orderBy("idx")
    for name in ("s", "c", "d"):
        cells = cells.withColumn(f"{name}_to", F.sum(name).over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    upto = lambda name, back: F.coalesce(F.lag(f"{name}_to", back).over(line), F.lit(0))
    between = {name: upto(name, 1) - upto(name, n + 1) for name in ("s", "c", "d")}
    cells = cells.select(*keys, "idx", "totals", *(v.alias(f"{k}_n") for k, v in between.items()))
    periods = seen.select("dashboard", "idx", "wk").distinct()
    df = cells.join(periods, ["dashboard", "idx"])
    current = F.coalesce(F.get(F.filter("totals", lambda x: x["wk"] == F.col("wk")), F.lit(0))["total"], F.lit(0.0))
    mean = F.when(F.col("c_n") > 0, F.when(F.col("c_n") == F.col("d_n"), F.col("s_n") / F.col("c_n").cast("decimal(10,0)")))
    df = df.withColumn("cur", current).withColumn("exact", mean).withColumn("base", F.when((F.col("c_n") > 0) & (F.col("c_n") != F.col("d_n")), F.lit(float("nan"))).otherwise(F.col("exact").cast("double")))
    graded = (F.col("c_n") > 0) & (F.col("base") != 0)
    wow = F.when(graded, (F.col("cur") - F.col("base")) / F.abs("base") * F.lit(100.0))
    return df.select(
        "dashboard",
        F.col("dim").alias("dimension"),
        F.col("key").alias("segment"),
        F.col("wk").alias("run_week"),
        "metric",
        F.coalesce(F.round("exact", 2).cast("double"), F.col("base")).alias("baseline"),
        round2(F.col("cur")).alias("current"),
        round2(wow).alias("change_pct"),
        F.col("c_n").cast("bigint").alias("n_weeks"),
        F.when(graded, tier_ladder(F.abs(wow), F.lit(float(limit)), TREND_DRIFT_FACTOR)).otherwise(F.lit(PASS)).alias("status"),
    )
