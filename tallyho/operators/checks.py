"""The six checks, each a DataFrame plan over the materialized base aggregate.

Every builder returns one row per (run, configured check) with the check's
own columns; ``to_results`` projects any of them onto the common result
schema.  The output grain (runs × configured checks) is produced by
``expand``: each run row is repeated once per configured check with an
``inline`` of a literal array, a Generate inside whole-stage codegen rather
than a join.  Period-level values are attached with equi-joins on
(dashboard, period, metric, ...).  Per-category matching (parts_sum,
completeness) groups tagged rows of both sides by value instead of joining
them, so a NULL category matches NULL and no group holds more than a few
rows.  Projections are SQL expressions (one ``selectExpr`` each), which keeps
the number of driver→JVM calls per plan small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyho.config import py_text
from tallyho.functions.periods import grain_of
from tallyho.functions.scoring import (
    DRIFT,
    FAIL,
    PASS,
    RECON_DRIFT_FACTOR,
    TREND_DRIFT_FACTOR,
    count_ladder_sql,
    float_text_sql,
    pct_gap_sql,
    round2_sql,
    severity_sql,
    tier_ladder_sql,
)
from tallyho.functions import messages as M
from tallyho.operators.base import DASH, SRC, WEEK_LEVEL, Base
from tallyho.operators.base import str_literal as L

RESULT_COLUMNS = [
    "dashboard",
    "run_week",
    "check_seq",
    "check_name",
    "metric",
    "status",
    "severity",
    "expected",
    "actual",
    "expected_num",
    "actual_num",
    "gap",
    "tolerance",
    "gap_unit",
    "detail",
]
_TYPES = {"check_seq": "int", **dict.fromkeys(("expected_num", "actual_num", "gap", "tolerance"), "double")}
RESULT_SCHEMA = ", ".join(f"{c} {_TYPES.get(c, 'string')}" for c in RESULT_COLUMNS)


def _s(name: str) -> T.StructField:
    return T.StructField(name, T.StringType(), True)


def _i(name: str) -> T.StructField:
    return T.StructField(name, T.IntegerType(), True)


def _d(name: str) -> T.StructField:
    return T.StructField(name, T.DoubleType(), True)


def sql_literal(v, dtype: T.DataType) -> str:
    """A typed Spark SQL literal for a configuration value."""
    type_name = dtype.simpleString()
    if v is None:
        return f"CAST(NULL AS {type_name})"
    if isinstance(dtype, T.StringType):
        return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(v, float) and v != v or v in (float("inf"), float("-inf")):
        return f"CAST('{v}' AS {type_name})"
    return f"CAST({v!r} AS {type_name})"


def expand(df: DataFrame, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """Repeat every row of ``df`` once per configuration row (rows are registry-sized).

    The literal array is passed as one SQL expression, so a large registry
    costs one driver→JVM call instead of one per cell.
    """
    structs = ", ".join(
        "named_struct(" + ", ".join(f"'{f.name}', {sql_literal(v, f.dataType)}" for v, f in zip(row, schema.fields)) + ")"
        for row in rows
    )
    return df.select("*", F.expr(f"inline(array({structs}))"))


def to_results(df: DataFrame) -> DataFrame:
    """Project a check frame onto the common result schema (with severity)."""
    return df.selectExpr(*[f"{severity_sql()} AS severity" if c == "severity" else c for c in RESULT_COLUMNS])


def _level(base: Base, side: str, week_level: bool) -> DataFrame:
    op = "=" if week_level else "!="
    return base.totals.where(f"side = '{side}' AND dim {op} '{WEEK_LEVEL}'")


def _week_totals(base: Base, side: str, alias: str) -> DataFrame:
    return _level(base, side, True).selectExpr("dashboard", "wk AS run_week", "metric", f"total AS {alias}")


# ── C1 freshness ────────────────────────────────────────────────────────────


def freshness(spark: SparkSession, base: Base) -> DataFrame | None:
    spec = base.spec
    if spec.freshness_seq is None:
        return None
    return base.runs.join(base.latest, "dashboard", "left").selectExpr(
        "dashboard",
        "run_week",
        f"{int(spec.freshness_seq)} AS check_seq",
        "'freshness' AS check_name",
        "'row_freshness' AS metric",
        f"CASE WHEN latest <=> run_week THEN '{PASS}' ELSE '{FAIL}' END AS status",
        "run_week AS expected",
        "latest AS actual",
        "CAST(NULL AS DOUBLE) AS expected_num",
        "CAST(NULL AS DOUBLE) AS actual_num",
        "CAST(NULL AS DOUBLE) AS gap",
        "CAST(NULL AS DOUBLE) AS tolerance",
        "CAST(NULL AS STRING) AS gap_unit",
        f"format_string({L(M.FRESHNESS)}, coalesce(latest, 'None')) AS detail",
        "latest AS latest_week",
    )


# ── C2 reconciliation ───────────────────────────────────────────────────────


def reconciliation(spark: SparkSession, base: Base) -> DataFrame | None:
    spec = base.spec
    if not spec.reconciliation:
        return None
    rows = [(c.seq, c.metric, c.limit, py_text(c.limit)) for c in spec.reconciliation]
    schema = T.StructType([_i("check_seq"), _s("metric"), _d("tol"), _s("tol_text")])
    j = (
        expand(base.runs, rows, schema)
        .join(_week_totals(base, DASH, "dash_total"), ["dashboard", "run_week", "metric"], "left")
        .join(_week_totals(base, SRC, "src_total"), ["dashboard", "run_week", "metric"], "left")
        .selectExpr("*", "coalesce(dash_total, 0.0D) AS dv", "coalesce(src_total, 0.0D) AS sv")
        .selectExpr("*", "sv = 0 AND dv = 0 AS zero", f"{pct_gap_sql('sv', 'dv')} AS gp")
    )
    return j.selectExpr(
        "dashboard",
        "run_week",
        "check_seq",
        "'reconciliation' AS check_name",
        "metric",
        f"CASE WHEN zero THEN '{PASS}' ELSE {tier_ladder_sql('gp', 'tol', RECON_DRIFT_FACTOR)} END AS status",
        f"CASE WHEN zero THEN '0' ELSE {float_text_sql(round2_sql('sv'))} END AS expected",
        f"CASE WHEN zero THEN '0' ELSE {float_text_sql(round2_sql('dv'))} END AS actual",
        f"CASE WHEN zero THEN 0.0D ELSE {round2_sql('sv')} END AS expected_num",
        f"CASE WHEN zero THEN 0.0D ELSE {round2_sql('dv')} END AS actual_num",
        f"CASE WHEN NOT zero THEN {round2_sql('dv - sv')} END AS gap",
        "CASE WHEN NOT zero THEN tol END AS tolerance",
        "CASE WHEN NOT zero THEN 'abs' END AS gap_unit",
        f"CASE WHEN zero THEN {L(M.RECON_BOTH_ZERO)} ELSE format_string({L(M.RECON_GAP)}, gp, tol_text) END AS detail",
        f"CASE WHEN NOT zero THEN {round2_sql('gp')} END AS gap_pct",
    )


# ── C3 parts_sum ────────────────────────────────────────────────────────────


_PARTS_SCHEMA = T.StructType([_i("check_seq"), _s("metric"), _s("pivot"), _d("tol"), _s("tol_text")])


def _parts_rows(spec) -> list[tuple]:
    return [(c.seq, c.metric, c.pivot, c.tolerance, py_text(c.tolerance)) for c in spec.parts]


def _parts_spec(spark: SparkSession, spec) -> DataFrame:
    # Registry-sized: at most (metrics × pivots) rows.
    return F.broadcast(spark.createDataFrame(_parts_rows(spec), _PARTS_SCHEMA))


def _subtotals(spark: SparkSession, base: Base) -> DataFrame:
    """One row per (run, parts check, group key) with both sides' subtotals and the grading.

    Both sides' group rows are grouped by (run, metric, pivot, key) instead of
    joined: NULL keys form their own group (null-safe matching for free) and
    every group holds at most one source and one dashboard row.
    """
    spec = base.spec
    sub = (
        base.totals.where(f"dim != '{WEEK_LEVEL}'")
        .selectExpr("dashboard", "wk AS run_week", "metric", "dim AS pivot", "key", "side", "total")
        .join(base.runs, ["dashboard", "run_week"], "left_semi")
        .groupBy("dashboard", "run_week", "metric", "pivot", "key")
        .agg(
            F.expr(f"max(CASE WHEN side = '{SRC}' THEN total END) AS src_total"),
            F.expr(f"max(CASE WHEN side = '{DASH}' THEN total END) AS dash_total"),
            F.expr(f"max(side = '{SRC}') AS in_src"),
            F.expr(f"max(side = '{DASH}') AS in_dash"),
        )
        .join(_parts_spec(spark, spec), ["metric", "pivot"])
        .selectExpr("*", "coalesce(dash_total, 0.0D) AS dv", "in_src AND src_total != 0 AS is_compared")
    )
    sub = sub.selectExpr("*", f"CASE WHEN is_compared THEN {pct_gap_sql('src_total', 'dv')} END AS gp")
    # NaN never counts as failing (Python's ``nan > tol`` is False).
    return sub.selectExpr("*", "coalesce(is_compared AND gp > tol AND NOT isnan(gp), false) AS is_failing")


def parts_compare(spark: SparkSession, base: Base) -> DataFrame | None:
    """Source-driven comparison: one row per source group (dashboard-only groups are never compared)."""
    if not base.spec.parts:
        return None
    return _subtotals(spark, base).where("in_src").selectExpr(
        "dashboard",
        "run_week",
        "check_seq",
        "metric",
        "pivot",
        "key AS pivot_value",
        "tol",
        "tol_text",
        "src_total AS source_total",
        "dv AS dashboard_total",
        "gp AS gap_pct",
        "is_compared",
        "is_failing",
    )


def parts_sum_detail(spark: SparkSession, base: Base) -> DataFrame | None:
    """One row per source group of every parts_sum check (the itemised failures)."""
    cmp = parts_compare(spark, base)
    if cmp is None:
        return None
    return cmp.selectExpr(
        "dashboard",
        "run_week",
        "metric",
        "pivot",
        "pivot_value",
        f"{round2_sql('source_total')} AS source_total",
        f"{round2_sql('dashboard_total')} AS dashboard_total",
        f"{round2_sql('gap_pct')} AS gap_pct",
        "is_failing",
    )


def parts_sum(spark: SparkSession, base: Base) -> DataFrame | None:
    spec = base.spec
    if not spec.parts:
        return None
    keys = ["dashboard", "run_week", "check_seq"]
    counts = _subtotals(spark, base).groupBy(*keys).agg(
        F.count_if("in_src").alias("n_src"),
        F.count_if("in_dash").alias("n_dash"),
        F.count_if("is_failing").alias("n_fail_groups"),
        F.count_if("is_compared").alias("n_compared"),
    )
    j = (
        expand(base.runs, _parts_rows(spec), _PARTS_SCHEMA)
        .join(counts, keys, "left")
        .selectExpr(
            "*",
            "CAST(coalesce(n_fail_groups, 0) AS BIGINT) AS n_fail",
            "CAST(coalesce(n_src, 0) AS BIGINT) AS c_src",
            "CAST(coalesce(n_dash, 0) AS BIGINT) AS c_dash",
            "CAST(coalesce(n_compared, 0) AS BIGINT) AS c_cmp",
        )
    )
    return j.selectExpr(
        "dashboard",
        "run_week",
        "check_seq",
        "'parts_sum' AS check_name",
        "concat(metric, '_by_', pivot) AS metric",
        f"{count_ladder_sql('n_fail')} AS status",
        "CAST(c_src AS STRING) AS expected",
        "CAST(c_dash AS STRING) AS actual",
        "CAST(c_src AS DOUBLE) AS expected_num",
        "CAST(c_dash AS DOUBLE) AS actual_num",
        "CAST(NULL AS DOUBLE) AS gap",
        "CAST(NULL AS DOUBLE) AS tolerance",
        "CAST(NULL AS STRING) AS gap_unit",
        f"CASE WHEN n_fail = 0 THEN format_string({L(M.PARTS_ALL_MATCH)}, pivot) "
        f"ELSE format_string({L(M.PARTS_FAILING)}, n_fail, c_cmp, pivot, tol_text) END AS detail",
        "n_fail AS n_failing",
        "metric AS base_metric",
        "pivot",
    )


# ── C4 trend_sanity ─────────────────────────────────────────────────────────


def trend_sanity(spark: SparkSession, base: Base) -> DataFrame | None:
    spec = base.spec
    if not spec.trend:
        return None
    grain = grain_of(spec.grain)
    rows = [(c.seq, c.metric, c.limit, py_text(c.limit)) for c in spec.trend]
    schema = T.StructType([_i("check_seq"), _s("metric"), _d("lim"), _s("lim_text")])
    rs = expand(base.runs, rows, schema).withColumn("lookback", grain.lookback(F.col("run_week"), spec.lookback))
    # One exploded join reads the run's own week (pos 0) and its lookback weeks (pos 1..n).
    weeks = rs.selectExpr(
        "dashboard", "run_week", "check_seq", "metric", "posexplode(concat(array(run_week), lookback)) AS (pos, hist_week)"
    )
    totals = _level(base, DASH, True).selectExpr("dashboard", "wk AS hist_week", "metric", "total")
    agg = (
        weeks.join(totals, ["dashboard", "hist_week", "metric"])
        .groupBy("dashboard", "run_week", "check_seq")
        .agg(
            F.expr("max(CASE WHEN pos = 0 THEN total END) AS cur_total"),
            F.expr("count_if(pos > 0) AS n_weeks"),
            # At most ``lookback`` totals, summed in their order.
            F.expr("array_sort(collect_list(CASE WHEN pos > 0 THEN struct(pos, total) END)) AS hist"),
        )
        .selectExpr("*", "CASE WHEN n_weeks > 0 THEN aggregate(hist, 0.0D, (s, x) -> s + x.total) / n_weeks END AS base")
        # The reported figure: on the decimal text where there is one, so a half cent rounds the same in every engine.
        .selectExpr(
            "* EXCEPT (hist)",
            "CASE WHEN n_weeks > 0 AND forall(hist, x -> try_cast(x.total AS DECIMAL(38,10)) IS NOT NULL) THEN "
            "CAST(round(try_divide(aggregate(hist, CAST(0 AS DECIMAL(38,10)), (s, x) -> CAST(try_add(s, try_cast(x.total AS DECIMAL(38,10))) AS DECIMAL(38,10))), CAST(n_weeks AS DECIMAL(10,0))), 2) AS DOUBLE) END AS base_dec",
        )
    )
    j = rs.join(agg, ["dashboard", "run_week", "check_seq"], "left")
    j = j.selectExpr(
        "*",
        "coalesce(cur_total, 0.0D) AS cur",
        "CAST(coalesce(n_weeks, 0) AS BIGINT) AS nw",
        "coalesce(base_dec, round(base, 2)) AS base_r",
    ).selectExpr("*", "nw > 0 AND base != 0 AS graded")
    j = j.selectExpr("*", "CASE WHEN graded THEN (cur - base) / abs(base) * 100.0D END AS wow")
    label = f"CASE WHEN nw = 1 THEN {L(M.TREND_ONE_WEEK)} ELSE format_string({L(M.TREND_N_WEEKS)}, nw) END"
    return j.selectExpr(
        "dashboard",
        "run_week",
        "check_seq",
        "'trend_sanity' AS check_name",
        "metric",
        f"CASE WHEN graded THEN {tier_ladder_sql('abs(wow)', 'lim', TREND_DRIFT_FACTOR)} ELSE '{PASS}' END AS status",
        f"CASE WHEN nw = 0 THEN CAST(NULL AS STRING) WHEN base = 0 THEN '0.0' ELSE {float_text_sql('base_r')} END AS expected",
        f"CASE WHEN graded THEN {float_text_sql(round2_sql('cur'))} ELSE {float_text_sql('cur')} END AS actual",
        "CASE WHEN nw = 0 THEN CAST(NULL AS DOUBLE) WHEN base = 0 THEN 0.0D ELSE base_r END AS expected_num",
        f"{round2_sql('cur')} AS actual_num",
        f"{round2_sql('wow')} AS gap",
        "CASE WHEN graded THEN lim END AS tolerance",
        "CASE WHEN graded THEN 'pct' END AS gap_unit",
        f"CASE WHEN nw = 0 THEN format_string({L(M.TREND_NO_HISTORY)}, array_join(lookback, ', ')) "
        f"WHEN base = 0 THEN format_string({L(M.TREND_ZERO_BASELINE)}, nw) "
        f"ELSE format_string({L(M.TREND_CHANGE)}, {label}, wow, lim_text) END AS detail",
        "base_r AS baseline",
        f"{round2_sql('cur')} AS current",
        f"{round2_sql('wow')} AS change_pct",
        "nw AS n_weeks",
    )


# ── C5 completeness ─────────────────────────────────────────────────────────

_DIM_SCHEMA = T.StructType([_i("check_seq"), _s("dimension")])
_ITEM_SCHEMA = T.StructType([_i("check_seq"), _s("dimension"), _s("value"), _s("kind"), _i("pos"), _s("effective_week"), _s("until_week")])
_VALUE_KEYS = ["dashboard", "run_week", "check_seq", "dimension", "value"]


def _completeness_frames(spark: SparkSession, base: Base) -> tuple[DataFrame, DataFrame]:
    """(run × check rows, one row per run × check × value with its flags).

    Whether a present value was seen in the lookback is read off one sorted
    pass over the periods of each (dimension, value): a range frame on the
    period index, without a row for every lookback period.  Present and
    configured values (required, optional, scheduled appearances and
    disappearances, while effective) are tagged and unioned, then grouped by
    value: NULL is its own group, so matching is null-safe without anti-joins,
    and every group holds at most one present row and the registry's entries.
    """
    spec = base.spec
    grain = grain_of(spec.grain)
    dim_rows = [(c.seq, c.dimension) for c in spec.completeness]
    spec_rows = []
    for c in spec.completeness:
        spec_rows += [(c.seq, c.dimension, v, "required", i, None, None) for i, v in enumerate(c.required)]
        spec_rows += [(c.seq, c.dimension, v, "optional", i, None, None) for i, v in enumerate(c.optional)]
        spec_rows += [(c.seq, c.dimension, value, change, None, begin, until) for value, change, begin, until in spec.change_intervals(c.dimension)]

    run_dims = expand(base.runs, dim_rows, _DIM_SCHEMA)
    dims = F.broadcast(spark.createDataFrame(dim_rows, _DIM_SCHEMA))  # registry-sized
    groups = base.groups.where(f"side = '{DASH}' AND dim != '{WEEK_LEVEL}'")
    seen = Window.partitionBy("dashboard", "dimension", "value").orderBy(grain.index(F.col("run_week"))).rangeBetween(-spec.lookback, -1)
    present = (
        groups.where("wk IS NOT NULL")
        .selectExpr("dashboard", "wk AS run_week", "dim AS dimension", "key AS value")
        .join(dims, ["dimension"])
        .withColumn("past", F.count_if(grain.is_history_label(F.col("run_week"))).over(seen))
        .join(base.runs, ["dashboard", "run_week"], "left_semi")
    )
    items = present.selectExpr(*_VALUE_KEYS, "CASE WHEN past > 0 THEN 'seen' ELSE 'present' END AS kind", "CAST(NULL AS INT) AS pos")
    if spec_rows:
        configured = (
            expand(base.runs, spec_rows, _ITEM_SCHEMA)
            # As of the run's week: a change holds until the next one of its value.
            .where("(effective_week IS NULL OR run_week >= effective_week) AND (until_week IS NULL OR run_week < until_week)")
            .select(*_VALUE_KEYS, "kind", "pos")
        )
        items = items.unionByName(configured)
    values = items.groupBy(*_VALUE_KEYS).agg(
        F.expr("max(kind IN ('present', 'seen')) AS is_present"),
        # required values stay known even after a scheduled disappearance
        F.expr("max(kind IN ('seen', 'required', 'optional', 'appears')) AS is_known"),
        F.expr("max(kind = 'disappears') AS is_gone"),
        F.expr("collect_list(CASE WHEN kind = 'required' THEN pos END) AS req_pos"),
    )
    values = values.selectExpr(
        *_VALUE_KEYS,
        "is_present",
        "is_known",
        # positions at which the value is (still) required; duplicates in the list count twice
        "CASE WHEN is_gone THEN CAST(array() AS ARRAY<INT>) ELSE req_pos END AS req_pos",
    )
    return run_dims, values


def completeness_values(spark: SparkSession, base: Base) -> tuple[DataFrame, DataFrame] | None:
    """(missing_values, new_values): one row per value, nothing concatenated."""
    if not base.spec.completeness:
        return None
    _, values = _completeness_frames(spark, base)
    missing = values.where("NOT is_present AND size(req_pos) > 0").selectExpr(*_VALUE_KEYS, "explode(req_pos) AS pos")
    new = values.where("is_present AND NOT is_known").select(*_VALUE_KEYS)
    return missing, new


def completeness(spark: SparkSession, base: Base) -> DataFrame | None:
    spec = base.spec
    if not spec.completeness:
        return None
    run_dims, values = _completeness_frames(spark, base)
    keys = ["dashboard", "run_week", "check_seq"]
    counts = values.groupBy(*keys).agg(
        F.expr("sum(size(req_pos)) AS n_required"),
        F.expr("sum(CASE WHEN is_present THEN 0 ELSE size(req_pos) END) AS n_missing"),
        F.expr("count_if(is_present AND NOT is_known) AS n_new"),
        F.expr("count_if(is_present) AS n_present"),
        # Only missing required entries are listed: bounded by the registry.
        F.expr(
            "array_join(transform(array_sort(flatten(collect_list(CASE WHEN NOT is_present AND size(req_pos) > 0 "
            "THEN transform(req_pos, p -> named_struct('pos', p, 'v', coalesce(value, 'None'))) END))), x -> x.v), ', ') "
            "AS missing_values"
        ),
        # The same entries as a list is printed: each value in quotation marks, None without.
        F.expr(
            "array_join(transform(array_sort(flatten(collect_list(CASE WHEN NOT is_present AND size(req_pos) > 0 "
            "THEN transform(req_pos, p -> named_struct('pos', p, 'v', coalesce(concat(\"'\", value, \"'\"), 'None'))) END))), x -> x.v), ', ') "
            "AS missing_listed"
        ),
    )
    j = run_dims.join(counts, keys, "left")
    j = j.selectExpr(
        "*",
        "CAST(coalesce(n_required, 0) AS BIGINT) AS c_req",
        "CAST(coalesce(n_missing, 0) AS BIGINT) AS c_miss",
        "CAST(coalesce(n_new, 0) AS BIGINT) AS c_new",
        "CAST(coalesce(n_present, 0) AS BIGINT) AS c_present",
    )
    missing_part = (
        f"CASE WHEN c_miss > 0 THEN format_string({L(M.COMPLETENESS_MISSING)}, dimension, missing_listed) "
        f"ELSE format_string({L(M.COMPLETENESS_ALL_PRESENT)}, c_req, dimension) END"
    )
    new_part = f"CASE WHEN c_new > 0 THEN format_string({L(M.COMPLETENESS_NEW)}, dimension, {int(spec.lookback)}, c_new) ELSE '' END"
    return j.selectExpr(
        "dashboard",
        "run_week",
        "check_seq",
        "'completeness' AS check_name",
        "concat(dimension, '_completeness') AS metric",
        f"CASE WHEN c_miss = 0 AND c_new > 0 THEN '{DRIFT}' ELSE {count_ladder_sql('c_miss')} END AS status",
        "CAST(c_req AS STRING) AS expected",
        "CAST(c_present AS STRING) AS actual",
        "CAST(c_req AS DOUBLE) AS expected_num",
        "CAST(c_present AS DOUBLE) AS actual_num",
        "CAST(NULL AS DOUBLE) AS gap",
        "CAST(NULL AS DOUBLE) AS tolerance",
        "CAST(NULL AS STRING) AS gap_unit",
        f"concat({missing_part}, {new_part}) AS detail",
        "c_miss AS n_missing",
        "c_new AS n_new",
        "coalesce(missing_values, '') AS missing_values",
        "dimension",
    )


# ── C6 sanity_range ─────────────────────────────────────────────────────────


def sanity_range(spark: SparkSession, base: Base) -> DataFrame | None:
    spec = base.spec
    if not spec.sanity:
        return None
    rows = [(r.seq, r.name, r.expression, j) for j, r in enumerate(spec.sanity)]
    schema = T.StructType([_i("check_seq"), _s("rule"), _s("expression"), _i("ridx")])
    wk = base.groups.where((F.col("side") == DASH) & (F.col("dim") == WEEK_LEVEL)).select(
        "dashboard",
        F.col("wk").alias("run_week"),
        "n_rows",
        F.array(*[F.col(f"r{j}") for j in range(len(spec.sanity))]).alias("violation_counts"),
    )
    j = expand(base.runs, rows, schema).join(wk, ["dashboard", "run_week"], "left")
    j = j.selectExpr(
        "*",
        "CAST(coalesce(n_rows, 0) AS BIGINT) AS total",
        "CAST(coalesce(element_at(violation_counts, ridx + 1), 0) AS BIGINT) AS viol",
    ).selectExpr("*", "CASE WHEN total = 0 THEN CAST(0 AS BIGINT) ELSE viol END AS act")
    return j.selectExpr(
        "dashboard",
        "run_week",
        "check_seq",
        "'sanity_range' AS check_name",
        "rule AS metric",
        f"CASE WHEN total = 0 OR viol = 0 THEN '{PASS}' ELSE '{FAIL}' END AS status",
        "'0' AS expected",
        "CAST(act AS STRING) AS actual",
        "0.0D AS expected_num",
        "CAST(act AS DOUBLE) AS actual_num",
        "CAST(NULL AS DOUBLE) AS gap",
        "CAST(NULL AS DOUBLE) AS tolerance",
        "CAST(NULL AS STRING) AS gap_unit",
        f"CASE WHEN total = 0 THEN format_string({L(M.SANITY_NO_ROWS)}, run_week) "
        f"WHEN viol = 0 THEN format_string({L(M.SANITY_ALL_OK)}, total, rule) "
        f"ELSE format_string({L(M.SANITY_VIOLATIONS)}, viol, total, rule, expression) END AS detail",
        "total AS n_rows",
        "viol AS violations",
    )


CHECK_BUILDERS = [freshness, reconciliation, trend_sanity, parts_sum, completeness, sanity_range]
