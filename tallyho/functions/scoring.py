"""Grading expressions: percentage gaps, status ladders, severity, number text.

All statuses are computed from unrounded values; rounding to two places is
applied only to the reported numbers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PASS, DRIFT, FAIL = "PASS", "DRIFT", "FAIL"

# Severity labels per status, and the ladder multipliers.
SEVERITY = {PASS: None, DRIFT: "P3", FAIL: "P2"}
RECON_DRIFT_FACTOR = 3.0
TREND_DRIFT_FACTOR = 1.5


def tier_ladder(value: Column, limit: Column, drift_factor: float) -> Column:
    """PASS up to ``limit``, DRIFT up to ``limit * drift_factor``, else FAIL (inclusive)."""
    return (
        F.when(value <= limit, F.lit(PASS))
        .when(value <= limit * F.lit(drift_factor), F.lit(DRIFT))
        .otherwise(F.lit(FAIL))
    )


def severity(status: Column) -> Column:
    return (
        F.when(status == F.lit(FAIL), F.lit(SEVERITY[FAIL]))
        .when(status == F.lit(DRIFT), F.lit(SEVERITY[DRIFT]))
        .otherwise(F.lit(None).cast("string"))
    )


def overall_status(n_fail: Column, n_drift: Column) -> Column:
    return F.when(n_fail > 0, F.lit(FAIL)).when(n_drift > 0, F.lit(DRIFT)).otherwise(F.lit(PASS))


def round2(x: Column) -> Column:
    """Round half-up to two places on the value's decimal text.

    Going through DECIMAL(38,10) makes the result independent of the last
    bits of a double (an average landing on ``.xx5`` rounds the same way in
    every engine); values beyond DECIMAL range fall back to double rounding.
    """
    return F.coalesce(F.round(x.try_cast("decimal(38,10)"), 2).cast("double"), F.round(x, 2))


# ── the same expressions as SQL text, for whole projections in one selectExpr ──
# (building a projection column by column costs several driver→JVM calls per
# operator; a SQL expression is one call however large it is)


def pct_gap_sql(expected: str, actual: str) -> str:
    return (
        f"CASE WHEN {expected} = 0 THEN (CASE WHEN {actual} != 0 THEN 100.0D ELSE 0.0D END) "
        f"ELSE abs({actual} - {expected}) / abs({expected}) * 100.0D END"
    )


def tier_ladder_sql(value: str, limit: str, drift_factor: float) -> str:
    return (
        f"CASE WHEN {value} <= {limit} THEN '{PASS}' WHEN {value} <= {limit} * {float(drift_factor)!r}D THEN '{DRIFT}' "
        f"ELSE '{FAIL}' END"
    )


def count_ladder_sql(n: str) -> str:
    return f"CASE WHEN {n} = 0 THEN '{PASS}' WHEN {n} = 1 THEN '{DRIFT}' ELSE '{FAIL}' END"


def severity_sql(status: str = "status") -> str:
    return f"CASE WHEN {status} = '{FAIL}' THEN '{SEVERITY[FAIL]}' WHEN {status} = '{DRIFT}' THEN '{SEVERITY[DRIFT]}' END"


def round2_sql(x: str) -> str:
    return f"coalesce(CAST(round(try_cast({x} AS DECIMAL(38,10)), 2) AS DOUBLE), round({x}, 2))"


def float_text_sql(x: str) -> str:
    """Plain decimal text of a double with a fractional part ('35700000.0', '0.12').

    Values that ten decimal places would lose, or DECIMAL(38,10) cannot hold, keep the double's own text.
    """
    dec = f"try_cast({x} AS DECIMAL(38,10))"
    return (
        f"CASE WHEN {x} IS NULL THEN CAST(NULL AS STRING) WHEN {dec} = 0 AND {x} != 0 THEN CAST({x} AS STRING) ELSE coalesce("
        f"regexp_replace(regexp_replace(CAST({dec} AS STRING), '0+$', ''), '[.]$', '.0'), CAST({x} AS STRING)) END"
    )
