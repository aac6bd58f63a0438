"""Dashboard/source pairs derived by Spark from the driver's test tables.

Every fixture is a lazy transformation of a whole test table, so the work of
each query grows with the table.  The DuckDB oracle repeats the same
derivations in SQL (see ``tallyho.oracle``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyho.functions.periods import week_label
from tallyho.sources.tables import testdata


# Week label of a date/timestamp in SQL (same rule as functions.periods.week_label).
_WEEK = "concat(CAST(extract(YEAROFWEEK FROM {c}) AS STRING), '-', lpad(CAST(extract(WEEK FROM {c}) AS STRING), 2, '0'))"


def events_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 source table: weekly event facts with two pivots, a row class and two metrics."""
    return source_facts(testdata(spark, sf_dir, "events"))


def source_facts(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id",
        f"{_WEEK.format(c='ts')} AS wk",
        "CASE WHEN event_id % 40 = 5 THEN CAST(NULL AS STRING) ELSE event_type END AS platform",
        "CASE WHEN user_id % 2 = 0 THEN 'Paid' ELSE 'Organic' END AS pillar",
        "CASE WHEN event_id % 10 = 0 THEN 'Budget' WHEN event_id % 10 = 1 THEN CAST(NULL AS STRING) ELSE 'Actual' END AS data_type",
        "CAST(value AS DECIMAL(18,2)) AS spend",
        "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS interactions",
    )


def events_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 dashboard table: the source with a mislabel, a scaled week, negative rows and a dropped slice."""
    return dashboard_facts(testdata(spark, sf_dir, "events"))


def dashboard_facts(events: DataFrame) -> DataFrame:
    return (
        source_facts(events)
        .where("NOT (wk = '2024-02' AND platform = 'signup')")
        .selectExpr(
            "event_id",
            "wk",
            "CASE WHEN wk = '2024-04' AND platform = 'view' AND event_id % 4 = 3 THEN 'click' "
            "WHEN wk = '2024-02' AND platform = 'purchase' AND event_id % 9 = 7 THEN 'beta' ELSE platform END AS platform",
            "pillar",
            "data_type",
            "CASE WHEN wk = '2024-03' THEN CAST(spend * CAST(1.02 AS DECIMAL(3,2)) AS DECIMAL(18,2)) "
            "WHEN wk = '2024-01' AND event_id % 100 = 3 THEN -spend ELSE spend END AS spend",
            "interactions",
        )
    )


def events_registry(spark: SparkSession, sf_dir: str, **overrides) -> dict:
    """F1 configuration: tolerance 1.0, pivots platform and pillar, lookback 4."""
    reg = {
        "dashboard": "events_dashboard",
        "dashboard_table": events_dashboard(spark, sf_dir),
        "source_table": events_source(spark, sf_dir),
        "date_column": "wk",
        "lookback_weeks": 4,
        "metrics": [
            {"name": "spend", "tolerance_pct": 1.0, "checks": ["reconciliation", "trend_sanity"]},
            {"name": "interactions", "tolerance_pct": 1.0, "checks": ["reconciliation", "trend_sanity"]},
        ],
        "dimensions": [
            {
                "name": "platform",
                "completeness_check": True,
                "required_values": ["click", "error", "purchase", "signup", "view"],
                "optional_values": [],
            }
        ],
        "checks": {
            "freshness": {"enabled": True},
            "reconciliation": {"enabled": True},
            "parts_sum": {"enabled": True, "pivot_columns": ["platform", "pillar"]},
            "trend_sanity": {"enabled": True, "max_wow_change_pct": 50.0},
            "completeness": {"enabled": True},
            "sanity_range": {"enabled": True, "rules": [{"name": "spend_non_negative", "expression": "spend < 0"}]},
        },
    }
    reg.update(overrides)
    return reg


def lineitem_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """weekly shipped quantity and revenue by segment (return flag) and pillar (line status)."""
    return testdata(spark, sf_dir, "lineitem").selectExpr(
        f"{_WEEK.format(c='l_shipdate')} AS wk",
        "l_returnflag AS segment",
        "l_linestatus AS pillar",
        "CAST(l_quantity AS DECIMAL(18,2)) AS quantity",
        "CAST(l_extendedprice AS DECIMAL(18,2)) AS revenue",
    )


def lineitem_registry(spark: SparkSession, sf_dir: str, **overrides) -> dict:
    facts = lineitem_facts(spark, sf_dir)
    reg = {
        "dashboard": "lineitem_backfill",
        "dashboard_table": facts,
        "source_table": facts,
        "date_column": "wk",
        "lookback_weeks": 4,
        "metrics": [
            {"name": "quantity", "tolerance_pct": 1.0, "checks": ["reconciliation", "trend_sanity"]},
            {"name": "revenue", "tolerance_pct": "2%", "checks": ["reconciliation", "trend_sanity"]},
        ],
        "dimensions": [{"name": "segment", "completeness_check": True, "required_values": ["A", "N", "R"]}],
        "checks": {
            "parts_sum": {"pivot_columns": ["segment", "pillar"]},
            "trend_sanity": {"max_wow_change_pct": 20.0},
            "sanity_range": {"rules": [{"name": "quantity_positive", "expression": "quantity <= 0"}]},
        },
    }
    reg.update(overrides)
    return reg


def orders_date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 date dimension: every order date with its week label."""
    o = testdata(spark, sf_dir, "orders")
    d = F.col("o_orderdate").cast("date")
    return o.select(d.alias("full_date")).distinct().select("full_date", week_label(F.col("full_date")).alias("fiscal_yr_and_wk_desc"))


def orders_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-grain facts: order value per order date (DATE period column)."""
    o = testdata(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("total_price"),
    )
