"""Branch-level behaviour of every check on hand-made tables."""

from decimal import Decimal

import pytest

from tallyho.plans.suite import Suite

SCHEMA = "wk string, platform string, data_type string, spend decimal(18,2), clicks bigint"


def frame(spark, rows):
    return spark.createDataFrame(
        [(w, p, t, None if s is None else Decimal(str(s)), c) for w, p, t, s, c in rows], SCHEMA
    )


def registry(dash, src, **kw):
    reg = {
        "dashboard": "t",
        "dashboard_table": dash,
        "source_table": src,
        "date_column": "wk",
        "lookback_weeks": 2,
        "metrics": [{"name": "spend", "tolerance_pct": 1.0, "checks": ["reconciliation", "trend_sanity"]}],
        "checks": {"parts_sum": {"pivot_columns": ["platform"]}},
    }
    reg.update(kw)
    return reg


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def test_reconciliation_ladder_edges(spark):
    # source 100 each week; dashboard exactly at t, at 3t, above 3t; zero/zero; zero source
    src = frame(spark, [("2024-01", "a", "Actual", 100, 1), ("2024-02", "a", "Actual", 100, 1), ("2024-03", "a", "Actual", 100, 1), ("2024-05", "a", "Actual", 0, 1)])
    dash = frame(spark, [("2024-01", "a", "Actual", 101, 1), ("2024-02", "a", "Actual", 103, 1), ("2024-03", "a", "Actual", 103.01, 1), ("2024-05", "a", "Actual", 5, 1)])
    s = Suite(spark, registry(dash, src), runs=["2024-01", "2024-02", "2024-03", "2024-04", "2024-05"])
    r = by(s.reconciliation(), "run_week")
    assert r["2024-01"]["status"] == "PASS" and r["2024-01"]["gap"] == 1.0
    assert r["2024-02"]["status"] == "DRIFT"
    assert r["2024-03"]["status"] == "FAIL"
    zero = r["2024-04"]  # no rows in either table
    assert (zero["status"], zero["expected"], zero["actual"], zero["gap"], zero["tolerance"]) == ("PASS", "0", "0", None, None)
    assert r["2024-05"]["status"] == "FAIL" and r["2024-05"]["gap_pct"] == 100.0
    assert r["2024-01"]["expected"] == "100.0" and r["2024-01"]["actual"] == "101.0"


def test_budget_rows_excluded_and_null_class_kept(spark):
    src = frame(spark, [("2024-01", "a", "Actual", 100, 1), ("2024-01", "a", None, 50, 1), ("2024-01", "a", "Budget", 999, 1)])
    dash = frame(spark, [("2024-01", "a", "Actual", 150, 1)])
    r = by(Suite(spark, registry(dash, src), runs=["2024-01"]).reconciliation(), "run_week")["2024-01"]
    assert r["status"] == "PASS" and r["expected_num"] == 150.0


def test_freshness(spark):
    dash = frame(spark, [("2024-01", "a", "Actual", 1, 1), ("2024-02", "a", "Actual", 1, 1), ("2024-03", "a", "Budget", 1, 1)])
    s = Suite(spark, registry(dash, dash), runs=["2024-02", "2024-01", "2024-03"])
    f = by(s.freshness(), "run_week")
    assert f["2024-02"]["status"] == "PASS" and f["2024-02"]["actual"] == "2024-02"
    assert f["2024-01"]["status"] == "FAIL"  # later data than expected also fails
    assert f["2024-03"]["status"] == "FAIL"  # budget-only week does not count
    empty = frame(spark, [])
    f = by(Suite(spark, registry(empty, empty), runs=["2024-02"]).freshness(), "run_week")
    assert f["2024-02"]["status"] == "FAIL" and f["2024-02"]["actual"] is None


def test_parts_sum_null_keys_zero_groups_and_counts(spark):
    src = frame(
        spark,
        [
            ("2024-01", None, "Actual", 100, 1),
            ("2024-01", "a", "Actual", 100, 1),
            ("2024-01", "z", "Actual", 0, 1),  # zero source group: skipped even though dashboard differs
            ("2024-01", "b", "Actual", 100, 1),
        ],
    )
    dash = frame(
        spark,
        [
            ("2024-01", None, "Actual", 100, 1),  # NULL matches NULL
            ("2024-01", "a", "Actual", 100.5, 1),
            ("2024-01", "z", "Actual", 7, 1),
            ("2024-01", "extra", "Actual", 5, 1),  # dashboard-only group: never compared
        ],
    )
    s = Suite(spark, registry(dash, src), runs=["2024-01"])
    p = by(s.parts_sum(), "run_week")["2024-01"]
    # 'b' missing in the dashboard → 100 % gap → the only failing group → DRIFT
    assert (p["status"], p["expected"], p["actual"], p["n_failing"], p["metric"]) == ("DRIFT", "4", "4", 1, "spend_by_platform")
    detail = by(s.parts_sum_detail(), "pivot_value")
    assert detail["b"]["is_failing"] and not detail["a"]["is_failing"] and not detail[None]["is_failing"]
    assert detail["z"]["gap_pct"] is None


def test_parts_sum_boundary_is_strict(spark):
    src = frame(spark, [("2024-01", "a", "Actual", 100, 1), ("2024-01", "b", "Actual", 100, 1)])
    dash = frame(spark, [("2024-01", "a", "Actual", 101, 1), ("2024-01", "b", "Actual", 101.01, 1)])
    p = by(Suite(spark, registry(dash, src), runs=["2024-01"]).parts_sum(), "run_week")["2024-01"]
    assert p["n_failing"] == 1 and p["status"] == "DRIFT"


def test_trend_branches(spark):
    rows = [
        ("2024-01", "a", "Actual", 100, 1),
        ("2024-02", "a", "Actual", 200, 1),
        ("2024-03", "a", "Actual", 225, 1),  # baseline (100+200)/2 = 150 → +50 % exactly: PASS at limit 50
        ("2024-04", "a", "Actual", 318.75, 1),  # baseline 212.5 → +50 %: PASS; see 1.5m edge below
        ("2024-06", "a", "Actual", 0, 1),
        ("2024-07", "a", "Actual", 10, 1),  # baseline over 2024-06 only (2024-05 absent) = 0 → skipped
    ]
    dash = frame(spark, rows)
    s = Suite(spark, registry(dash, dash, checks={"trend_sanity": {"max_wow_change_pct": 50.0}}), runs=["2024-01", "2024-03", "2024-04", "2024-07", "2024-10"])
    t = by(s.trend_sanity(), "run_week")
    assert t["2024-01"]["status"] == "PASS" and t["2024-01"]["expected"] is None and t["2024-01"]["n_weeks"] == 0
    assert t["2024-03"]["status"] == "PASS" and t["2024-03"]["gap"] == 50.0 and t["2024-03"]["n_weeks"] == 2
    assert t["2024-07"]["status"] == "PASS" and t["2024-07"]["expected"] == "0.0" and t["2024-07"]["gap"] is None
    cur = t["2024-10"]  # current week absent → 0 → no history either (2024-08, 2024-09 empty)
    assert cur["n_weeks"] == 0 and cur["actual_num"] == 0.0
    s = Suite(spark, registry(dash, dash, checks={"trend_sanity": {"max_wow_change_pct": 20.0}}), runs=["2024-03", "2024-04"])
    t = by(s.trend_sanity(), "run_week")
    assert t["2024-03"]["status"] == "FAIL"  # 50 > 1.5 × 20
    s = Suite(spark, registry(dash, dash, checks={"trend_sanity": {"max_wow_change_pct": 100 / 3}}), runs=["2024-03"])
    assert by(s.trend_sanity(), "run_week")["2024-03"]["status"] == "DRIFT"  # 50 ≤ 1.5 × 33.3


def _completeness(spark, present, history, required, optional):
    rows = [("2024-05", v, "Actual", 1, 1) for v in present] + [("2024-04", v, "Actual", 1, 1) for v in history]
    dash = frame(spark, rows)
    reg = registry(
        dash,
        dash,
        lookback_weeks=2,
        dimensions=[{"name": "platform", "completeness_check": True, "required_values": required, "optional_values": optional}],
    )
    s = Suite(spark, reg, runs=["2024-05"])
    row = by(s.completeness(), "run_week")["2024-05"]
    missing, new = s.completeness_values()
    return row, sorted(r["value"] for r in missing.collect()), sorted((r["value"] or "") for r in new.collect())


KNOWN = ["click", "error", "purchase", "signup", "view"]


@pytest.mark.parametrize(
    "gone,added,optional,status",
    [
        ([], [], [], "PASS"),
        (["signup"], [], [], "DRIFT"),
        (["signup"], ["beta"], [], "DRIFT"),
        (["error", "signup"], ["beta", "gamma"], [], "FAIL"),
        ([], ["beta"], ["beta"], "PASS"),
        (["view"], ["beta"], ["beta", "gamma"], "DRIFT"),
    ],
)
def test_completeness_names_what_is_missing_and_new(spark, gone, added, optional, status):
    present = [v for v in KNOWN if v not in gone] + added
    row, missing, new = _completeness(spark, present, KNOWN, KNOWN, optional)
    unknown = [v for v in added if v not in optional]
    assert (row["status"], missing, new) == (status, gone, unknown)
    assert (row["n_missing"], row["n_new"]) == (len(gone), len(unknown))
    assert (row["expected"], row["actual"]) == (str(len(KNOWN)), str(len(present)))
    assert all(v in row["detail"] for v in gone)


def test_completeness_null_value_is_new(spark):
    row, _, new = _completeness(spark, ["a", None], ["a"], ["a"], [])
    assert row["status"] == "DRIFT" and new == [""]


def test_completeness_expected_changes(spark):
    dash = frame(spark, [("2024-04", "a", "Actual", 1, 1), ("2024-04", "old", "Actual", 1, 1), ("2024-05", "a", "Actual", 1, 1), ("2024-05", "fresh", "Actual", 1, 1)])
    reg = registry(
        dash,
        dash,
        dimensions=[{"name": "platform", "completeness_check": True, "required_values": ["a", "old"]}],
        expected_changes=[
            {"dimension": "platform", "value": "old", "change": "disappears", "effective_week": "2024-05"},
            {"dimension": "platform", "value": "fresh", "change": "appears", "effective_week": "2024-05"},
        ],
    )
    row = by(Suite(spark, reg, runs=["2024-05"]).completeness(), "run_week")["2024-05"]
    assert row["status"] == "PASS" and row["n_missing"] == 0 and row["n_new"] == 0


def test_sanity_range(spark):
    dash = frame(spark, [("2024-01", "a", "Actual", 5, 1), ("2024-02", "a", "Actual", -1, 1), ("2024-02", "a", "Actual", None, 1)])
    reg = registry(dash, dash, checks={"sanity_range": {"rules": [{"name": "spend_non_negative", "expression": "spend < 0"}]}})
    r = by(Suite(spark, reg, runs=["2024-01", "2024-02", "2024-03"]).sanity_range(), "run_week")
    assert r["2024-01"]["status"] == "PASS" and r["2024-01"]["actual"] == "0"
    assert r["2024-02"]["status"] == "FAIL" and r["2024-02"]["violations"] == 1  # NULL condition is not a violation
    assert "spend_non_negative" in r["2024-02"]["detail"]
    assert r["2024-03"]["status"] == "PASS" and "skipped" in r["2024-03"]["detail"]


def test_suite_summary_and_runs_as_dataframe(spark):
    src = frame(spark, [("2024-01", "a", "Actual", 100, 1), ("2024-02", "a", "Actual", 100, 1)])
    dash = frame(spark, [("2024-01", "a", "Actual", 100, 1), ("2024-02", "a", "Actual", 150, 1)])
    runs = spark.createDataFrame([("2024-01",), ("2024-02",)], "run_week string")
    s = Suite(spark, registry(dash, src), runs=runs)
    summary = by(s.run_summary(), "run_week")
    assert summary["2024-01"]["overall_status"] == "FAIL"  # freshness: latest week is 2024-02
    assert summary["2024-02"]["fail"] >= 1
    assert summary["2024-01"]["total"] == 4  # freshness, recon, trend, parts
    res = s.check_results()
    assert res.count() == 8
    sev = {(r["run_week"], r["check_name"]): r["severity"] for r in res.collect()}
    assert sev[("2024-02", "freshness")] is None and sev[("2024-01", "freshness")] == "P2"


def test_integer_metric_sums_do_not_overflow(spark):
    big = 9_000_000_000_000_000_000
    df = spark.createDataFrame([("2024-01", "a", "Actual", Decimal(1), big), ("2024-01", "a", "Actual", Decimal(1), big)], SCHEMA)
    reg = registry(df, df, metrics=[{"name": "clicks", "checks": ["reconciliation"]}])
    r = by(Suite(spark, reg, runs=["2024-01"]).reconciliation(), "run_week")["2024-01"]
    assert r["status"] == "PASS" and r["expected_num"] == pytest.approx(1.8e19)


def test_day_grain_suite_on_date_column(spark):
    import datetime as dt

    rows = [
        (dt.date(2024, 3, 1), "a", Decimal("10.00")),
        (dt.date(2024, 3, 2), "a", Decimal("10.00")),
        (dt.date(2024, 3, 2), "b", Decimal("5.00")),
        (dt.date(2024, 3, 3), "a", Decimal("30.00")),
    ]
    df = spark.createDataFrame(rows, "day date, platform string, spend decimal(18,2)")
    reg = {
        "dashboard": "daily",
        "dashboard_table": df,
        "source_table": df.where("platform = 'a'"),
        "date_column": "day",
        "grain": "day",
        "lookback_weeks": 2,
        "metrics": [{"name": "spend", "tolerance_pct": 1.0, "checks": ["reconciliation", "trend_sanity"]}],
        "dimensions": [{"name": "platform", "completeness_check": True, "required_values": ["a", "b"]}],
        "checks": {"sanity_range": {"rules": [{"name": "neg", "expression": "spend < 0"}]}},
    }
    s = Suite(spark, reg, runs=["2024-03-02", "2024-03-03"])
    res = {(r["run_week"], r["check_name"]): r for r in s.check_results().collect()}
    assert res[("2024-03-03", "freshness")]["status"] == "PASS"
    assert res[("2024-03-02", "freshness")]["status"] == "FAIL"
    assert res[("2024-03-02", "reconciliation")]["status"] == "FAIL"  # 15 vs 10
    assert res[("2024-03-03", "reconciliation")]["status"] == "PASS"
    t = res[("2024-03-03", "trend_sanity")]
    assert t["expected_num"] == 12.5 and t["status"] == "FAIL"  # 30 vs avg(10, 15) = +140 %
    assert res[("2024-03-03", "completeness")]["status"] == "DRIFT"  # b missing
    p = res[("2024-03-02", "parts_sum")]  # b exists only in the dashboard: counted, never compared
    assert (p["status"], p["expected"], p["actual"]) == ("PASS", "1", "2")


def test_odd_column_names_and_quoted_values(spark):
    rows = [("2024-01", "it's", Decimal("1.00")), ("2024-01", "a\\b", Decimal("2.00")), ("2024-02", "it's", Decimal("1.00"))]
    df = spark.createDataFrame(rows, "`fiscal week` string, `gtm segment` string, spend decimal(18,2)")
    reg = {
        "dashboard": "odd 'name'",
        "dashboard_table": df,
        "source_table": df,
        "date_column": "fiscal week",
        "metrics": [{"name": "spend", "checks": ["reconciliation"]}],
        "dimensions": [{"name": "gtm segment", "completeness_check": True, "required_values": ["it's", "a\\b"]}],
        "checks": {"parts_sum": {"pivot_columns": ["gtm segment"]}},
    }
    res = {(r["run_week"], r["check_name"]): r for r in Suite(spark, reg).check_results().collect()}
    assert res[("2024-01", "parts_sum")]["status"] == "PASS" and res[("2024-01", "parts_sum")]["expected"] == "2"
    assert res[("2024-01", "completeness")]["status"] == "PASS"
    c = res[("2024-02", "completeness")]
    assert c["status"] == "DRIFT" and "a\\b" in c["detail"]
    assert res[("2024-02", "freshness")]["status"] == "PASS"
    assert {r["dashboard"] for r in res.values()} == {"odd 'name'"}


def test_run_frame_gives_the_results_of_a_run_list(spark):
    src = frame(spark, [("2024-01", "a", "Actual", 100, 1), ("2024-02", "a", "Actual", 100, 1), ("2024-03", "b", None, 7, 1)])
    dash = frame(spark, [("2024-01", "a", "Actual", 101, 1), ("2024-02", "b", "Actual", 90, 1), ("2024-03", "b", None, 7, 1)])
    reg = registry(dash, src, dimensions=[{"name": "platform", "completeness_check": True, "required_values": ["a"]}])
    weeks = ["2024-02", "2024-03"]

    def rows(s):
        return sorted(tuple(r) for r in s.check_results().drop("detail").collect())

    frame_runs = spark.createDataFrame([(w,) for w in weeks], "run_week string")
    assert rows(Suite(spark, reg, runs=frame_runs)) == rows(Suite(spark, reg, runs=weeks))


@pytest.mark.parametrize(
    "history,current,status",
    [
        ([float("nan")], 100.0, "FAIL"),
        ([1e30, 1e30], 1e30, "PASS"),
        ([1e-12], 1e-11, "FAIL"),
        ([0.0, 0.0], 5.0, "PASS"),
    ],
)
def test_trend_grades_any_double(spark, history, current, status):
    weeks = ["2024-05", "2024-04", "2024-03"]
    dash = spark.createDataFrame(list(zip(weeks, [current, *history])), "wk string, x double")
    reg = {"dashboard": "t", "dashboard_table": dash, "date_column": "wk", "lookback_weeks": 2, "metrics": [{"name": "x", "checks": ["trend_sanity"]}]}
    (row,) = Suite(spark, reg, runs=["2024-05"]).trend_sanity().collect()
    assert row["status"] == status and row["n_weeks"] == len(history)


def test_budget_rows_are_left_out_whatever_the_case_of_the_column(spark):
    rows = [("2024-05", "Actual", 100), ("2024-05", "Budget", 900)]
    dash, src = spark.createDataFrame(rows, "wk string, DATA_TYPE string, x bigint"), spark.createDataFrame(rows[:1], "wk string, data_type string, x bigint")
    reg = {"dashboard": "t", "dashboard_table": dash, "source_table": src, "date_column": "wk", "metrics": [{"name": "x"}]}
    (row,) = Suite(spark, reg, runs=["2024-05"]).reconciliation().collect()
    assert row["status"] == "PASS" and row["actual_num"] == 100.0


@pytest.mark.parametrize("as_frame", [False, True])
def test_timestamp_period_counts_as_its_day(spark, as_frame):
    from datetime import datetime

    table = lambda rows: spark.createDataFrame(rows, "at timestamp, x bigint")
    dash = table([(datetime(2024, 3, 4), 5), (datetime(2024, 3, 3, 23, 59), 4)])
    src = table([(datetime(2024, 3, 4, 12), 9), (datetime(2024, 3, 3, 1), 4)])
    reg = {"dashboard": "t", "dashboard_table": dash, "source_table": src, "date_column": "at", "grain": "day", "metrics": [{"name": "x"}]}
    runs = ["2024-03-03", "2024-03-04"]
    s = Suite(spark, reg, runs=spark.createDataFrame([(r,) for r in runs], "run_week string") if as_frame else runs)
    assert {k: (r["status"], r["actual_num"]) for k, r in by(s.reconciliation(), "run_week").items()} == {"2024-03-03": ("PASS", 4.0), "2024-03-04": ("FAIL", 5.0)}
    assert by(s.freshness(), "run_week")["2024-03-04"]["status"] == "PASS"


def test_source_needs_only_what_is_compared(spark):
    dash = spark.createDataFrame([("2024-05", "a", 1, 2)], "wk string, region string, x bigint, only_here bigint")
    src = spark.createDataFrame([("2024-05", 1)], "wk string, x bigint")
    reg = {
        "dashboard": "t", "dashboard_table": dash, "source_table": src, "date_column": "wk",
        "metrics": [{"name": "x"}, {"name": "only_here", "checks": ["trend_sanity"]}],
        "dimensions": [{"name": "region", "completeness_check": True, "required_values": ["a"]}],
    }
    got = {r["check_name"]: r["status"] for r in Suite(spark, reg, runs=["2024-05"]).check_results().collect()}
    assert got == {"freshness": "PASS", "reconciliation": "PASS", "trend_sanity": "PASS", "completeness": "PASS"}


def test_no_check_enabled_gives_a_typed_empty_result(spark):
    from tallyho.plans import history as H
    from tallyho.session import scratch_path

    dash = spark.createDataFrame([("2024-05", 1)], "wk string, x bigint")
    s = Suite(spark, {"dashboard": "t", "dashboard_table": dash, "date_column": "wk", "checks": {"freshness": {"enabled": False}}}, runs=["2024-05"])
    path = scratch_path(spark, "empty-log")
    H.append_log(H.log_rows(s.check_results(), "2024-02-05T06:00:00"), path)
    assert s.check_results().count() == 0


def test_stored_run_frame_bounds_the_period_scan(spark, tmp_path):
    import tallyho.operators.base as B
    from tallyho.config import normalize

    for name in ("dash", "src"):
        spark.createDataFrame([(f"2024-{w:02d}", 1) for w in range(1, 30)], "wk string, x bigint").write.partitionBy("wk").parquet(f"{tmp_path}/{name}")
    reg = {"dashboard": "t", "dashboard_table": f"{tmp_path}/dash", "source_table": f"{tmp_path}/src", "date_column": "wk", "lookback_weeks": 2, "metrics": [{"name": "x", "checks": ["reconciliation", "trend_sanity"]}], "checks": {"parts_sum": {"pivot_columns": []}}}
    plan = B.aggregate_plan(spark, normalize(reg), spark.createDataFrame([("2024-20",)], "run_week string"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert ">= 2024-18" in text and "<= 2024-20" in text and ">= 2024-20" in text


def test_one_faulty_dashboard_leaves_the_others(spark):
    import pytest
    from tallyho.plans.suite import run_suites

    facts = spark.createDataFrame([("2024-01", 5)], "wk string, amount long")
    good = {"dashboard": "sound", "dashboard_table": facts, "source_table": facts, "date_column": "wk", "metrics": [{"name": "amount"}]}
    faulty = {**good, "dashboard": "faulty", "metrics": [{"name": "no_such_column"}]}
    told = []
    results, summary = run_suites(spark, [faulty, good], on_error=lambda name, error: told.append(name))
    assert told == ["faulty"]
    assert {r["dashboard"] for r in results.collect()} == {"sound"} == {r["dashboard"] for r in summary.collect()}
    with pytest.raises(Exception, match="no_such_column"):
        run_suites(spark, [faulty, good])
