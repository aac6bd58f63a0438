"""The stored base that grows with files; bases of some checks only; scheduled changes as intervals."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyho.config import normalize
from tallyho.operators.base import build_base
from tallyho.plans.stored import StoredBase
from tallyho.plans.suite import Suite
from tallyho.session import scratch_path

FACTS = "wk string, shop string, spend decimal(18,2), units double"


def rows(*triples):
    return [(w, s, None if a is None else Decimal(a), float(i)) for i, (w, s, a) in enumerate(triples)]


def registry(table, source, **more):
    return {
        "dashboard": "shops",
        "dashboard_table": table,
        "source_table": source,
        "date_column": "wk",
        "lookback_weeks": 2,
        "metrics": [{"name": "spend", "checks": ["reconciliation", "trend_sanity"]}, {"name": "units", "checks": ["reconciliation"]}],
        "dimensions": [{"name": "shop", "completeness_check": True, "required_values": ["north"]}],
        "checks": {"parts_sum": {"pivot_columns": ["shop"]}, "sanity_range": {"rules": [{"name": "positive", "expression": "spend < 0"}]}},
    } | more


def put(spark, path, name, data):
    spark.createDataFrame(data, FACTS).coalesce(1).write.parquet(f"{path}/{name}")


def same(stored_suite, plain_suite):
    read = lambda s: sorted(map(str, s.check_results().collect()))
    assert read(stored_suite) == read(plain_suite) != []


def both(spark, path):
    return spark.read.option("recursiveFileLookup", "true").schema(FACTS).parquet(path)


def test_only_new_files_are_read_and_results_equal_a_fresh_base(spark):
    dash, src, folder = (scratch_path(spark, f"test-{x}") for x in ("dash", "src", "state"))
    for p in (dash, src):
        put(spark, p, "a", rows(("2024-01", "north", "10.00"), ("2024-02", "north", "12.00"), ("2024-02", None, "-1.00"), (None, "x", "3.00")))
    stored = StoredBase(spark, registry(dash, src), folder)
    assert stored.refresh() == {"dash": 1, "src": 1}
    weeks = lambda s: sorted(r["run_week"] for r in s.due().collect())
    assert weeks(stored) == ["2024-01", "2024-02"]
    plain = lambda runs=None: Suite(spark, registry(both(spark, dash), both(spark, src)), runs=runs)
    same(stored.suite(), plain())
    stored.finished()

    put(spark, dash, "late", rows(("2024-02", "south", "5.00")))
    again = StoredBase(spark, registry(dash, src), folder)
    assert again.refresh() == {"dash": 1, "src": 0}  # the late file alone
    assert weeks(again) == ["2024-02"]
    same(again.suite(), plain(["2024-02"]))

    # The job is lost before it finished: nothing is read again, and the week is still due.
    third = StoredBase(spark, registry(dash, src, metrics=[{"name": "spend", "tolerance_pct": 90, "checks": ["reconciliation", "trend_sanity"]}, {"name": "units", "tolerance_pct": 90, "checks": ["reconciliation"]}]), folder)
    assert third.refresh() == {"dash": 0, "src": 0}
    assert weeks(third) == ["2024-02"]
    assert 90.0 in {r["tolerance"] for r in third.suite().reconciliation().collect()}
    third.finished()
    assert weeks(third) == []
    assert third.suite().check_results().isEmpty()


def test_changed_and_removed_files(spark):
    dash, folder = scratch_path(spark, "test-dash"), scratch_path(spark, "test-state")
    reg = {"dashboard": "d", "dashboard_table": dash, "date_column": "wk", "metrics": [{"name": "spend", "checks": ["trend_sanity"]}]}
    put(spark, dash, "a", rows(("2024-01", "n", "10.00"), ("2024-02", "n", "10.00")))
    put(spark, dash, "b", rows(("2024-03", "n", "10.00")))
    stored = StoredBase(spark, reg, folder)
    stored.refresh()
    stored.finished()
    spark.createDataFrame(rows(("2024-03", "n", "77.00"), ("2024-03", "s", "1.00")), FACTS).coalesce(1).write.mode("overwrite").parquet(f"{dash}/b")
    again = StoredBase(spark, reg, folder)
    assert again.refresh() == {"dash": 1}
    assert [r["run_week"] for r in again.due().collect()] == ["2024-03"]
    assert [(r["current"], r["baseline"]) for r in again.suite().trend_sanity().collect()] == [(78.0, 10.0)]
    again.finished()
    spark.createDataFrame([], FACTS).coalesce(1).write.mode("overwrite").parquet(f"{dash}/a")  # the file's rows are withdrawn
    gone = StoredBase(spark, reg, folder)
    gone.refresh()
    assert sorted(r["run_week"] for r in gone.due().collect()) == ["2024-01", "2024-02"]
    assert {(r["run_week"], r["current"]) for r in gone.suite().trend_sanity().collect()} == {("2024-01", 0.0), ("2024-02", 0.0)}


def test_repeated_states_count_once(spark):
    dash, folder = scratch_path(spark, "test-dash"), scratch_path(spark, "test-state")
    reg = {"dashboard": "d", "dashboard_table": dash, "date_column": "wk", "metrics": [{"name": "spend", "checks": ["trend_sanity"]}]}
    put(spark, dash, "a", rows(("2024-01", "n", "10.00"), ("2024-01", "n", None)))
    stored = StoredBase(spark, reg, folder)
    stored.refresh()
    states = spark.read.parquet(f"{stored.folder}/states/dash")
    states.write.mode("append").parquet(f"{stored.folder}/states/dash")  # a write that was repeated
    assert [r["current"] for r in stored.suite().trend_sanity().collect()] == [10.0]


def test_a_base_of_some_checks_holds_no_more(spark):
    facts = spark.createDataFrame(rows(("2024-01", "north", "10.00"), ("2024-02", "north", "12.00")), FACTS)
    more = facts.union(spark.createDataFrame(rows(("2024-03", "north", "1.00")), FACTS))
    reg = registry(facts, more)
    spec = normalize(reg)
    for kinds, columns, dims in ((("freshness",), {"n_rows"}, {""}), (("trend_sanity",), {"n_rows", "m0"}, {""}), (("completeness",), {"n_rows"}, {"", "shop"}), (("sanity_range",), {"n_rows", "r0"}, {""})):
        base = build_base(spark, spec.only(*kinds))
        stored = spark.read.parquet(base.path).where("side IN ('dash', 'src')")
        assert {c for c in stored.columns if c == "n_rows" or c[1:].isdigit()} == columns
        assert {r["dim"] for r in stored.select("dim").distinct().collect()} == dims
        # A period of the source alone is a run still.
        assert sorted(r["run_week"] for r in base.runs.collect()) == ["2024-01", "2024-02", "2024-03"]
    part, whole = Suite(spark, reg, only=("trend_sanity", "parts_sum")), Suite(spark, reg)
    want = sorted(map(str, whole.check_results().where(F.col("check_name").isin("trend_sanity", "parts_sum")).collect()))
    assert sorted(map(str, part.check_results().collect())) == want
    with pytest.raises(ValueError):
        spec.only("trend")


def test_a_base_serves_other_tolerances_but_no_other_columns(spark):
    facts = spark.createDataFrame(rows(("2024-01", "north", "10.00")), FACTS)
    suite = Suite(spark, registry(facts, facts))
    other = registry(facts, facts)
    other["metrics"] = [dict(m, tolerance_pct=7) for m in other["metrics"]]
    assert {r["tolerance"] for r in Suite(spark, other, base=suite.base).reconciliation().where("metric = 'spend'").collect()} == {7.0}
    other["metrics"] = other["metrics"][:1]
    with pytest.raises(ValueError):
        Suite(spark, other, base=suite.base)


def test_the_last_effective_change_holds(spark):
    facts = spark.createDataFrame(rows(*((f"2024-{w:02d}", s, "1.00") for w in (4, 10, 30, 40) for s in ("north", "beta"))), FACTS)
    changes = [("south", "disappears", "2024-05"), ("south", "appears", "2024-20"), ("beta", "appears", "2024-01"), ("beta", "disappears", "2024-35"), ("beta", "appears", "2024-35")]
    reg = registry(facts, facts, lookback_weeks=1, dimensions=[{"name": "shop", "completeness_check": True, "required_values": ["north", "south"]}])
    reg["expected_changes"] = [{"dimension": "shop", "value": v, "change": c, "effective_week": w} for v, c, w in changes]
    spec = normalize(reg)
    assert ("south", "disappears", "2024-05", "2024-20") in spec.change_intervals("shop")
    got = {r["run_week"]: (r["n_missing"], r["n_new"]) for r in Suite(spark, reg, only=("completeness",)).completeness().collect()}
    assert got == {"2024-04": (1, 0), "2024-10": (0, 0), "2024-30": (1, 0), "2024-40": (1, 0)}


def test_the_latest_period_is_looked_for_from_the_runs_on(spark, monkeypatch):
    from tallyho.operators import base as B

    facts = spark.createDataFrame(rows(("2024-01", "north", "1.00"), ("2024-20", "north", "1.00"), ("2024-30", "north", "1.00")), FACTS)
    whole = []
    scan = B.latest_period
    monkeypatch.setattr(B, "latest_period", lambda *a: whole.append(1) or scan(*a))
    latest = lambda runs: {(r["run_week"], r["latest_week"], r["status"]) for r in Suite(spark, registry(facts, facts), runs=runs, only=("freshness",)).freshness().collect()}
    assert latest(["2024-20"]) == {("2024-20", "2024-30", "FAIL")} and latest(["2024-30"]) == {("2024-30", "2024-30", "PASS")} and not whole
    assert latest(spark.createDataFrame([("2024-21",)], "run_week string")) == {("2024-21", "2024-30", "FAIL")} and not whole
    assert latest(["2024-50"]) == {("2024-50", "2024-30", "FAIL")} and whole == [1]  # nothing from there on
    pushed = facts.where(B.period_from(facts, "wk", "2024-18"))
    assert pushed.count() == 2
