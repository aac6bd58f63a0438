"""Trends per segment by prefix sums against a plain computation."""

import random
from decimal import Decimal

import pytest

from tallyho.plans.periods import trend_segments, trend_window
from tallyho.plans.suite import Suite


def idx(label):
    return int(label[:4]) * 52 + int(label[5:])


@pytest.mark.parametrize("n", [1, 4, 60])
def test_segments_equal_a_plain_computation(spark, n):
    r = random.Random(n)
    weeks = [f"{y}-{w:02d}" for y in (2020, 2021) for w in range(1, 54) if (w < 53 or y == 2020) and r.random() < 0.8]
    rows = [(w, s, Decimal(r.randrange(-300, 900)) / 100) for w in weeks for s in ("a", "b", None) if r.random() < (0.9 if s == "a" else 0.3)] + [(None, "a", Decimal("9.00"))]
    facts = spark.createDataFrame(rows, "wk string, shop string, spend decimal(18,2)")
    reg = {"dashboard": "d", "dashboard_table": facts, "source_table": facts, "date_column": "wk", "metrics": [{"name": "spend", "checks": ["reconciliation", "trend_sanity"]}], "checks": {"parts_sum": {"pivot_columns": ["shop"]}}}
    base = Suite(spark, reg, only=("trend_sanity", "parts_sum")).base
    got = {(x["dimension"], x["segment"], x["run_week"]): (x["baseline"], x["current"], x["n_weeks"], x["status"]) for x in trend_segments(base, n, 50.0, "shop").collect()}
    total = {}
    for w, s, a in rows:
        if w:
            for k in (("", None), ("shop", s)):
                total.setdefault(k, {}).setdefault(w, Decimal(0))
                total[k][w] += a
    present = {w for w, _, _ in rows if w}
    want = {}
    for (d, s), own in total.items():
        for w in present:
            if idx(w) < min(map(idx, own)):
                continue
            hist = [own[h] for h in own if h[5:] != "53" and idx(w) - n <= idx(h) < idx(w)]
            cur, base_ = own.get(w, Decimal(0)), sum(hist, Decimal(0)) / len(hist) if hist else None
            wow = abs(float(cur - base_) / abs(float(base_)) * 100) if base_ else None
            status = "PASS" if wow is None or wow <= 50 else "DRIFT" if wow <= 75 else "FAIL"
            want[d, s, w] = (None if base_ is None else pytest.approx(float(base_), abs=0.0051), float(cur), len(hist), status)
    assert got == want
    overall = {x["run_week"]: (x["baseline"], x["current"], x["change_pct"], x["n_weeks"], x["status"]) for x in trend_window(base, n, 50.0).where("run_week IS NOT NULL").collect()}
    own = {x["run_week"]: (x["baseline"], x["current"], x["change_pct"], x["n_weeks"], x["status"]) for x in trend_segments(base, n, 50.0, "shop").where("dimension = ''").collect()}
    assert own == overall


def test_totals_without_a_decimal_text(spark):
    rows = [("2020-01", "a", 1.0), ("2020-02", "a", float("nan")), ("2020-03", "a", 2.0), ("2020-04", "a", 4.0), ("2020-05", "a", 4.0)]
    facts = spark.createDataFrame(rows, "wk string, shop string, spend double")
    reg = {"dashboard": "d", "dashboard_table": facts, "source_table": facts, "date_column": "wk", "metrics": [{"name": "spend", "checks": ["reconciliation", "trend_sanity"]}], "checks": {"parts_sum": {"pivot_columns": ["shop"]}}}
    got = {x["run_week"]: (str(x["baseline"]), x["status"]) for x in trend_segments(Suite(spark, reg).base, 1, 50.0, "shop").where("segment = 'a'").collect()}
    assert got == {"2020-01": ("None", "PASS"), "2020-02": ("1.0", "FAIL"), "2020-03": ("nan", "FAIL"), "2020-04": ("2.0", "FAIL"), "2020-05": ("4.0", "PASS")}
