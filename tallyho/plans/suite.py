"""A validation suite: registry + run set → result frames.

``Suite(spark, registry, runs)`` builds the base aggregate once (one scan
per table, materialized) and exposes every output as a lazy DataFrame over
it: the per-check frames, the unified ``check_results``, the per-run
``run_summary`` and the itemised detail frames.  One run and a backfill of
every period are the same plan; only the run frame differs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyho.config import CheckSpec, normalize
from tallyho.functions.scoring import DRIFT, FAIL, PASS, overall_status
from tallyho.operators import checks as C
from tallyho.operators.base import Base, build_base
from tallyho.plans.items import run_items


class Suite:
    def __init__(self, spark: SparkSession, registry: dict | CheckSpec, runs=None, materialize: bool = True, base: Base | None = None, only: tuple[str, ...] | None = None):
        """``base``: an aggregate built before, for other settings of the same tables and columns.

        ``only``: the kinds of check that are wanted; the base is built for them alone.
        """
        self.spark = spark
        self.spec = registry if isinstance(registry, CheckSpec) else normalize(registry)
        if only is not None:
            self.spec = self.spec.only(*only)
        self.base: Base = build_base(spark, self.spec, runs, materialize=materialize) if base is None else base.under(self.spec)

    # per-check frames (None when the check kind is not configured)
    def freshness(self):
        return C.freshness(self.spark, self.base)

    def reconciliation(self):
        return C.reconciliation(self.spark, self.base)

    def parts_sum(self):
        return C.parts_sum(self.spark, self.base)

    def parts_sum_detail(self):
        return C.parts_sum_detail(self.spark, self.base)

    def trend_sanity(self):
        return C.trend_sanity(self.spark, self.base)

    def completeness(self):
        return C.completeness(self.spark, self.base)

    def completeness_values(self):
        return C.completeness_values(self.spark, self.base)

    def sanity_range(self):
        return C.sanity_range(self.spark, self.base)

    def items(self) -> DataFrame:
        """Failing groups, missing and new values of every run, one row each, numbered in order."""
        return run_items(self.spark, self.base)

    @property
    def runs(self) -> DataFrame:
        return self.base.runs

    def check_results(self) -> DataFrame:
        """Every check of every run, in the common result schema (U4)."""
        frames = [f for f in (b(self.spark, self.base) for b in C.CHECK_BUILDERS) if f is not None]
        if not frames:
            return self.spark.createDataFrame([], C.RESULT_SCHEMA)
        return reduce(DataFrame.unionByName, [C.to_results(f) for f in frames])

    def run_summary(self, results: DataFrame | None = None) -> DataFrame:
        """One row per run: counts per status and the overall status (A12, A13)."""
        res = self.check_results() if results is None else results
        return summarize(self.base.runs, res)


def summarize(runs: DataFrame, results: DataFrame) -> DataFrame:
    counts = results.groupBy("dashboard", "run_week").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == PASS).alias("pass"),
        F.count_if(F.col("status") == DRIFT).alias("drift"),
        F.count_if(F.col("status") == FAIL).alias("fail"),
    )
    j = runs.select("dashboard", "run_week").join(counts, ["dashboard", "run_week"], "left")
    cols = {c: F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in ("total", "pass", "drift", "fail")}
    return j.select(
        "dashboard",
        "run_week",
        *[v.alias(k) for k, v in cols.items()],
        overall_status(cols["fail"], cols["drift"]).alias("overall_status"),
    )


def run_suites(spark: SparkSession, registries: list[dict], runs=None, parallel: int = 4, on_error=None) -> tuple[DataFrame, DataFrame]:
    """Several dashboards: one base aggregate per dashboard, results unioned.

    The base aggregates are independent jobs over different tables; they are
    submitted from a few driver threads at once so a large cluster works on
    several dashboards' scans together.  ``on_error(dashboard, exception)``,
    if given, is told of each dashboard that cannot be checked and the others
    go on; without it the first such error is raised.
    """
    from concurrent.futures import ThreadPoolExecutor

    def checked(registry: dict) -> tuple[DataFrame, DataFrame] | Exception:
        try:
            suite = Suite(spark, registry, runs)
            return suite.check_results(), suite.runs
        except Exception as error:  # a faulty registry or table of one dashboard
            return error

    with ThreadPoolExecutor(max_workers=max(1, min(parallel, len(registries)))) as pool:
        outcomes = list(pool.map(checked, registries))
    good = [o for o in outcomes if not isinstance(o, Exception)]
    for registry, error in zip(registries, outcomes):
        if isinstance(error, Exception):
            if on_error is None or not good:
                raise error
            on_error(registry.get("dashboard"), error)
    results = reduce(DataFrame.unionByName, [r for r, _ in good])
    run_frames = reduce(DataFrame.unionByName, [r for _, r in good])
    return results, summarize(run_frames, results)
