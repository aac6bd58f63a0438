"""A stored base aggregate that grows with the files of its tables.

The base of a dashboard is kept as partial states, one set for each file of
the dashboard and the source table: row counts, exact sums and rule counts by
(period, dimension, value).  Partial states of different files add up, so a
refresh reads only the files that are new or whose size or time changed, and
drops the states of files that are gone; no other fact row is read again.

Folder layout under ``folder``/<hash of what is aggregated>/:

``states/<side>``     file, length, modified, wk, dim, key, n_rows, m…, r…
``files/<side>``      files whose states are complete
``validated/<side>``  files that a finished validation has covered, or no longer

States are written before their files are listed as complete, and files are
marked as validated after the results were used, so a job that is lost at any
point is mended by running it again: a repeated state row equals the first
and counts once, and periods stay due until a validation has finished.

Tables are Parquet folders (paths), with a function of their rows if the
facts need one; other settings of the registry (tolerances, limits, values)
may change without a new aggregate.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyho.config import CheckSpec, normalize
from tallyho.operators.base import DASH, LATEST, RUN, SRC, WEEK_LEVEL, Base, aggregated, as_base, side_aggregate
from tallyho.plans.suite import Suite
from tallyho.session import scratch_path

_FILE = ["file", "length", "modified"]
FILES_AT_ONCE = 10_000  # files named to one scan


class StoredBase:
    """``facts``: for a side, what makes the facts of its table's rows (rows as they are, if not given)."""

    def __init__(self, spark: SparkSession, registry: dict, folder: str, facts: dict[str, Callable[[DataFrame], DataFrame]] | None = None):
        self.spark = spark
        self.spec: CheckSpec = normalize(registry)
        self.facts = facts or {}
        self.tables = {DASH: str(self.spec.dashboard_table)}
        if self.spec.reconciliation or self.spec.parts:
            self.tables[SRC] = str(self.spec.source_table)
        key = json.dumps([aggregated(self.spec), self.tables], sort_keys=True)
        self.folder = f"{folder.rstrip('/')}/{hashlib.sha256(key.encode()).hexdigest()[:16]}"
        self.listings: dict[str, DataFrame] = {}

    def _read(self, part: str, side: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.folder}/{part}/{side}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _write(self, df: DataFrame, part: str, side: str) -> None:
        df.write.mode("append").parquet(f"{self.folder}/{part}/{side}")

    def _listed(self, side: str) -> DataFrame:
        """The table's files now; their content is not read."""
        path = scratch_path(self.spark, f"files-{side}")
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(self.tables[side])
        files.select(F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified")).write.parquet(path)
        return self.spark.read.parquet(path)

    def refresh(self) -> dict[str, int]:
        """Brings the states up to the tables' files; the number of files read, by side."""
        read = {}
        for side, table in self.tables.items():
            listing = self.listings[side] = self._listed(side)
            known = self._read("files", side)
            new = listing if known is None else listing.join(known, _FILE, "left_anti")
            names = [r["file"] for r in new.select("file").orderBy("file").collect()]  # file names only
            for at in range(0, len(names), FILES_AT_ONCE):
                rows = self.spark.read.option("basePath", table).parquet(*names[at : at + FILES_AT_ONCE])
                facts = self.facts.get(side, lambda df: df)(rows)
                states = side_aggregate(facts, side=side, spec=self.spec, period_filter=None, period_frame=None, with_rules=side == DASH, by_file=True)
                self._write(states.join(listing, "file"), "states", side)
                self._write(listing.where(F.col("file").isin(names[at : at + FILES_AT_ONCE])), "files", side)
            read[side] = len(names)
        return read

    def _states(self, side: str) -> DataFrame | None:
        states = self._read("states", side)
        return None if states is None else states.dropDuplicates([*_FILE, "wk", "dim", "key"])

    def _live(self, side: str) -> DataFrame | None:
        states = self._states(side)
        return None if states is None else states.join(self.listings[side], _FILE, "left_semi")

    def _validated(self, side: str) -> DataFrame | None:
        marks = self._read("validated", side)
        return None if marks is None else marks.groupBy(*_FILE).agg(F.max_by("covered", "at").alias("covered")).where("covered").select(*_FILE)

    def due(self) -> DataFrame:
        """run_week of the periods with rows in files that came, changed or went since the last finished validation."""
        frames = []
        for side in self.tables:
            states, done = self._states(side), self._validated(side)
            if states is None:
                continue
            listing = self.listings[side]
            changed = listing if done is None else listing.join(done, _FILE, "left_anti").union(done.join(listing, _FILE, "left_anti"))
            frames.append(states.join(changed, _FILE, "left_semi").where(F.col("wk").isNotNull()).select(F.col("wk").alias("run_week")))
        if not frames:
            return self.spark.createDataFrame([], "run_week string")
        both = frames[0] if len(frames) == 1 else frames[0].union(frames[1])
        return both.distinct()

    def base(self, runs: DataFrame) -> Base:
        """The base aggregate for some runs (run_week), from the states alone."""
        parts = []
        for side in self.tables:
            live = self._live(side)
            if live is None:
                continue
            sums = [f"CAST(coalesce(sum({c}), 0) AS DOUBLE) AS {c}" for c in live.columns if c[0] == "m" and c[1:].isdigit()]
            counts = [f"sum({c}) AS {c}" for c in live.columns if c == "n_rows" or c[0] == "r" and c[1:].isdigit()]
            parts.append(live.groupBy("side", "wk", "dim", "key").agg(*map(F.expr, counts + sums)))
        path = scratch_path(self.spark, f"stored-base-{self.spec.dashboard}")
        run_rows = runs.select(F.lit(RUN).alias("side"), F.col("run_week").cast("string").alias("wk")).where("wk IS NOT NULL").distinct()
        combined = run_rows
        for p in parts:
            combined = p.unionByName(combined, allowMissingColumns=True)
        combined.withColumn("dashboard", F.lit(self.spec.dashboard)).write.parquet(path)
        stored = self.spark.read.parquet(path)
        weeks = stored.where((F.col("side") == DASH) & (F.col("dim") == WEEK_LEVEL))
        latest = weeks.groupBy("dashboard").agg(F.max("wk").alias("wk")).select(F.lit(LATEST).alias("side"), "wk", "dashboard")
        return as_base(self.spec, stored, stored.where(F.col("side") == RUN).select("side", "wk", "dashboard").unionByName(latest), path)

    def suite(self, runs: DataFrame | None = None) -> Suite:
        """The checks of some runs, else of the periods that are due."""
        return Suite(self.spark, self.spec, base=self.base(self.due() if runs is None else runs))

    def finished(self) -> None:
        """Marks the files of the last refresh as validated; call it after the results were logged."""
        for side, listing in self.listings.items():
            done = self._validated(side)
            came = listing if done is None else listing.join(done, _FILE, "left_anti")
            marks = came.withColumn("covered", F.lit(True))
            if done is not None:
                marks = marks.union(done.join(listing, _FILE, "left_anti").withColumn("covered", F.lit(False)))
            self._write(marks.withColumn("at", F.current_timestamp()), "validated", side)
