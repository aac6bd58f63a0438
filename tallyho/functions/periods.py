"""Period labels and period arithmetic as Spark Column expressions.

A *period label* is the string a fact table stores in its date column: a
``YYYY-WW`` week label (week grain) or an ISO ``yyyy-MM-dd`` date (day grain).
Everything here is a JVM-side expression, so lookback windows for thousands
of runs are computed inside whole-stage codegen, never in a driver loop.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the previous-week rule treats every year as 52 weeks long, so
# week 01 rolls back to week 52 of the prior year and week 53 is never produced.
WEEKS_PER_YEAR = 52


def week_label(ts: Column) -> Column:
    """ISO week-year label ``YYYY-WW`` of a date or timestamp column."""
    year = F.extract(F.lit("YEAROFWEEK"), ts)
    week = F.extract(F.lit("WEEK"), ts)
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(week.cast("string"), 2, "0"))


class WeekGrain:
    """``YYYY-WW`` labels; previous of week 01 is week 52 of the prior year."""

    name = "week"

    @staticmethod
    def index(label: Column) -> Column:
        """year * 52 + week; week 53 of Y shares the index of week 01 of Y+1."""
        year = F.substring_index(label, "-", 1).try_cast("int")
        week = F.substring_index(label, "-", -1).try_cast("int")
        bad = label.isNotNull() & ~F.rlike(label, F.lit(r"^\d{4}-\d{1,2}$"))
        wrong = F.raise_error(F.concat(F.lit("not a YYYY-WW period label: "), label)).cast("int")
        return F.when(bad, wrong).otherwise(year * F.lit(WEEKS_PER_YEAR) + week)

    @staticmethod
    def label_of(idx: Column) -> Column:
        year = F.floor((idx - 1) / F.lit(WEEKS_PER_YEAR)).cast("int")
        week = (idx - year * F.lit(WEEKS_PER_YEAR)).cast("int")
        return F.concat(year.cast("string"), F.lit("-"), F.lpad(week.cast("string"), 2, "0"))

    @classmethod
    def prev(cls, label: Column) -> Column:
        return cls.label_of(cls.index(label) - 1)

    @classmethod
    def lookback(cls, label: Column, n: int | Column) -> Column:
        """Array of the ``n`` labels before ``label``, most recent first (n < 1 → 1)."""
        n_col = n if isinstance(n, Column) else F.lit(int(n))
        idx = cls.index(label)
        return F.transform(
            F.sequence(F.lit(1), F.greatest(n_col, F.lit(1))),
            lambda i: cls.label_of(idx - i),
        )

    @staticmethod
    def is_history_label(label: Column) -> Column:
        """Labels the previous-week rule can produce (week 53 never is)."""
        return F.substring_index(label, "-", -1) != F.lit("53")


def _day(label: Column) -> Column:
    """The date of a ``yyyy-MM-dd`` label; any other text is an error."""
    day = label.try_cast("date")
    wrong = F.raise_error(F.concat(F.lit("not a yyyy-MM-dd period label: "), label)).cast("date")
    return F.when(label.isNotNull() & day.isNull(), wrong).otherwise(day)


class DayGrain:
    """ISO date labels ``yyyy-MM-dd``; previous of a day is the day before."""

    name = "day"

    @staticmethod
    def index(label: Column) -> Column:
        return F.date_diff(_day(label), F.lit("1970-01-01").cast("date"))

    @staticmethod
    def label_of(idx: Column) -> Column:
        return F.date_add(F.lit("1970-01-01").cast("date"), idx.cast("int")).cast("string")

    @classmethod
    def prev(cls, label: Column) -> Column:
        return F.date_sub(_day(label), 1).cast("string")

    @classmethod
    def lookback(cls, label: Column, n: int | Column) -> Column:
        n_col = n if isinstance(n, Column) else F.lit(int(n))
        day = _day(label)
        return F.transform(
            F.sequence(F.lit(1), F.greatest(n_col, F.lit(1))),
            lambda i: F.date_sub(day, i).cast("string"),
        )

    @staticmethod
    def is_history_label(label: Column) -> Column:
        return F.lit(True)


GRAINS = {"week": WeekGrain, "day": DayGrain}


def grain_of(name: str):
    try:
        return GRAINS[name]
    except KeyError:
        raise ValueError(f"unknown grain {name!r}; expected one of {sorted(GRAINS)}") from None


def lookback_labels_py(run_week: str, n: int, grain: str = "week") -> list[str]:
    """Driver-side twin of ``lookback`` for literal run lists (config-sized)."""
    out: list[str] = []
    if grain == "day":
        import datetime as _dt

        d = _dt.date.fromisoformat(run_week)
        for i in range(1, max(int(n), 1) + 1):
            out.append((d - _dt.timedelta(days=i)).isoformat())
        return out
    year, week = (int(x) for x in run_week.split("-"))
    idx = year * WEEKS_PER_YEAR + week
    for i in range(1, max(int(n), 1) + 1):
        j = idx - i
        y = (j - 1) // WEEKS_PER_YEAR
        out.append(f"{y}-{j - WEEKS_PER_YEAR * y:02d}")
    return out
