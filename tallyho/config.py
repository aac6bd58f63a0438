"""Registry → normalized check specification.

A registry is the plain dict a YAML file per dashboard would give.  This
module applies the default and gating rules once, on the driver, over the
*configuration only* (a handful of entries); no table data is touched here.

Gating rules (each check kind defaults to enabled):
* reconciliation runs for a metric when ``reconciliation`` is in its
  ``checks`` (default ``["reconciliation"]``);
* trend_sanity runs when ``trend_sanity`` is in the metric's ``checks``;
  the limit is ``checks.trend_sanity.max_wow_change_pct`` (default 50);
* parts_sum runs per pivot for metrics that list ``reconciliation``
  explicitly (default ``[]``), ignoring ``checks.reconciliation.enabled``;
  pivots come from ``pivot_columns``, else ``pivot_column``, else ``platform``;
* completeness runs for dimensions with ``completeness_check: true``;
  ``required_values`` falls back to ``expected_values``;
* sanity_range runs one check per rule;
* ``lookback_weeks`` defaults to 1 and is clamped to at least 1.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import partial
from itertools import product
from typing import Any

DEFAULT_DATE_COLUMN = "fiscal_yr_and_wk_desc"
DEFAULT_PIVOT = "platform"
DEFAULT_MAX_CHANGE = 50.0
DEFAULT_TOLERANCE = 1.0
READS_SOURCE = {"reconciliation", "parts_sum"}


def py_text(value: Any) -> str:
    """Python's own text for a config value (e.g. tolerance 1.0 → '1.0')."""
    return str(value)


@dataclass(frozen=True)
class MetricCheck:
    seq: int
    metric: str
    limit: float  # tolerance_pct for reconciliation/parts_sum, max change for trend


@dataclass(frozen=True)
class PartsCheck:
    seq: int
    metric: str
    pivot: str
    tolerance: float


@dataclass(frozen=True)
class CompletenessCheck:
    seq: int
    dimension: str
    required: tuple[str | None, ...]
    optional: tuple[str | None, ...]


@dataclass(frozen=True)
class SanityRule:
    seq: int
    name: str
    expression: str


@dataclass(frozen=True)
class ExpectedChange:
    dimension: str
    value: str | None
    change: str  # "appears" | "disappears"
    effective_week: str


@dataclass
class CheckSpec:
    dashboard: str
    dashboard_table: Any
    source_table: Any
    date_column: str = DEFAULT_DATE_COLUMN
    grain: str = "week"
    lookback: int = 1
    row_filter: str | None = None
    freshness_seq: int | None = None
    reconciliation: list[MetricCheck] = field(default_factory=list)
    trend: list[MetricCheck] = field(default_factory=list)
    parts: list[PartsCheck] = field(default_factory=list)
    completeness: list[CompletenessCheck] = field(default_factory=list)
    sanity: list[SanityRule] = field(default_factory=list)
    expected_changes: list[ExpectedChange] = field(default_factory=list)
    periods_of_source: bool = False  # the source's periods are runs too, though no check compares with it

    def only(self, *kinds: str) -> CheckSpec:
        """The checks of some kinds alone, with their numbers, for the same runs: a base holds no more than they need."""
        lists = {"reconciliation": "reconciliation", "trend_sanity": "trend", "parts_sum": "parts", "completeness": "completeness", "sanity_range": "sanity"}
        unknown = set(kinds) - {*lists, "freshness"}
        if unknown:
            raise ValueError(f"unknown checks: {sorted(unknown)}")
        left = {attribute: [] for kind, attribute in lists.items() if kind not in kinds}
        fresh = self.freshness_seq if "freshness" in kinds else None
        return replace(self, freshness_seq=fresh, periods_of_source=bool(self.periods_of_source or self.reconciliation or self.parts), **left)

    def change_intervals(self, dimension: str) -> list[tuple[str | None, str, str, str | None]]:
        """(value, change, from, until) of the scheduled changes of a dimension: each holds until the next one of its value.

        Of changes of one value in the same period, the last in the registry holds.
        """
        by_value: dict[str | None, dict[str, str]] = {}
        for e in self.expected_changes:
            if e.dimension == dimension:
                by_value.setdefault(e.value, {})[e.effective_week] = e.change
        out = []
        for value, changes in by_value.items():
            begins = sorted(changes)
            out += [(value, changes[begin], begin, until) for begin, until in zip(begins, [*begins[1:], None], strict=True)]
        return out

    @property
    def metrics(self) -> list[str]:
        """Metric expressions summed by the base aggregate, first-seen order."""
        seen: dict[str, None] = {}
        for c in self.reconciliation:
            seen.setdefault(c.metric)
        for c in self.trend:
            seen.setdefault(c.metric)
        for c in self.parts:
            seen.setdefault(c.metric)
        return list(seen)

    @property
    def source_metrics(self) -> list[str]:
        """Those that a check compares with the source."""
        compared = {c.metric for c in (*self.reconciliation, *self.parts)}
        return [m for m in self.metrics if m in compared]

    @property
    def source_dimensions(self) -> list[str]:
        return list(dict.fromkeys(c.pivot for c in self.parts))

    @property
    def dimensions(self) -> list[str]:
        """Columns grouped next to the period: pivots first, then completeness dims."""
        seen: dict[str, None] = {}
        for c in self.parts:
            seen.setdefault(c.pivot)
        for c in self.completeness:
            seen.setdefault(c.dimension)
        return list(seen)


def _str_or_none(v: Any) -> str | None:
    return None if v is None else str(v)


class _Registry:
    """A registry dict with its defaults filled in, one accessor for each part the checks read."""

    def __init__(self, reg: dict):
        self.reg = reg
        self.checks = reg.get("checks") or {}
        self.metrics = reg.get("metrics") or []

    def options(self, kind: str) -> dict:
        return self.checks.get(kind) or {}

    def on(self, kind: str) -> bool:
        return bool(self.options(kind).get("enabled", True))

    @staticmethod
    def tolerance(metric: dict) -> float:
        """A number, or text with a per cent sign."""
        text = str(metric.get("tolerance_pct", DEFAULT_TOLERANCE)).strip()
        return float(text[:-1] if text.endswith("%") else text)

    def pivots(self) -> list[str]:
        options = self.options("parts_sum")
        one = [options.get("pivot_column", DEFAULT_PIVOT)]
        return one if options.get("pivot_columns") is None else options["pivot_columns"]


# What each kind of check yields from a registry: (kind, constructor that takes the check's number).
# The phases run in this order and number the checks as they come.


def _dashboard_checks(r: _Registry):
    yield "freshness", int


def _metric_checks(r: _Registry):
    change = float(r.options("trend_sanity").get("max_wow_change_pct", DEFAULT_MAX_CHANGE))
    for m in r.metrics:
        listed = m.get("checks", ["reconciliation"])
        for kind, limit in (("reconciliation", r.tolerance(m)), ("trend_sanity", change)):
            if kind in listed:
                yield kind, partial(MetricCheck, metric=m["name"], limit=limit)


def _pivot_checks(r: _Registry):
    explicit = (m for m in r.metrics if "reconciliation" in m.get("checks", ()))
    for m, pivot in product(explicit, r.pivots()):
        yield "parts_sum", partial(PartsCheck, metric=m["name"], pivot=pivot, tolerance=r.tolerance(m))


def _dimension_checks(r: _Registry):
    for d in r.reg.get("dimensions") or []:
        if d.get("completeness_check", False):
            lists = (d.get("required_values", d.get("expected_values")), d.get("optional_values"))
            required, optional = (tuple(map(_str_or_none, v or ())) for v in lists)
            yield "completeness", partial(CompletenessCheck, dimension=d["name"], required=required, optional=optional)


def _rule_checks(r: _Registry):
    for rule in r.options("sanity_range").get("rules") or []:
        yield "sanity_range", partial(SanityRule, name=rule["name"], expression=rule["expression"])


_PHASES = (_dashboard_checks, _metric_checks, _pivot_checks, _dimension_checks, _rule_checks)


def _expected_change(entry: dict) -> ExpectedChange:
    change = str(entry["change"])
    if change not in {"appears", "disappears"}:
        raise ValueError(f"expected_changes.change must be appears|disappears, got {change!r}")
    return ExpectedChange(str(entry["dimension"]), _str_or_none(entry.get("value")), change, str(entry["effective_week"]))


def normalize(registry: dict) -> CheckSpec:
    """The checks that a registry asks for, numbered in execution order."""
    r = _Registry(registry)
    found: dict[str, list] = {}
    wanted = ((kind, make) for phase in _PHASES for kind, make in phase(r) if r.on(kind))
    for seq, (kind, make) in enumerate(wanted):
        found.setdefault(kind, []).append(make(seq))
    if found.keys() & READS_SOURCE and registry.get("source_table") is None:
        # Falling back to the dashboard would compare a table with itself.
        raise ValueError("source_table is required: a check compares the dashboard with its source")
    return CheckSpec(
        dashboard=str(registry["dashboard"]),
        dashboard_table=registry["dashboard_table"],
        source_table=registry.get("source_table"),
        date_column=registry.get("date_column", DEFAULT_DATE_COLUMN),
        grain=registry.get("grain", "week"),
        lookback=max(int(registry.get("lookback_weeks", 1)), 1),
        row_filter=registry.get("row_filter"),
        freshness_seq=next(iter(found.get("freshness", [])), None),
        reconciliation=found.get("reconciliation", []),
        trend=found.get("trend_sanity", []),
        parts=found.get("parts_sum", []),
        completeness=found.get("completeness", []),
        sanity=found.get("sanity_range", []),
        expected_changes=[_expected_change(e) for e in registry.get("expected_changes") or []],
    )


def load_registry(path: str) -> dict:
    """Read a registry file (YAML or JSON); a missing file raises FileNotFoundError."""
    import json
    import os

    if not os.path.exists(path):
        raise FileNotFoundError(f"Registry not found: {path}")
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as e:  # pragma: no cover - depends on the environment
        raise ImportError("reading YAML registries needs PyYAML; pass a dict or a .json file instead") from e
    return yaml.safe_load(text)
