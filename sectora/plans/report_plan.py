"""A report definition as a plan: ordered sections with attributes, filters and sorts.

A definition has tens of rows; it is read for one report at a time and turned into a
DataFrame plan by ``operators.reports.build_report``. Sections are ordered by numeric
``(section_id, attribute_id)``, so the first (driving) section is the smallest section id;
an attribute listed twice is kept once.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sectora.operators.predicates import Filter, predicate_text


class DefinitionError(ValueError):
    """A definition that cannot be built (no attribute rows, unknown operator ...)."""


@dataclass(frozen=True)
class Sort:
    section_id: int
    attribute_id: int
    direction: str = "asc"
    sort_order: int = 1


@dataclass(frozen=True)
class ReportPlan:
    report_id: int
    org_id: int
    sections: tuple[tuple[int, tuple[int, ...]], ...]
    filters: tuple[Filter, ...] = ()
    sorts: tuple[Sort, ...] = field(default=())

    @property
    def first_section(self) -> int:
        return self.sections[0][0]

    @property
    def columns(self) -> list[str]:
        return ["provider_id"] + [f"attr_{a}" for _, attrs in self.sections for a in attrs]


def plan_report(
    report_id: int,
    org_id: int,
    attribute_rows: Iterable[tuple[int, int]],
    filter_rows: Iterable[tuple] = (),
    sort_rows: Iterable[tuple] = (),
) -> ReportPlan:
    """Group ``(section_id, attribute_id)`` rows per section in numeric order."""
    per_section: dict[int, list[int]] = {}
    for section_id, attribute_id in sorted((int(s), int(a)) for s, a in attribute_rows):
        attrs = per_section.setdefault(section_id, [])
        if attribute_id not in attrs:
            attrs.append(attribute_id)
    if not per_section:
        raise DefinitionError(f"No config found for reportId {report_id}")
    filters = tuple(
        Filter(int(s), int(a), str(o) if o is not None else "", v) for s, a, o, v in filter_rows
    )
    sorts = tuple(
        Sort(int(s), int(a), (d or "asc").strip().lower(), int(o) if o is not None else 1)
        for s, a, d, o in sort_rows
    )
    return ReportPlan(
        int(report_id), int(org_id),
        tuple((s, tuple(a)) for s, a in per_section.items()),
        filters, tuple(sorted(sorts, key=lambda x: (x.sort_order, x.section_id, x.attribute_id))),
    )


def plan_from_tables(defs: dict[str, DataFrame], report_id: int, org_id: int) -> ReportPlan:
    """Read one report's definition rows (bounded: one definition) and plan it."""
    def rows(name: str, cols: Sequence[str]) -> list[tuple]:
        df = defs[name].where((F.col("report_id") == F.lit(int(report_id))) & (F.col("org_id") == F.lit(int(org_id))))
        return [tuple(r) for r in df.select(*cols).collect()]

    return plan_report(
        report_id, org_id,
        rows("report_section_attributes", ["section_id", "attribute_id"]),
        rows("report_filters", ["section_id", "attribute_id", "operator", "value"]),
        rows("report_sorts", ["section_id", "attribute_id", "direction", "sort_order"]),
    )


def render_sql(plan: ReportPlan) -> str:
    """The plan as SQL text, for display: a CTE for each section, outer joins by provider, the build's predicates.

    A filter operator that the build refuses is refused here too."""
    def column(section_id: int, attribute_id: int) -> str:
        return f"s{section_id}_a{attribute_id}"

    selected = [(s, a) for s, attrs in plan.sections for a in attrs]
    applied = [f for f in plan.filters if f.value is not None and f.section_id in dict(plan.sections)]
    needed = dict.fromkeys([*selected, *((f.section_id, f.attribute_id) for f in applied)])
    ctes = []
    for section_id, _ in plan.sections:
        inner = "".join(f", attr_{a} AS {column(s, a)}" for s, a in needed if s == section_id)
        ctes.append(f"s{section_id} AS (SELECT provider_id{inner} FROM org_{plan.org_id}_section_{section_id})")
    head = f"WITH {', '.join(ctes)}"
    shown = ", ".join(["provider_id", *(f"{column(s, a)} AS attr_{a}" for s, a in selected)])
    source = f"s{plan.first_section}" + "".join(f" LEFT JOIN s{s} USING (provider_id)" for s, _ in plan.sections[1:])
    tests = [t for f in applied if (t := predicate_text(column(f.section_id, f.attribute_id), f.operator, f.value))]
    return f"{head} SELECT {shown} FROM {source}" + (f" WHERE {' AND '.join(tests)}" if tests else "")


def plans_from_tables(
    defs: dict[str, DataFrame], pairs: Sequence[tuple[int, int]]
) -> dict[tuple[int, int], ReportPlan | DefinitionError]:
    """Plans of many reports with one read per definition table (``(org_id, report_id)`` pairs).

    The rows read are the definitions of the listed reports only (tens per report)."""
    wanted = {(int(o), int(r)) for o, r in pairs}
    ids = sorted({r for _, r in wanted})

    def rows(name: str, cols: Sequence[str]) -> dict[tuple[int, int], list[tuple]]:
        out: dict[tuple[int, int], list[tuple]] = {}
        df = defs[name].where(F.col("report_id").isin(ids)).select("org_id", "report_id", *cols)
        for r in df.collect():
            k = (int(r["org_id"]), int(r["report_id"]))
            if k in wanted:
                out.setdefault(k, []).append(tuple(r[c] for c in cols))
        return out

    attrs = rows("report_section_attributes", ["section_id", "attribute_id"])
    filters = rows("report_filters", ["section_id", "attribute_id", "operator", "value"])
    sorts = rows("report_sorts", ["section_id", "attribute_id", "direction", "sort_order"])
    plans: dict[tuple[int, int], ReportPlan | DefinitionError] = {}
    for org_id, report_id in wanted:
        key = (org_id, report_id)
        try:
            plans[key] = plan_report(report_id, org_id, attrs.get(key, []), filters.get(key, []), sorts.get(key, []))
        except DefinitionError as exc:
            plans[key] = exc
    return plans
