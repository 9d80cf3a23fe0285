"""Report plans: the small driver-side description of one report definition."""

from sectora.plans.report_plan import ReportPlan, Sort, plan_report, plan_from_tables, render_sql

__all__ = ["ReportPlan", "Sort", "plan_report", "plan_from_tables", "render_sql"]
