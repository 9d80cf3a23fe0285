"""Text functions used by reports, sinks and the task page."""

from __future__ import annotations

import functools
import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_csv(c: Column) -> Column:
    """Comma-split, trim each item, drop blanks: ``' a, ,b'`` → ``['a', 'b']``."""
    return F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: x != F.lit(""))


def normalise_operator(c: Column) -> Column:
    return F.upper(F.trim(c))


def csv_of_sorted(values: Column) -> Column:
    """Array → sorted items joined with commas."""
    return F.concat_ws(",", F.sort_array(values))


# A warehouse-safe name: these replacements in order, then lower case.
NAME_RULES = [(r"^\s+|\s+$", ""), ("[^A-Za-z0-9_]", "_"), ("^$", "col"), ("^(?=[0-9])", "attr_")]


def sanitize_name(name: str) -> str:
    """``NAME_RULES`` for a name known on the driver."""
    return functools.reduce(lambda n, rule: re.sub(*rule, n), NAME_RULES, str(name)).lower()


def sanitize_name_col(c: Column) -> Column:
    """``NAME_RULES`` for names stored in a table."""
    return F.lower(functools.reduce(lambda n, rule: F.regexp_replace(n, F.lit(rule[0]), F.lit(rule[1])), NAME_RULES, c))


def section_table_name(org_id: Column, section_id: Column) -> Column:
    return F.concat(F.lit("org_"), org_id.cast("string"), F.lit("_section_"), section_id.cast("string"))


def report_table_name(report_id: Column) -> Column:
    return F.concat(F.lit("report_"), report_id.cast("string"))


def first_present(*cols: Column) -> Column:
    """First value that is neither null nor empty text."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


def label(c: Column, mapping: dict[str, str], default: str | None = None) -> Column:
    """Code → label lookup with a literal map (codes not in the map give ``default``)."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    out = F.try_element_at(m, c)
    return F.coalesce(out, F.lit(default)) if default is not None else out
