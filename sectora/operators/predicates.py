"""Report filter predicates on text attribute columns.

Every attribute value is text, so ``>``/``<`` compare text (``'10' < '9'``). Operators are
trimmed and upper-cased; values are trimmed. Literals are passed as Column literals, so no
quoting or escaping of values is needed (a value such as ``O'Brien`` matches as written).
"""

from __future__ import annotations

import functools
import operator as op
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from sectora.functions import text

# Operators accepted when a definition is saved, and operators a build
# understands. Both sets are supported by ``predicate``.
SAVE_OPERATORS = ("=", "!=", ">", "<", ">=", "<=", "LIKE", "IN")
BUILD_OPERATORS = ("=", "!=", "<>", ">", "<", "CONTAINS", "IN")
OPERATORS = tuple(dict.fromkeys(SAVE_OPERATORS + BUILD_OPERATORS))


class UnsupportedOperator(ValueError):
    pass


@dataclass(frozen=True)
class Filter:
    section_id: int
    attribute_id: int
    operator: str
    value: str | None


def split_csv(value: str) -> list[str]:
    """Comma-split, trim, drop blanks (driver-side twin of ``functions.text.split_csv``)."""
    return [v.strip() for v in value.split(",") if v.strip()]


def ilike_literal(value: str) -> str:
    """Pattern ``%value%`` for ILIKE. ``%`` and ``_`` in the value stay wildcards; a backslash
    is doubled because it is the escape character of Spark's LIKE."""
    return "%" + value.replace("\\", "\\\\") + "%"


def normalise_operator(operator: str) -> str:
    return str(operator).strip().upper()


def _in(col: Column, value: str) -> Column | None:
    items = split_csv(value)
    return col.isin(items) if items else None


def quoted(value: str) -> str:
    """A SQL text literal; a backslash is doubled, as it escapes in the engine's literals."""
    return "'" + value.replace("\\", "\\\\").replace("'", "''") + "'"


def _in_text(name: str, value: str) -> str | None:
    items = split_csv(value)
    return f"{name} IN ({', '.join(map(quoted, items))})" if items else None


def _comparison(build, sign: str):
    return (lambda col, v: build(col, F.lit(v)), lambda name, v: f"{name} {sign} {quoted(v)}")


#: Of each operator: the predicate on a column, and its SQL text. None: it constrains nothing.
MEANING = {
    "=": _comparison(op.eq, "="), "!=": _comparison(op.ne, "<>"), "<>": _comparison(op.ne, "<>"), ">": _comparison(op.gt, ">"),
    "<": _comparison(op.lt, "<"), ">=": _comparison(op.ge, ">="), "<=": _comparison(op.le, "<="),
    "CONTAINS": (lambda col, v: col.ilike(ilike_literal(v)), lambda name, v: f"{name} ILIKE {quoted(ilike_literal(v))}"),
    "LIKE": (lambda col, v: col.like(v), lambda name, v: f"{name} LIKE {quoted(v)}"),
    "IN": (_in, _in_text),
}


def _meaning(operator: str):
    name = normalise_operator(operator)
    if name not in MEANING:
        raise UnsupportedOperator(f"Unsupported operator: {name}")
    return MEANING[name]


def predicate(col: Column, operator: str, value: str) -> Column | None:
    """Predicate for one filter; ``None`` when it constrains nothing (``IN`` of blanks only)."""
    return _meaning(operator)[0](col, str(value).strip())


def predicate_text(name: str, operator: str, value: str) -> str | None:
    """The same predicate as SQL text on the column ``name``."""
    return _meaning(operator)[1](name, str(value).strip())


def predicate_column(name: Column, operator: Column, value: Column) -> Column:
    """``predicate_text`` for filters stored in a table; null where a filter constrains nothing or its operator is unknown."""
    def quoted_column(c: Column) -> Column:
        return F.concat(F.lit("'"), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("''")), F.lit("'"))

    op_name, v = text.normalise_operator(operator), F.trim(value)
    items = text.split_csv(v)
    sign = F.when(op_name == "!=", F.lit("<>")).otherwise(op_name)
    pattern = F.concat(F.lit("%"), F.replace(v, F.lit("\\"), F.lit("\\\\")), F.lit("%"))
    return (
        F.when(op_name == "IN", F.when(F.size(items) > 0, F.concat(name, F.lit(" IN ("), F.array_join(F.transform(items, quoted_column), ", "), F.lit(")"))))
        .when(op_name == "CONTAINS", F.concat(name, F.lit(" ILIKE "), quoted_column(pattern)))
        .when(op_name.isin(*OPERATORS), F.concat(name, F.lit(" "), sign, F.lit(" "), quoted_column(v)))
    )


def report_filter(filters: Iterable[Filter], columns: Mapping[tuple[int, int], str]) -> tuple[Column, list[Filter]]:
    """AND of all applicable filters.

    ``columns`` maps ``(section_id, attribute_id)`` to the report column. Filters on a section
    that is not in the report and filters with a null value are skipped and returned as the
    second element (diagnostics); an unknown operator raises.
    """
    preds: list[Column] = []
    ignored: list[Filter] = []
    sections = {s for s, _ in columns}
    for f in filters:
        if f.section_id not in sections or f.value is None:
            ignored.append(f)
            continue
        name = columns.get((f.section_id, f.attribute_id), f"attr_{f.attribute_id}")
        p = predicate(F.col(name), f.operator, f.value)
        if p is not None:
            preds.append(p)
    return functools.reduce(op.and_, preds, F.lit(True)), ignored
