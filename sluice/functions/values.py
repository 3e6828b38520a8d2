"""Comparisons of untyped cells with literals, as guarded Column expressions.

A cell is text. Against a whole number it compares as one if it is written as one, else as text
with the number's digits. Results are never null: what can't be compared doesn't match. No implicit
cast takes place, so ANSI mode never raises.
"""

from __future__ import annotations

import operator

from pyspark.sql import Column
from pyspark.sql import functions as F

OPS = {"=": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}
_LONG = 2**63


def whole(cell: Column) -> Column:
    """The cell as a long if it is written as one ([+-] and digits, in range), else null."""
    return F.when(cell.rlike(r"\A[+-]?[0-9]+\z"), cell.try_cast("bigint"))


def like(cell: Column, pattern: str) -> Column:
    """`~`: one % splits the pattern into a beginning and an end, which may overlap in the cell;
    none means equality; with more nothing matches. _ stands for itself."""
    parts = pattern.split("%")
    if len(parts) == 1:
        found = cell == F.lit(pattern)
    elif len(parts) == 2:
        found = cell.startswith(F.lit(parts[0])) & cell.endswith(F.lit(parts[1]))
    else:
        found = F.lit(False)
    return F.coalesce(found, F.lit(False))


def compare_text(cell: Column, op: str, value) -> Column:
    """A text cell against a literal: str, int or bool."""
    if op == "~":
        return like(cell, value) if isinstance(value, str) else F.lit(False)
    if isinstance(value, bool):
        found = OPS[op](F.lower(cell), F.lit(str(value).lower())) if op in ("=", "!=") else F.lit(False)
    elif isinstance(value, int):
        number = whole(cell)
        found = F.when(number.isNotNull(), OPS[op](number, F.lit(value))).otherwise(OPS[op](cell, F.lit(str(value))))
    else:
        found = OPS[op](cell, F.lit(value))
    return F.coalesce(found, F.lit(False))


def compare_variant(cell: Column, op: str, value) -> Column:
    """A JSON cell (variant), whose kind is its own: whole number, decimal, text or truth value.

    A whole number or decimal against text compares as numbers if the text is one, else a whole
    number compares by its digits and a decimal doesn't match. Null and nested cells never match.
    """
    kind = F.schema_of_variant(cell)
    text, number = F.try_variant_get(cell, "$", "string"), F.try_variant_get(cell, "$", "bigint")
    real = F.try_variant_get(cell, "$", "double")
    is_text, is_whole, is_real = kind == "STRING", kind == "BIGINT", kind.rlike("^(DECIMAL|DOUBLE|FLOAT)")
    if op == "~" or isinstance(value, bool):
        right = compare_text(text, op, value)
        return F.coalesce((is_text if op == "~" else kind == "BOOLEAN") & right, F.lit(False))
    if isinstance(value, int):
        by_real, by_whole = OPS[op](real, F.lit(float(value))), OPS[op](number, F.lit(value))
    else:
        try:
            as_whole = int(value) if -_LONG <= int(value) < _LONG and value.lstrip("+-").isdigit() else None
        except ValueError:
            as_whole = None
        try:
            as_real = float(value)
        except ValueError:
            as_real = None
        by_whole = OPS[op](number, F.lit(as_whole)) if as_whole is not None else OPS[op](number.cast("string"), F.lit(value))
        by_real = OPS[op](real, F.lit(as_real)) if as_real is not None else F.lit(False)
    found = F.when(is_text, compare_text(text, op, value)).when(is_whole, by_whole).when(is_real, by_real)
    return F.coalesce(found, F.lit(False))


def compare_typed(cell: Column, op: str, value, kind: str) -> Column:
    """A column of a known Spark type against a literal."""
    if kind == "string":
        return compare_text(cell, op, value)
    if kind == "variant":
        return compare_variant(cell, op, value)
    if kind == "boolean":
        return F.coalesce(OPS[op](cell, F.lit(value)) if isinstance(value, bool) and op in ("=", "!=") else F.lit(False), F.lit(False))
    if op == "~" or isinstance(value, bool):
        return F.lit(False)
    if isinstance(value, str) and kind in ("tinyint", "smallint", "int", "bigint"):
        if value.lstrip("+-").isdigit() and -_LONG <= int(value) < _LONG:
            value = int(value)
        else:
            return F.coalesce(OPS[op](cell.cast("string"), F.lit(value)), F.lit(False))
    elif isinstance(value, str) and not kind.startswith(("date", "timestamp")):
        try:
            value = float(value)
        except ValueError:
            return F.lit(False)
    elif kind.startswith(("date", "timestamp")):
        cell, value = cell.cast("string"), str(value)
    return F.coalesce(OPS[op](cell, F.lit(value)), F.lit(False))


def add(a, b, op: str):
    """Literal arithmetic: whole numbers (division cuts towards zero), and + joins strings."""
    if isinstance(a, str) and isinstance(b, str) and op == "+":
        return a + b
    if not all(isinstance(x, int) and not isinstance(x, bool) for x in (a, b)):
        raise ValueError(f"{a!r} {op} {b!r}")
    if op == "/":
        if b == 0:
            raise ValueError("division by zero")
        return abs(a) // abs(b) * (1 if (a < 0) == (b < 0) else -1)
    out = {"+": a + b, "-": a - b, "*": a * b}[op]
    if not -_LONG <= out < _LONG:
        raise ValueError(f"{a} {op} {b} is out of range")
    return out
