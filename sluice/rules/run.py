"""Rule -> DataFrame operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import values
from .syntax import Call, Literal, Logic, Name, Rule, calls, parse


class RuleRunError(ValueError):
    """The rule can't run on this data."""


AGGREGATES = {"count": F.count, "sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max}


def _value(node):
    if isinstance(node, Literal):
        return node.value
    try:
        return values.add(_value(node.left), _value(node.right), node.op)
    except ValueError as e:
        raise RuleRunError(str(e)) from e


def _filter(node, column, kinds) -> Column:
    """column: the node on the left of a comparison -> Column; kinds: -> its type."""
    if isinstance(node, Logic):
        left, right = _filter(node.left, column, kinds), _filter(node.right, column, kinds)
        return left & right if node.op.lower() == "and" else left | right
    return values.compare_typed(column(node.left), node.op, _value(node.right), kinds(node.left))


def _name(text: str, df: DataFrame) -> Column:
    if text in df.columns:
        return F.col(f"`{text}`")
    head, _, rest = text.partition(".")
    if rest and head in df.columns:
        return F.col(".".join(f"`{x}`" for x in text.split(".")))
    raise RuleRunError(f"no column {text}")


def predicate(rule: str | Rule, df: DataFrame) -> Column:
    """The rule's filter on df; true without one. Never null."""
    rule = parse(rule) if isinstance(rule, str) else rule
    if rule.where is None:
        return F.lit(True)
    kind = lambda n: df.select(_name(n.text, df)).schema[0].dataType.simpleString()
    return _filter(rule.where, lambda n: _name(n.text, df), kind)


def _number(cell: Column, kind: str) -> Column:
    """A cell to be added up: whole numbers stay whole, other numbers are doubles, the rest is null."""
    return cell.try_cast("double") if kind == "string" else cell


def _aggregate(call: Call, df: DataFrame) -> tuple[Column, str]:
    name = call.name.lower()
    if name not in AGGREGATES:
        raise RuleRunError(f"no aggregate {call.name}")
    if call.column is None:
        return F.count(F.lit(1)), "bigint"
    cell = _name(call.column.text, df)
    kind = df.select(cell).schema[0].dataType.simpleString()
    if name in ("sum", "avg"):
        return AGGREGATES[name](_number(cell, kind)), "double" if kind in ("string", "double", "float") or name == "avg" else "bigint"
    return AGGREGATES[name](cell), "bigint" if name == "count" else kind


def label(call: Call) -> str:
    return f"{call.name.lower()}({call.column.text if call.column else '*'})"


def execute(rule: str | Rule, df: DataFrame, mode: str = "sql", strict: bool = False) -> DataFrame:
    """Run a rule on a table.

    mode "sql": the selected columns. mode "table": a grouped rule's keys and its having values.
    strict: a rule without filter or without columns is an error.
    """
    rule = parse(rule) if isinstance(rule, str) else rule
    if strict and (rule.where is None or not rule.select):
        raise RuleRunError("a filter and columns are wanted")
    if rule.having is not None and not rule.group:
        if calls(rule.having):
            raise RuleRunError("having needs distinct(key)")
        # A second plain filter: it restricts rows, too.
        rule = Rule(Logic("and", rule.where, rule.having) if rule.where else rule.having, (), None, rule.select, rule.columns)
    if not rule.select:
        raise RuleRunError("no columns to select")
    rows = df.select(*[_name(c, df).alias(c) for c in rule.columns]) if rule.columns else df
    rows = rows.filter(predicate(rule, rows))
    selected = [F.col(f"`{n.text}`") for n in dict.fromkeys(rule.select)]
    if not rule.group:
        return rows.select(*[F.col(f"`{n.text}`") for n in rule.select]) if len(set(rule.select)) == len(rule.select) else rows.select(*selected)
    keys = [F.col(f"`{n.text}`") for n in dict.fromkeys(rule.group)]
    wanted = list(dict.fromkeys(calls(rule.having))) if rule.having is not None else []
    made = {c: _aggregate(c, rows) for c in wanted}
    grouped = rows.groupBy(*keys)
    out = grouped.agg(*[made[c][0].alias(label(c)) for c in wanted]) if wanted else rows.select(*keys).distinct()
    if rule.having is not None:
        kinds = lambda n: made[n][1] if isinstance(n, Call) else rows.schema[n.text].dataType.simpleString()
        out = out.filter(_filter(rule.having, lambda n: F.col(f"`{label(n)}`") if isinstance(n, Call) else F.col(f"`{n.text}`"), kinds))
    return out if mode == "table" else out.select(*selected)


def execute_json(rule: str | Rule, lines: DataFrame, column: str = "value", last_only: bool = False, strict_columns: bool = False) -> DataFrame:
    """Run a rule's filter and columns on JSON messages, batch or stream.

    Names are dotted paths. Malformed messages are skipped. A cell keeps the kind it has in
    its message. Selected cells are text; JSON null and absent cells are null. last_only: only
    the last column used, as one column. strict_columns: a message lacking a column that the
    filter uses raises.
    """
    rule = parse(rule) if isinstance(rule, str) else rule
    if rule.group or rule.having is not None:
        raise RuleRunError("messages can be filtered and projected only")
    doc = "__rule_doc"
    # explode() of one value keeps the parsing from being repeated wherever a cell is used.
    rows = lines.select(F.explode(F.array(F.try_parse_json(F.col(column)))).alias(doc)).filter(F.col(doc).isNotNull())
    path = lambda text: "$" + "".join(f"['{p}']" for p in text.split("."))
    cell = lambda text: F.try_variant_get(F.col(doc), path(text), "variant")
    if strict_columns:
        for name in rule.columns:
            rows = rows.filter(F.when(cell(name).isNull(), F.raise_error(F.lit(f"no column {name}")).cast("boolean")).otherwise(F.lit(True)))
    if rule.where is not None:
        rows = rows.filter(_filter(rule.where, lambda n: cell(n.text), lambda n: "variant"))
    wanted = [rule.columns[-1]] if last_only else [n.text for n in dict.fromkeys(rule.select or tuple(map(Name, rule.columns)))]
    return rows.select(*[F.try_variant_get(F.col(doc), path(n), "string").alias(n) for n in wanted])
