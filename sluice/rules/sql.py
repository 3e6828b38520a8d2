"""Rule -> SQL text."""

from __future__ import annotations

from .syntax import Call, Literal, Logic, Math, Name, Rule, RuleSyntaxError, parse


def _text(node, strict: bool) -> str:
    match node:
        case Literal(text):
            return "'" + text[1:-1].replace("'", "''") + "'" if strict and text[0] == '"' else text
        case Name(text):
            return f"`{text}`" if strict else text
        case Call(name, None):
            return f"{name}(*)"
        case Call(name, column):
            return f"{name}({_text(column, strict)})"
    op = {"~": "like"}.get(node.op, node.op)
    out = f"{_text(node.left, strict)} {op} {_text(node.right, strict)}"
    bracket = node.grouped or (strict and isinstance(node, Logic | Math))
    return f"({out})" if bracket else out


def _statement(rule: Rule, table: str, strict: bool) -> str:
    if not rule.select:
        raise RuleSyntaxError("no columns to select")
    listed = lambda names: ", ".join(_text(n, strict) for n in names)
    out = f"SELECT {listed(rule.select)} FROM {table}"
    if rule.where:
        out += f" WHERE {_text(rule.where, strict)}"
    if rule.group:
        out += f" GROUP BY {listed(rule.group)}"
    if rule.having:
        out += f" HAVING {_text(rule.having, strict)}"
    return out


def to_sql(table: str, rule: str | Rule) -> str:
    """The classic SQL text of a rule. It has no brackets that the rule hasn't, so SQL may read
    `a or b and c` in another way than the rule does; use executable_sql() to run it."""
    return _statement(parse(rule) if isinstance(rule, str) else rule, table, False)


def executable_sql(table: str, rule: str | Rule) -> str:
    """Spark SQL that binds like the rule: names quoted, every logical step in brackets."""
    rule = parse(rule) if isinstance(rule, str) else rule
    if rule.having and not rule.group:
        raise RuleSyntaxError("having needs distinct(key)")
    return _statement(rule, table, True)
