"""The rule language: `filter | distinct(key) | having | columns`."""

from .run import RuleRunError, execute, execute_json, predicate
from .sql import executable_sql, to_sql
from .syntax import RuleSyntaxError, parse

__all__ = ["RuleRunError", "RuleSyntaxError", "executable_sql", "execute", "execute_json", "parse", "predicate", "to_sql"]
