"""SQL text: checks and names by Spark's own parser."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


class SqlError(ValueError):
    """The statement isn't allowed or isn't SQL."""


def _plan(spark: SparkSession, sql: str):
    try:
        return spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    except Exception as e:
        raise SqlError(str(e).splitlines()[0]) from e


def is_sql(spark: SparkSession, sql: str) -> bool:
    try:
        _plan(spark, sql)
    except SqlError:
        return False
    return True


def _each(seq):
    return [seq.apply(i) for i in range(seq.size())]


def _nodes(plan, out: list | None = None) -> list:
    """All nodes of a plan: children, those inside (as the queries of a WITH), and plans of subqueries."""
    out = [] if out is None else out
    out.append(plan)
    for child in [*_each(plan.children()), *_each(plan.innerChildren())]:
        if hasattr(child, "children") and hasattr(child, "subqueries"):
            _nodes(child, out)
    for inner in _each(plan.subqueries()):
        _nodes(inner, out)
    return out


def _names(plan, known: frozenset[str], out: list[str]) -> None:
    """Names of tables below a node, without those of the queries of a WITH around it."""
    if plan.nodeName() == "UnresolvedWith":
        known_in = set(known)
        for pair in _each(plan.cteRelations()):
            # A query of a WITH sees those before it, and itself if it may be recursive.
            alias = {pair._1().lower()}
            _names(pair._2(), frozenset(known_in | alias if plan.allowRecursion() else known_in), out)
            known_in |= alias
        _names(plan.child(), frozenset(known_in), out)
        return
    if plan.nodeName() in ("UnresolvedRelation", "UnresolvedTable", "UnresolvedTableOrView", "UnresolvedView"):
        parts = _each(plan.multipartIdentifier())
        if len(parts) > 1 or parts[0].lower() not in known:
            out.append(".".join(parts))
    elif plan.nodeName() == "UnresolvedIdentifier":
        out.append(".".join(_each(plan.nameParts())))
    target = [plan.table()] if plan.nodeName() == "InsertIntoStatement" else []  # is no child of it
    for child in [*target, *_each(plan.children()), *_each(plan.subqueries())]:
        _names(child, known, out)


def table_names(spark: SparkSession, sql: str) -> list[str]:
    """Tables that a statement reads or writes, once each, in the order of its plan; names that the
    statement gives to queries of its own (WITH) are none."""
    out: list[str] = []
    _names(_plan(spark, sql), frozenset(), out)
    return list(dict.fromkeys(out))


def check_safe(spark: SparkSession, sql: str) -> None:
    """Raise SqlError for a statement that drops a table, however it is written."""
    names = {n.nodeName() for n in _nodes(_plan(spark, sql))}
    if names & {"DropTable", "DropTableCommand"}:
        raise SqlError("DROP TABLE isn't allowed")


def ctas(sql: str, table: str) -> str:
    """The statement as CREATE TABLE IF NOT EXISTS, unless it creates a table itself."""
    sql = " ".join(sql.split())
    return sql if re.search(r"\bCREATE TABLE ", sql, re.I) else f"CREATE TABLE IF NOT EXISTS {table} as {sql}"


def target_table(sql: str) -> str | None:
    """The table that a CREATE TABLE statement makes."""
    m = re.search(r"\bCREATE\s+(?:TEMPORARY\s+)?TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?([\w.`]+)", sql, re.I)
    return m[1].replace("`", "") if m else None


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def run_safe(spark: SparkSession, sql: str) -> DataFrame:
    check_safe(spark, sql)
    return spark.sql(sql)
