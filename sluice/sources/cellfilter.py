"""Filter strings of cell stores, as Columns.

    PrefixFilter ('u0') AND (QualifierFilter (=, 'binary:view') OR ValueFilter (>=, 'binary:5'))
    SKIP ValueFilter (!=, 'binary:0')
    SingleColumnValueFilter ('e', 'view', >, 'binary:50', true, true)

SKIP binds first, then AND, then OR. Comparators: binary, binaryprefix, substring, regexstring (the last
two with = and != alone). Tests of a cell are plain conditions, which reach the scan; tests of a whole
row (SKIP, SingleColumnValueFilter) are counted by row once, for all of them together.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cells import newest


class FilterError(ValueError):
    """The text is no filter."""


_TOKEN = re.compile(r"\s*('(?:[^']|'')*'|<=|>=|!=|<|>|=|[(),]|-?\d+|[A-Za-z]+)")


def _tokens(text: str) -> list[str]:
    out, at = [], 0
    text = text.rstrip()
    while at < len(text):
        m = _TOKEN.match(text, at)
        if m is None:
            raise FilterError(f"unexpected {text[at : at + 20]!r}")
        out.append(m[1])
        at = m.end()
    return out


_SIGNS: dict[str, Callable[[Column, str], Column]] = {
    "=": lambda c, v: c == v, "!=": lambda c, v: c != v, "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v, ">": lambda c, v: c > v, ">=": lambda c, v: c >= v,
}


def compared(c: Column, sign: str, comparator: str) -> Column:
    """One value against `kind:text`, byte by byte; a missing value fails."""
    kind, colon, text = comparator.partition(":")
    if not colon or sign not in _SIGNS:
        raise FilterError(f"no comparison: {sign} {comparator}")
    if kind == "binary":
        test = _SIGNS[sign](c, text)
    elif kind == "binaryprefix":
        test = c.startswith(text) if sign == "=" else ~c.startswith(text) if sign == "!=" else _SIGNS[sign](F.substring(c, 1, len(text)), text)
    elif kind in ("substring", "regexstring") and sign in ("=", "!="):
        test = F.contains(F.lower(c), F.lit(text.lower())) if kind == "substring" else c.rlike(text)
        test = test if sign == "=" else ~test
    else:
        raise FilterError(f"{kind} doesn't go with {sign}")
    return F.coalesce(test, F.lit(False)) if kind in ("substring", "regexstring") else test


@dataclass
class _Compiled:
    #: Aggregates by row, under the names that conditions use.
    rows: dict[str, Column] = field(default_factory=dict)
    keys_only: bool = False

    def of_row(self, test: Column) -> Column:
        name = f"__row{len(self.rows)}"
        self.rows[name] = test
        return F.coalesce(F.col(name), F.lit(True))


class _Reader:
    def __init__(self, text: str):
        self.tokens, self.at, self.out = _tokens(text), 0, _Compiled()

    def peek(self) -> str:
        return self.tokens[self.at] if self.at < len(self.tokens) else ""

    def take(self, wanted: str | None = None) -> str:
        token = self.peek()
        if not token or (wanted and token != wanted):
            raise FilterError(f"{wanted or 'more'} expected at {token or 'the end'}")
        self.at += 1
        return token

    def either(self) -> Column:
        out = self.both()
        while self.peek() == "OR":
            self.take()
            out = out | self.both()
        return out

    def both(self) -> Column:
        out = self.one()
        while self.peek() == "AND":
            self.take()
            out = out & self.one()
        return out

    def one(self) -> Column:
        if self.peek() == "SKIP":
            self.take()
            # A row of which one cell fails goes as a whole.
            return self.out.of_row(F.bool_and(F.coalesce(self.one(), F.lit(False))))
        if self.peek() == "(":
            self.take()
            out = self.either()
            self.take(")")
            return out
        return self.call(self.take())

    def call(self, name: str) -> Column:
        self.take("(")
        args: list[str] = []
        while self.peek() != ")":
            args.append(self.take())
            if self.peek() != ")":
                self.take(",")
        self.take(")")
        if name not in FILTERS:
            raise FilterError(f"no filter {name}")
        plain = [a[1:-1].replace("''", "'") if a[0] == "'" else a for a in args]
        try:
            return FILTERS[name](self.out, *plain)
        except TypeError as e:
            raise FilterError(f"{name} doesn't take {len(args)} arguments") from e


def _flag(text: str) -> bool:
    if text not in ("true", "false"):
        raise FilterError(f"true or false, not {text}")
    return text == "true"


def _between(out, low: str, with_low: str, high: str, with_high: str) -> Column:
    q = F.col("qualifier")
    test = F.lit(True) if not low else q >= low if _flag(with_low) else q > low
    return test if not high else test & (q <= high if _flag(with_high) else q < high)


def _single(out: _Compiled, family: str, qualifier: str, sign: str, comparator: str, if_missing: str = "false", latest: str = "true") -> Column:
    """Rows by the value of one column: its newest version, or any; a row without it stays unless if_missing."""
    here = (F.col("family") == family) & (F.col("qualifier") == qualifier)
    own = F.when(here, F.coalesce(compared(F.col("value"), sign, comparator), F.lit(False)))
    told = F.max_by(own, F.when(here, F.col("ts"))) if _flag(latest) else F.bool_or(own)
    return out.of_row(F.coalesce(told, F.lit(not _flag(if_missing))))


def _any_prefix(out, *prefixes: str) -> Column:
    test = F.lit(False)
    for p in prefixes:
        test = test | F.col("qualifier").startswith(p)
    return test


def _keys(out: _Compiled) -> Column:
    out.keys_only = True
    return F.lit(True)


FILTERS: dict[str, Callable[..., Column]] = {
    "PrefixFilter": lambda out, p: F.col("row").startswith(p),
    "InclusiveStopFilter": lambda out, last: F.col("row") <= last,
    "RowFilter": lambda out, sign, c: compared(F.col("row"), sign, c),
    "FamilyFilter": lambda out, sign, c: compared(F.col("family"), sign, c),
    "QualifierFilter": lambda out, sign, c: compared(F.col("qualifier"), sign, c),
    "ValueFilter": lambda out, sign, c: compared(F.col("value"), sign, c),
    "ColumnPrefixFilter": lambda out, p: F.col("qualifier").startswith(p),
    "MultipleColumnPrefixFilter": _any_prefix,
    "ColumnRangeFilter": _between,
    "TimestampsFilter": lambda out, *ts: F.col("ts").isin([int(t) for t in ts]),
    "SingleColumnValueFilter": _single,
    "KeyOnlyFilter": _keys,
}


def filtered(cells: DataFrame, text: str) -> DataFrame:
    """The cells (row, family, qualifier, value, ts) that a filter string lets through. With
    KeyOnlyFilter their values are empty."""
    reader = _Reader(text)
    test = reader.either()
    if reader.peek():
        raise FilterError(f"unexpected {reader.peek()}")
    out, columns = cells, cells.columns
    if reader.out.rows:
        # A test inside a SKIP that is one of rows itself would need another count.
        if any("__row" in c._jc.toString() for c in reader.out.rows.values()):
            raise FilterError("SKIP stands for tests of cells alone")
        rows = cells.groupBy("row").agg(*[c.alias(n) for n, c in reader.out.rows.items()])
        out = cells.join(rows, "row")
    out = out.filter(test).select(*columns)
    return out.withColumn("value", F.lit("")) if reader.out.keys_only else out


def scan(cells: DataFrame, text: str, versions: int = 1) -> DataFrame:
    """The newest versions of the cells that a filter string lets through."""
    return newest(filtered(cells, text), versions)
