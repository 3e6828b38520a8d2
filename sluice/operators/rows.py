"""Order, pages, first and last rows, line maps."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def page(df: DataFrame, order: list[str], skip: int = 0, limit: int | None = None) -> DataFrame:
    """Rows in order ("-name" descends), some of them."""
    out = df.orderBy(*[F.desc(c[1:]) if c[0] == "-" else F.asc(c) for c in order]).offset(skip)
    return out if limit is None else out.limit(limit)


def page_and_count(df: DataFrame, order: list[str], skip: int, limit: int) -> tuple[DataFrame, int]:
    return page(df, order, skip, limit), df.count()


def exists(df: DataFrame, condition: Column) -> bool:
    return not df.filter(condition).limit(1).isEmpty()


def next_due(items: DataFrame, now, time: str = "at", key: str = "id") -> DataFrame:
    """The earliest item if it is due; an item that isn't due stays where it is."""
    return items.orderBy(time, key).limit(1).filter(F.col(time) <= F.lit(now))


def head(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)


def tail(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The last n rows of an order, in that order."""
    reverse = [c[1:] if c[0] == "-" else f"-{c}" for c in order]
    return page(page(df, reverse, 0, n), order)


def map_lines(lines: DataFrame, f: Callable[[str], str], column: str = "value") -> DataFrame:
    """f of each line, a batch at a time. f sees one line; null stays null."""

    def run(batches: Iterator) -> Iterator:
        for pdf in batches:
            yield pdf[[column]].map(lambda x: f(x) if x is not None else None)

    return lines.select(column).mapInPandas(run, f"{column} string")


def each_partition(df: DataFrame, f: Callable[[Iterator], None]) -> None:
    """f of each partition's rows, on the executors."""
    df.foreachPartition(f)


def scalar(df: DataFrame):
    """The one value of a one-row result."""
    row = df.first()
    return row[0] if row else None


def column_values(df: DataFrame) -> Iterator:
    """The first column, a partition at a time on the driver."""
    return (r[0] for r in df.select(df.columns[0]).toLocalIterator())


def csv_line(*cells: Column, drop_last: bool = False) -> Column:
    """Cells joined by commas, nulls empty."""
    kept = cells[:-1] if drop_last else cells
    return F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit("")) for c in kept])


def head_bytes(content: Column, n: int) -> Column:
    """The first n bytes of a binary column."""
    return F.substring(content, 1, n)


def tail_bytes(content: Column, n: int) -> Column:
    """The last n bytes of a binary column."""
    return F.when(F.octet_length(content) > n, F.substring(content, -n, n)).otherwise(content)
