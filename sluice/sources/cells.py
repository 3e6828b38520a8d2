"""Versioned cells: (row, family, qualifier, value, ts), as a wide-column store keeps them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELL = ["row", "family", "qualifier"]


def newest(cells: DataFrame, versions: int = 1) -> DataFrame:
    """The latest versions of each cell. One version needs no sort: a maximum, combined early."""
    if versions == 1:
        rest = [c for c in cells.columns if c not in (*CELL, "ts")]
        best = cells.groupBy(*CELL).agg(F.max(F.struct("ts", *rest)).alias("s"))
        return best.select(*CELL, *[F.col(f"s.{c}") for c in ("ts", *rest)]).select(*cells.columns)
    w = Window.partitionBy(*CELL).orderBy(F.desc("ts"))
    return cells.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= versions).drop("__n")


def _picked(cells: DataFrame, columns: list[tuple[str, str | None]] | None, since: int | None, until: int | None) -> DataFrame:
    if columns:
        test: Column = F.lit(False)
        for family, qualifier in columns:
            test = test | ((F.col("family") == family) & (F.lit(True) if qualifier is None else F.col("qualifier") == qualifier))
        cells = cells.filter(test)
    if since is not None:
        cells = cells.filter(F.col("ts") >= since)
    return cells if until is None else cells.filter(F.col("ts") < until)


def get(cells: DataFrame, rows: list, columns=None, since=None, until=None, versions: int = 1) -> DataFrame:
    return newest(_picked(cells.filter(F.col("row").isin(rows)), columns, since, until), versions)


def exists(cells: DataFrame, row, columns=None) -> bool:
    return not _picked(cells.filter(F.col("row") == row), columns, None, None).limit(1).isEmpty()


def scan(cells: DataFrame, start=None, stop=None, columns=None, since=None, until=None, versions: int = 1, reverse: bool = False, limit: int | None = None) -> DataFrame:
    """start <= row < stop in row order (reverse: stop < row <= start, falling), at most limit rows of the store."""
    lo, hi = (F.col("row") > stop if stop is not None else None, F.col("row") <= start if start is not None else None) if reverse else (F.col("row") >= start if start is not None else None, F.col("row") < stop if stop is not None else None)
    for test in (lo, hi):
        if test is not None:
            cells = cells.filter(test)
    cells = _picked(cells, columns, since, until)
    order = F.desc("row") if reverse else F.asc("row")
    if limit is not None:
        first = cells.select("row").distinct().orderBy(order).limit(limit)
        cells = cells.join(first, "row", "left_semi")
    return newest(cells, versions).orderBy(order, "family", "qualifier", F.desc("ts"))


def put(cells: DataFrame, new: DataFrame) -> DataFrame:
    return cells.unionByName(new)


def delete(cells: DataFrame, which: DataFrame, all_versions: bool = True) -> DataFrame:
    """Without the cells of `which`: all versions, or the newest one only."""
    if all_versions:
        return cells.join(which.select(*CELL), CELL, "left_anti")
    doomed = newest(cells).join(which.select(*CELL), CELL, "left_semi").select(*CELL, "ts")
    return cells.join(doomed, [*CELL, "ts"], "left_anti")


def increment(cells: DataFrame, amounts: DataFrame, ts: int) -> DataFrame:
    """A new version of each cell of amounts (row, family, qualifier, amount): its value more."""
    old = newest(cells).select(*CELL, F.col("value").try_cast("long").alias("old"))
    new = amounts.groupBy(*CELL).agg(F.sum("amount").alias("amount")).join(old, CELL, "left")
    return cells.unionByName(new.select(*CELL, (F.coalesce("old", F.lit(0)) + F.col("amount")).cast("string").alias("value"), F.lit(ts).alias("ts")), allowMissingColumns=True)


def check_and_put(cells: DataFrame, row, family: str, qualifier: str, expected: str | None, new: DataFrame) -> tuple[DataFrame, bool]:
    """new is added if the cell's value is the expected one (None: there is no such cell)."""
    found = get(cells, [row], [(family, qualifier)]).first()
    ok = (found is None) if expected is None else (found is not None and found["value"] == expected)
    return (put(cells, new), True) if ok else (cells, False)
