"""Points and the ranges of whole numbers that hold them, without a join of all with all."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numbering import work_folder

#: Points and ends of ranges in one part of the line, about.
SHARE = 1 << 16
POINT, FOUND = "__point", "__found"


def first_over(begin: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """For each of n places, the number of the first span [begin, end) over it, -1 if there is none.
    Spans hold a place at least. Each is laid as two that are 2**k long; those are halved down to single places."""
    size, best = end - begin, np.full(n, len(begin))
    for k in reversed(range(n.bit_length())):
        half = best.copy()
        half[1 << k :] = np.minimum(half[1 << k :], best[: n - (1 << k)])
        own = np.flatnonzero(size >> k == 1)
        np.minimum.at(half, begin[own], own)
        np.minimum.at(half, end[own] - (1 << k), own)
        best = half
    return np.where(best < len(begin), best, -1)


def _number(batch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False) if isinstance(batch, pa.RecordBatch) else batch.column(name).to_numpy()


def _parted(borders: np.ndarray):
    def run(batches):
        for batch in batches:
            part = np.searchsorted(borders, _number(batch, POINT), "right")
            yield pa.RecordBatch.from_arrays([batch.column(POINT), pa.array(part)], names=[POINT, "part"])

    return run


def _pieces(borders: np.ndarray, top: int):
    """(part, lo, hi) of ranges (first, last, found), narrowest first by (n, late): the parts that a range
    begins and ends in, and how far it goes there. Of the ranges over a whole part between these, the
    task's narrowest alone."""
    low, high = np.concatenate([[0], borders]), np.concatenate([borders - 1, [top]])

    def piece(part, n, late, first, last, found):
        return pa.RecordBatch.from_arrays([*map(pa.array, (part, np.maximum(first, low[part]), np.minimum(last, high[part]), n, late)), found], names=["part", "lo", "hi", "n", "late", FOUND])

    def run(batches):
        whole = None
        for batch in batches:
            first, last, found = _number(batch, "first"), _number(batch, "last"), batch.column(FOUND)
            n, late = last - first, -first
            order = np.lexsort((late, n))
            order = order[(first[order] <= top) & (last[order] >= 0)]
            a, z = np.searchsorted(borders, first[order], "right"), np.searchsorted(borders, last[order], "right")
            for part, some in ((a, order), (z[z > a], order[z > a])):
                yield piece(part, n[some], late[some], first[some], last[some], found.take(pa.array(some)))
            over = order[z - a > 1]
            if len(over):
                best = first_over(a[z - a > 1] + 1, z[z - a > 1], len(low))
                part = np.flatnonzero(best >= 0)
                some = over[best[part]]
                own = pa.Table.from_batches([piece(part, n[some], late[some], first[some], last[some], found.take(pa.array(some)))])
                whole = own if whole is None else pa.concat_tables([whole, own]).combine_chunks()
                order = np.lexsort([_number(whole, c) for c in ("late", "n", "part")])
                whole = whole.take(pa.array(order[np.unique(_number(whole, "part")[order], return_index=True)[1]]))
        if whole is not None:
            yield from whole.combine_chunks().to_batches()

    return run


def _held(points: pa.Table, pieces: pa.Table) -> pa.Table:
    """In one part of the line: (point, found) of the points that a range holds."""
    at = np.sort(_number(points, POINT))
    order = np.lexsort((_number(pieces, "late"), _number(pieces, "n")))
    begin, end = np.searchsorted(at, _number(pieces, "lo")[order], "left"), np.searchsorted(at, _number(pieces, "hi")[order], "right")
    some = begin < end
    best = first_over(begin[some], end[some], len(at))
    return pa.table({POINT: pa.array(at[best >= 0]), FOUND: pieces.column(FOUND).combine_chunks().take(pa.array(order[some][best[best >= 0]]))})


def _written(df: DataFrame) -> DataFrame:
    path = work_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def narrowest(rows: DataFrame, point: str, ranges: DataFrame, first: str = "first", last: str = "last", bits: int = 32) -> DataFrame:
    """rows with the other columns of the narrowest range that holds their point, null if none does.

    Both ends of a range belong to it; ranges may nest, touch, overlap and repeat. Of two equally
    narrow ones the one that begins later counts, then the one whose other columns come first. Points
    and ends are whole numbers from 0 to 2**bits - 1, 32 bits for an ip; others and null lie nowhere.

    Each distinct point is looked up once. The line is cut at quantiles of points and ends into parts
    of SHARE of them, about. A range goes to the parts that it begins and ends in; of those over a whole
    part, the narrowest one does, and of those that go equally far in a part. So pairs of points and
    ranges are made nowhere, however many ranges hold a point.
    """
    given = [c for c in ranges.columns if c not in (first, last)]
    at, top = F.col(POINT), (1 << bits) - 1
    points = _written(rows.select(F.col(point).cast("long").alias(POINT)).filter((at >= 0) & (at <= F.lit(top))).distinct())
    ends = ranges.select(F.col(first).cast("long").alias("first"), F.col(last).cast("long").alias("last"), F.struct(*given).alias(FOUND))
    ends = _written(ends.filter(F.col("first") <= F.col("last")).groupBy("first", "last").agg(F.min(FOUND).alias(FOUND)))
    marks = points.union(ends.select("first")).union(ends.select("last"))
    parts = marks.count() // SHARE + 1
    marks = marks.approxQuantile(POINT, [i / parts for i in range(1, parts)], 0.25 / parts) if parts > 1 else []
    # A number that is often an end gets a part of its own.
    borders = np.array(sorted({int(x) for x in marks} | {int(x) + 1 for x, y in zip(marks, marks[1:]) if x == y}), np.int64)
    borders = borders[(borders > 0) & (borders <= top)]
    kind = ends.schema[FOUND].dataType.simpleString()
    pieces = ends.mapInArrow(_pieces(borders, top), f"part long, lo long, hi long, n long, late long, {FOUND} {kind}")
    narrow = F.min(F.struct("n", "late", FOUND)).alias("best")
    pieces = pieces.groupBy("part", "lo", "hi").agg(narrow).select("part", "lo", "hi", "best.n", "best.late", f"best.{FOUND}")
    parted = points.mapInArrow(_parted(borders), f"{POINT} long, part long")
    found = parted.groupBy("part").cogroup(pieces.groupBy("part")).applyInArrow(_held, f"{POINT} long, {FOUND} {kind}")
    found = found.select(POINT, *[F.col(f"{FOUND}.`{c}`").alias(c) for c in given])
    return rows.join(found, rows[point].cast("long") == found[POINT], "left").drop(POINT)


def ip_number(ip: Column) -> Column:
    """The number of a dotted IPv4 address; null for any other text."""
    parts = F.split(F.when(ip.rlike(r"\A[0-9]{1,3}(\.[0-9]{1,3}){3}\z"), ip), r"\.")
    numbers = F.transform(parts, lambda p: p.cast("long"))
    value = F.aggregate(numbers, F.lit(0).cast("long"), lambda total, p: total * 256 + p)
    return F.when(~F.exists(numbers, lambda p: p > 255), value)
