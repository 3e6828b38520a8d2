"""Device ids: line statistics, clean-up, character tests."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..plans.reports import MOBILE, PC

#: Device types and the length of their ids in bytes.
LENGTHS = {"android-id": 16, "idfa": 36, "imei": 15, "mandroid-id": 32, "sandroid-id": 40, "midfa": 32, "sidfa": 40, "mimei": 32, "simei": 40, "": 0}
ALIASES = {"android_id": "android-id"}
#: Lengths of web visitor ids.
COOKIE_LENGTHS = (15, 16)


class DeviceError(ValueError):
    """Unknown device type."""


def is_hex(c: Column) -> Column:
    return c.rlike(r"\A[0-9a-fA-F]*\z")


def is_idfa(c: Column) -> Column:
    return c.rlike(r"\A[0-9a-fA-F_-]*\z")


def is_number(c: Column) -> Column:
    """Digits alone; empty text is one, too."""
    return c.rlike(r"\A[0-9]*\z")


def is_cookie(c: Column) -> Column:
    return F.length(c).isin(*COOKIE_LENGTHS)


def length_of(kind: Column) -> Column:
    """Length of a type's ids; null for an unknown type."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in LENGTHS.items() for x in kv]), kind)


def _words(line: Column) -> Column:
    return F.filter(F.split(line, r"\s+"), lambda w: w != "")


def line_stats(lines: DataFrame, etype: int = MOBILE, column: str = "value") -> DataFrame:
    """(all, invalid, valid) lines in one pass. Blank lines don't count. A mobile line of two
    words is valid if its type is known and its id has the type's length."""
    w = _words(F.coalesce(F.col(column), F.lit("")))
    filled = F.size(w) > 0
    if etype == MOBILE:
        fits = F.coalesce(F.octet_length(F.get(w, F.lit(1))) == length_of(F.get(w, F.lit(0))), F.lit(False))
        bad = filled & (F.size(w) == 2) & ~fits
    else:
        bad = F.lit(False)
    count = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0))
    return lines.agg(count(filled).alias("all_lines"), count(bad).alias("invalid"), count(filled & ~bad).alias("valid"))


def charset_ok(kind: Column, id_: Column) -> Column:
    return F.when(kind == "imei", is_number(id_)).when(kind == "idfa", is_idfa(id_)).when(kind.isin(*[k for k in LENGTHS if k]), is_hex(id_)).otherwise(True)


def normalise(lines: DataFrame, etype: int = MOBILE, sub_type: str = "", column: str = "value") -> DataFrame:
    """Distinct clean lines.

    PC lines pass. Mobile: `type id` goes if the id's length or characters are wrong for a known
    type, else it is joined by a tab; a lone id gets the sub-type if its length fits it (`did`: 36
    is an idfa, 16 an android-id); lines of other lengths are joined by tabs.
    """
    distinct = lines.select(column).filter(F.col(column).isNotNull()).distinct()
    if etype == PC:
        return distinct
    sub_type = ALIASES.get(sub_type, sub_type)
    if sub_type != "did" and sub_type not in LENGTHS:
        raise DeviceError(f"unknown device type {sub_type}")
    w = _words(F.col(column))
    raw = F.get(w, F.lit(0))
    kind, id_ = F.when(raw == "android_id", "android-id").otherwise(raw), F.get(w, F.lit(1))
    fits = length_of(kind).isNull() | ((F.octet_length(id_) == length_of(kind)) & charset_ok(kind, id_))
    if sub_type == "did":
        own = F.when(F.octet_length(raw) == LENGTHS["idfa"], "idfa").when(F.octet_length(raw) == LENGTHS["android-id"], "android-id")
    else:
        own = F.when(F.octet_length(raw) == LENGTHS[sub_type], F.lit(sub_type))
    n = F.size(w)
    clean = (
        F.when(n == 2, F.when(fits, F.concat_ws("\t", kind, id_)))
        .when(n == 1, F.when(own.isNotNull() & charset_ok(own, raw), F.concat_ws("\t", own, raw)))
        .when(n > 2, F.array_join(w, "\t"))
    )
    return distinct.select(clean.alias(column)).filter(F.col(column).isNotNull()).distinct()


def export_lines(audience: DataFrame, etype: int) -> tuple[DataFrame, DataFrame]:
    """(lines, totals): the file lines of an audience (visitor_id, or typ and did), and the number
    of rows before rows without a type are left out."""
    total = audience.agg(F.count(F.lit(1)).alias("total"))
    if etype == PC:
        return audience.select(F.col("visitor_id").cast("string").alias("value")), total
    return audience.filter(F.coalesce("typ", F.lit("")) != "").select(F.concat_ws("\t", "typ", "did").alias("value")), total


def export_to(audience: DataFrame, etype: int, path: str) -> dict[str, int]:
    """Write an audience's file lines and say what was written: total (rows, before rows without a type
    are left out), lines and bytes. All is counted in the pass that writes, on the tasks that succeed."""
    name = uuid.uuid4().hex
    seen, written = Observation(f"seen-{name}"), Observation(f"written-{name}")
    lines, _ = export_lines(audience.observe(seen, F.count(F.lit(1)).alias("total")), etype)
    size = F.coalesce(F.sum(F.octet_length("value").cast("long") + 1), F.lit(0))
    lines.observe(written, F.count(F.lit(1)).alias("lines"), size.alias("bytes")).write.mode("overwrite").text(path)
    return {**seen.get, **written.get}


def export_partition(table: DataFrame, column: str, value, etype: int) -> tuple[DataFrame, DataFrame]:
    """export_lines() of one partition of a table of audiences; the filter reaches the partitions."""
    return export_lines(table.filter(F.col(column) == F.lit(value)), etype)
