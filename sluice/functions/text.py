"""Small text helpers."""

from __future__ import annotations

import os
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def human_bytes(n: Column) -> Column:
    """1.5K, 2.0M and so on, by powers of 1024."""
    out = F.concat(n.cast("string"), F.lit("B"))
    for i, unit in enumerate("KMGTP", 1):
        step = 1024**i
        out = F.when(n >= step, F.concat(F.format_number(n / step, 1), F.lit(unit))).otherwise(out)
    return out


def replace_extension(path: str, extension: str) -> str:
    return os.path.splitext(path)[0] + ("" if not extension else "." + extension.lstrip("."))


def unique_names(paths: list[str], now: datetime | None = None) -> list[str]:
    """A name of a text file beside each path, with the time; of names that would be one, later ones
    get a number."""
    stamp, seen, out = (now or datetime.now()).strftime("%Y%m%d%H%M%S"), {}, []
    for p in paths:
        name = os.path.splitext(p)[0] + stamp
        n = seen[name] = seen.get(name, 0) + 1
        out.append(f"{name}{f'-{n}' if n > 1 else ''}.txt")
    return out


def job_prefix(statement: Column) -> Column:
    return F.substring(F.md5(statement), 1, 8)
