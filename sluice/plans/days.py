"""Day ranges: "from,to" of yyyyMMdd days."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

FORMAT = "%Y%m%d"


def _day(text: str) -> date:
    return datetime.strptime(text.strip(), FORMAT).date()


def day_range(text: str) -> tuple[str, str, int]:
    """First, last and number of days of "from,to" or of one day; raises ValueError if it is empty."""
    first, _, last = text.partition(",")
    last = last or first
    n = (_day(last) - _day(first)).days + 1
    if n <= 0:
        raise ValueError(f"no day in {text}")
    return first.strip(), last.strip(), n


def day_list(first: str, last: str) -> list[str]:
    """All days, latest first."""
    _, _, n = day_range(f"{first},{last}")
    return [(_day(last) - timedelta(days=i)).strftime(FORMAT) for i in range(n)]


def last_days(first: str, last: str, n: int = 7) -> list[str]:
    return day_list(first, last)[:n]


def day_column(first: str | Column, last: str | Column) -> Column:
    """The days as an array, latest first."""
    d = lambda x: F.to_date(x if isinstance(x, Column) else F.lit(x), "yyyyMMdd")
    return F.transform(F.sequence(d(last), d(first), F.expr("interval -1 day")), lambda x: F.date_format(x, "yyyyMMdd"))


def day_of_epoch(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyyMMdd")
