"""Calendar buckets. All arithmetic is on dates, so the session time zone plays no part."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_start(at: Column) -> Column:
    d = F.to_date(at)
    return F.date_sub(d, F.weekday(d))


def week_label(at: Column) -> Column:
    """Monday/Sunday of the ISO week, yyyy-MM-dd/yyyy-MM-dd; null stays null."""
    start = week_start(at)
    return F.concat(start.cast("string"), F.lit("/"), F.date_add(start, 6).cast("string"))


def month_label(at: Column) -> Column:
    return F.substring(F.to_date(at).cast("string"), 1, 7)


def bucket_start(at: Column, unit: str = "week") -> Column:
    d = F.to_date(at)
    if unit == "day":
        return d
    if unit == "week":
        return week_start(at)
    if unit == "month":
        return F.trunc(d, "month")
    raise ValueError(f"unknown calendar unit {unit!r}")
