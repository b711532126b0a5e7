"""Row filters, coercions and projections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def min_length(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    return df.filter(F.length(column) >= n)


def to_number(c: Column) -> Column:
    """Bad text -> null; NaN -> null."""
    v = c.try_cast("double")
    return F.when(F.isnan(v), None).otherwise(v)


def to_time(c: Column) -> Column:
    return F.try_to_timestamp(c)


def project(df: DataFrame, columns: list[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    return df.select(*[c for c in columns if c in df.columns])


def in_set(c: Column, values) -> Column:
    return F.coalesce(c.isin(list(values)), F.lit(False))


def date_range(df: DataFrame, at: str, start: str, end: str) -> DataFrame:
    """Both days included; the bound is half-open so the last microsecond counts and the filter pushes down."""
    kind = df.schema[at].dataType.simpleString()
    lo = F.lit(start).cast("date").cast(kind)
    hi = F.date_add(F.lit(end).cast("date"), 1).cast(kind)
    return df.filter((F.col(at) >= lo) & (F.col(at) < hi))


def metadata_filter(platform=None, severity=None, routing_team=None, anomaly_only: bool = False) -> dict:
    """Only the clauses that were given; a list means any of its values."""
    given = {"platform": platform, "severity": severity, "routing_team": routing_team}
    out = {k: v for k, v in given.items() if v}
    if anomaly_only:
        out["is_anomaly"] = True
    return out


FILTER_COLUMNS = {"platform": "platform", "severity": "severity", "routing_team": "route_category"}


def candidate_mask(df: DataFrame, filters: dict, columns: dict[str, str] | None = None) -> DataFrame:
    """AND of the clauses; clauses on columns the table lacks are ignored."""
    tests = []
    for key, column in (columns or FILTER_COLUMNS).items():
        if key in filters and column in df.columns:
            want = filters[key]
            tests.append(in_set(F.col(column), want if isinstance(want, (list, tuple, set)) else [want]))
    if filters.get("is_anomaly"):
        tests.append(F.coalesce(F.col("isolation_anomaly"), F.lit(False)))
    return df.filter(reduce(lambda a, b: a & b, tests)) if tests else df


def trailing_days(df: DataFrame, at: str, days: int, platform: str | None = None) -> DataFrame:
    """Rows of the last N days before the newest row in scope. The newest time is a one-row subquery."""
    scope = df.filter(F.col("platform") == platform) if platform else df
    newest = scope.agg(F.max(at)).scalar()
    return scope.withColumn("_newest", newest).filter(
        F.col(at) >= F.col("_newest") - F.make_dt_interval(F.lit(days))
    ).drop("_newest")


def name_contains(c: Column, part: str) -> Column:
    return F.coalesce(F.contains(F.lower(c), F.lit(part.lower())), F.lit(False))


def keyword_match(c: Column, pattern: str) -> Column:
    return F.coalesce(c.rlike("(?i)" + pattern), F.lit(False))


def first_present(df: DataFrame, names: list[str], default=None) -> Column:
    """Fallback chain over the columns that exist, then the default."""
    parts = [F.col(n) for n in names if n in df.columns]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts)


def known_categories(df: DataFrame, column: str, order: list[str]) -> DataFrame:
    """Rows whose category is listed, with ``category_order`` = its place in the list."""
    return df.filter(F.col(column).isin(order)).withColumn(
        "category_order", F.array_position(F.array(*[F.lit(x) for x in order]), F.col(column)).cast("int")
    )


def inlined(df: DataFrame, keep: list[str], items: Column, field: str) -> DataFrame:
    """``keep`` and the fields of each struct of the array ``items``; ``field`` is one that is never null.

    For a plain ``inline`` the optimizer adds a filter on the size of the array and pushes it to the scan, which computes an
    array made by expressions a second time. The outer form has no such filter; its rows of empty arrays go afterwards.
    """
    return df.select(*keep, F.inline_outer(items)).filter(F.col(field).isNotNull())
