"""Global order without a single-partition window.

Equal values are pre-aggregated, so a value that a third of the rows share is one row. The rows are then
range-partitioned by group and value over as many partitions as the session shuffles to, which grows with the
cluster and cuts a hot group at its own values, and written once, so that every later use sees the same ranges.
Ranks inside a range come from a window over that range; range offsets come from a table of one row for each
group and range. Results are exact wherever the cuts fall.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from echofield.sources.tables import written


def running_totals(
    df: DataFrame, key: str, sums: dict[str, Column], groups: list[str] | None = None, descending: bool = False
) -> DataFrame:
    """One row per (groups, key): each sum at the key, and ``run_<name>`` up to and including the key.

    ``groups`` must not be null. Rows with a null key are dropped.
    """
    groups = list(groups or [])
    at_key = df.filter(F.col(key).isNotNull()).groupBy(*groups, key).agg(*[e.alias(n) for n, e in sums.items()])
    at_key = written(at_key.repartitionByRange(*groups, key).withColumn("_range", F.spark_partition_id()), "ranges")
    by_range = at_key.groupBy(*groups, "_range").agg(*[F.sum(n).alias(n) for n in sums])
    r_order = F.desc("_range") if descending else F.asc("_range")
    before = W.partitionBy(*groups).orderBy(r_order).rowsBetween(W.unboundedPreceding, -1)
    offsets = by_range.select(
        *groups, "_range", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_before_{n}") for n in sums]
    )
    k_order = F.desc(key) if descending else F.asc(key)
    inside = W.partitionBy(*groups, "_range").orderBy(k_order).rowsBetween(W.unboundedPreceding, 0)
    ranked = at_key.select("*", *[F.sum(n).over(inside).alias(f"_in_{n}") for n in sums])
    return ranked.join(offsets, [*groups, "_range"]).select(
        *groups, key, *sums, *[(F.col(f"_in_{n}") + F.col(f"_before_{n}")).alias(f"run_{n}") for n in sums]
    )


def dense_ids(df: DataFrame, key: str, name: str = "row_id") -> DataFrame:
    """0, 1, 2, ... in ``key`` order; ``key`` must be a unique number. No global window."""
    pos = running_totals(df.select(key), key, {"n": F.count(F.lit(1))})
    return df.join(pos.select(key, (F.col("run_n") - 1).alias(name)), key)


def _at_ranks(df: DataFrame, value: str, ranks: dict[str, Column], groups: list[str]) -> DataFrame:
    """Per group the values at the given 0-based ranks; each rank is an expression over ``_total``."""
    run = running_totals(df, value, {"n": F.count(F.lit(1))}, groups)
    if groups:
        run = run.join(run.groupBy(*groups).agg(F.sum("n").alias("_total")), groups)
    else:
        run = run.withColumn("_total", run.agg(F.sum("n")).scalar())
    hit = lambda r: (F.col("run_n") - F.col("n") <= r) & (r < F.col("run_n"))
    return (
        run.groupBy(*groups, "_total")
        .agg(*[F.max(F.when(hit(r), F.col(value))).alias(n) for n, r in ranks.items()])
    )


def quantiles(
    df: DataFrame, value: str, probs: dict[str, float], groups: list[str] | None = None, digits: int | None = None
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group, column ``_total`` = non-null rows."""
    groups = list(groups or [])
    pos = {n: F.lit(p) * (F.col("_total") - 1) for n, p in probs.items()}
    ranks = {f"_lo_{n}": F.floor(e) for n, e in pos.items()} | {f"_hi_{n}": F.ceil(e) for n, e in pos.items()}
    got = _at_ranks(df, value, ranks, groups)

    def between(n):
        lo, hi = F.col(f"_lo_{n}"), F.col(f"_hi_{n}")
        v = lo + (hi - lo) * (pos[n] - F.floor(pos[n]))
        return (F.round(v, digits) if digits is not None else v).alias(n)

    return got.select(*groups, F.col("_total"), *[between(n) for n in probs])


def nearest_rank(df: DataFrame, value: str, percents: dict[str, float], groups: list[str] | None = None) -> DataFrame:
    """Order statistics at the half-even rounded rank p/100*(n-1): no interpolation."""
    groups = list(groups or [])
    ranks = {
        n: F.least(F.bround(F.lit(p) / 100 * (F.col("_total") - 1)).cast("long"), F.col("_total") - 1)
        for n, p in percents.items()
    }
    return _at_ranks(df, value, ranks, groups).select(*groups, "_total", *percents)


def lowest_share(df: DataFrame, value: str, share: float, group: str | None = None) -> DataFrame:
    """(group, _total, _limit): the value at place ceil(share * rows) of each group, so that many rows are <= it."""
    groups = [group] if group else []
    rank = {"_limit": F.greatest(F.ceil(F.lit(share) * F.col("_total")).cast("long") - 1, F.lit(0))}
    return _at_ranks(df, value, rank, groups).select(*groups, "_total", "_limit")
