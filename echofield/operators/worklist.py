"""Labelling worklist: representative rows per cluster with a membership signature."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echofield.operators import groups, profile
from echofield.sources import tables as src


def signatures(members: DataFrame, keys: list[str], item: str, order: str, prefix: Column | None = None) -> DataFrame:
    """md5 of the ordered member ids per key. Meant for short lists (representatives, pools)."""
    ids = F.transform(F.array_sort(F.collect_list(F.struct(order, item))), lambda x: x[item])
    text = F.array_join("ids", ",")
    return members.groupBy(*keys).agg(ids.alias("ids")).withColumn(
        "signature", F.md5(F.concat(prefix, text) if prefix is not None else text)
    )


def representatives(df: DataFrame, cluster: str, vector: str, n: int = 12, minimum: int = 10) -> DataFrame:
    """The n rows nearest each centroid, taken from the 1-2 star rows where a cluster has enough of them.

    Density noise (-1) is not a cluster. Adds ``focus`` = complaint rows only.
    """
    d = df.filter(F.col(cluster) != -1).withColumn("_low", F.coalesce(F.col("score") <= 2, F.lit(False)))
    enough = d.groupBy(cluster).agg((F.count_if(F.col("_low")) >= minimum).alias("focus"))
    d = d.join(enough, cluster).withColumn("_pick", F.col("_low") | ~F.col("focus"))
    return groups.nearest_members(d, cluster, vector, n, pick="_pick").drop("_pick", "_low")


def insight_worklist(df: DataFrame, cluster: str, vector: str, cached: DataFrame | None = None, n: int = 12) -> DataFrame:
    """Per cluster: focus flag, representative ids, signature and statistics; unchanged clusters are dropped."""
    reps = representatives(df, cluster, vector, n)
    sig = signatures(reps, [cluster, "focus"], "sid", "rank", F.when(F.col("focus"), "c").otherwise("a"))
    out = sig.join(profile.cluster_stats(df, cluster), cluster)
    return src.changed_keys(out, cached, [cluster]) if cached is not None else out
