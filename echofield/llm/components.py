"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echofield.llm.common import release, staged


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for every node of ``links``.

    Every round takes the smallest root among the neighbours, hangs the old root below the new one as well, and
    then follows the root's own root, so that rounds grow with the logarithm of the longest path. Each round is written
    to the shared folder. Nothing is gathered by node: minima are partial sums of a kind.
    """
    both = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null and u <> v")
    both = staged(both.union(both.select("v", "u")).distinct(), "links")
    roots = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("_v"))
    roots = staged(roots.select("node", F.least("node", "_v").alias("root")), "roots")
    while True:
        near = both.join(roots.select(F.col("node").alias("v"), "root"), "v").groupBy(F.col("u").alias("node")).agg(F.min("root").alias("_near"))
        step = roots.join(near, "node").select("node", F.col("root").alias("_old"), F.least("root", "_near").alias("root"))
        hung = step.filter("root < _old").groupBy(F.col("_old").alias("node")).agg(F.min("root").alias("_hung"))
        step = step.select("node", "root").join(hung, "node", "left").select("node", F.least("root", F.coalesce("_hung", "root")).alias("root"))
        step = staged(step, "roots")
        top = step.select(F.col("node").alias("root"), F.col("root").alias("_top"))
        new = staged(step.join(top, "root", "left").select("node", F.coalesce("_top", "root").alias("root")), "roots")
        same = new.join(roots.withColumnRenamed("root", "_old"), "node").filter("root <> _old").isEmpty()
        release(step, roots)
        if same:
            release(both)
            return new
        roots = new
