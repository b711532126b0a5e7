"""Counts, cross-tabs, summaries and fact tables. All group by small keys with map-side partial sums."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from echofield.functions import vectors as vx
from echofield.operators import order


def rows_n():
    return F.count(F.lit(1))


def flag_n(c: Column) -> Column:
    return F.coalesce(F.sum(c.cast("long")), F.lit(0).cast("long"))


def group_counts(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(rows_n().alias(name))


def kpi_row(df: DataFrame) -> DataFrame:
    """Rows, distinct platforms, tier-1 rows and the most frequent cluster name (ties: lowest name)."""
    return df.agg(
        rows_n().alias("total_reviews"),
        F.countDistinct("platform").alias("platforms"),
        flag_n(F.coalesce(F.col("tier1_critical"), F.lit(False))).alias("tier1_alerts"),
        F.mode("cluster_name", True).alias("top_cluster"),
    )


def star_crosstab(df: DataFrame, row: str = "platform", score: str = "score") -> DataFrame:
    """Counts per row key and clipped whole star; the five stars are fixed, so no discovery pass is needed."""
    star = F.greatest(F.lit(1), F.least(F.lit(5), F.col(score).cast("int")))
    wide = df.filter(F.col(score).isNotNull()).select(row, star.alias("star"))
    return wide.groupBy(row).agg(*[F.count_if(F.col("star") == s).alias(f"star_{s}") for s in range(1, 6)])


def row_shares(df: DataFrame, row: str, column: str) -> DataFrame:
    """Long (row, column, n, pct): share of the row total in percent."""
    counts = group_counts(df, [row, column])
    total = F.sum("n").over(W.partitionBy(row))
    return counts.withColumn("pct", F.round(F.col("n") * 100 / total, 4))


def mean_with_interval(df: DataFrame, group: str, value: str) -> DataFrame:
    """Mean and normal 95% interval per group."""
    g = df.groupBy(group).agg(
        F.avg(value).alias("m"), F.stddev_samp(value).alias("s"), F.count(value).alias("n")
    )
    half = 1.96 * F.col("s") / F.sqrt("n")
    return g.select(
        group, "n", F.round("m", 6).alias("mean"),
        F.round(F.col("m") - half, 6).alias("low"), F.round(F.col("m") + half, 6).alias("high"),
    )


def histogram(df: DataFrame, value: str, by: str, bins: int = 40) -> DataFrame:
    """Equal-width bins over the global range, last bin closed; (by, bin, n)."""
    span = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    d = df.withColumn("_s", span.select(F.struct("lo", "hi")).scalar())
    width = (F.col("_s.hi") - F.col("_s.lo")) / bins
    b = F.when(width == 0, 0).otherwise(
        F.least(F.floor((F.col(value) - F.col("_s.lo")) / width), F.lit(bins - 1))
    )
    return d.filter(F.col(value).isNotNull()).groupBy(by, b.cast("int").alias("bin")).agg(rows_n().alias("n"))


def five_numbers(df: DataFrame, value: str, by: str) -> DataFrame:
    """Minimum, quartiles, maximum and 1.5 IQR fences per group; exact."""
    probs = {"minimum": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "maximum": 1.0}
    q = order.quantiles(df, value, probs, [by], digits=6)
    iqr = F.col("q3") - F.col("q1")
    return q.select(
        by, F.col("_total").alias("n"), *probs,
        F.round(F.col("q1") - 1.5 * iqr, 6).alias("low_fence"), F.round(F.col("q3") + 1.5 * iqr, 6).alias("high_fence"),
    )


def density(df: DataFrame, value: str, by: str, points: int = 200, digits: int = 6) -> DataFrame:
    """Gaussian density on an even grid per group.

    Equal values are counted first, so the grid is expanded over distinct values, not over rows.
    """
    at = df.filter(F.col(value).isNotNull()).groupBy(by, F.col(value).cast("double").alias("x")).agg(
        rows_n().alias("c")
    )
    s = df.filter(F.col(value).isNotNull()).groupBy(by).agg(
        rows_n().alias("n"), F.stddev_samp(value).alias("sd"), F.min(value).alias("lo"), F.max(value).alias("hi")
    )
    s = s.withColumn("h", F.col("sd") * F.pow("n", F.lit(-0.2))).filter(F.col("h") > 0)
    start, stop = F.col("lo") - 3 * F.col("h"), F.col("hi") + 3 * F.col("h")
    j = at.join(s, by).withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    grid = start + (stop - start) * F.col("point") / (points - 1)
    z = (grid - F.col("x")) / F.col("h")
    k = F.col("c") * F.exp(-0.5 * z * z) / (F.sqrt(F.lit(2.0) * F.pi()) * F.col("h") * F.col("n"))
    return j.groupBy(by, "point").agg(
        F.round(F.first(grid), 6).alias("x"), F.round(F.sum(k), digits).alias("density")
    )


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, nulls) for the columns that have any, in one pass."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot([], columns, "column", "nulls").filter(F.col("nulls") > 0)


def describe(df: DataFrame, value: str) -> DataFrame:
    """count, mean, std, min, quartiles, max as a long table."""
    base = df.agg(
        F.count(value).cast("double").alias("count"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.min(value).cast("double").alias("min"), F.max(value).cast("double").alias("max"),
    )
    q = order.quantiles(df, value, {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    long = lambda d: d.unpivot([], d.columns, "stat", "value")
    return long(base).unionByName(long(q.drop("_total"))).withColumn("value", F.round("value", 6))


def quality_report(df: DataFrame, columns: list[str], count_by: list[str], length: str) -> DataFrame:
    """Long (section, key, value): rows, nulls, value counts, length statistics."""
    parts = [
        df.agg(rows_n().cast("double").alias("value")).select(
            F.lit("rows").alias("section"), F.lit("total").alias("key"), "value"
        ),
        null_counts(df, columns).select(
            F.lit("nulls").alias("section"), F.col("column").alias("key"), F.col("nulls").cast("double").alias("value")
        ),
        describe(df, length).select(F.lit(length).alias("section"), F.col("stat").alias("key"), "value"),
    ]
    for c in count_by:
        parts.append(
            group_counts(df, [c]).select(
                F.lit(c).alias("section"), F.col(c).alias("key"), F.col("n").cast("double").alias("value")
            )
        )
    return reduce(DataFrame.unionByName, parts)


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """(value, n, share of all rows), most frequent first."""
    counts = group_counts(df, [column]).withColumnRenamed(column, "value")
    counts = counts.withColumn("_all", df.agg(rows_n()).scalar())
    out = counts.select("value", "n", F.round(F.col("n") / F.col("_all"), 6).alias("share"))
    out = out.orderBy(F.desc("n"), F.asc("value"))
    return out.limit(top) if top else out


def first_seen_index(df: DataFrame, label: str, key: str, name: str = "label_index") -> DataFrame:
    """label -> 0, 1, ... in order of first appearance. The window runs over distinct labels only."""
    seen = df.groupBy(label).agg(F.min(key).alias("first_key"))
    w = W.orderBy("first_key", label)
    return seen.select(label, (F.row_number().over(w) - 1).alias(name))


def group_mode(df: DataFrame, group: str, value: str) -> DataFrame:
    """Most frequent value per group, smallest on ties; counts first, so hot groups stay cheap."""
    c = df.filter(F.col(value).isNotNull()).groupBy(group, value).agg(rows_n().alias("n"))
    return c.groupBy(group).agg(F.min_by(value, F.struct(-F.col("n"), F.col(value))).alias("mode"))


def top_counts_map(df: DataFrame, group: str, value: str, top: int = 3) -> DataFrame:
    """group -> map of its ``top`` most frequent values; ranking happens on the count table."""
    c = df.groupBy(group, value).agg(rows_n().alias("n"))
    w = W.partitionBy(group).orderBy(F.desc("n"), F.asc(value))
    best = c.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= top)
    items = F.array_sort(F.collect_list(F.struct("r", value, "n")))
    pairs = F.transform(items, lambda x: F.struct(x[value].alias("key"), x["n"].alias("value")))
    return best.groupBy(group).agg(F.map_from_entries(pairs).alias("top"))


def cluster_stats(df: DataFrame, cluster: str = "kmeans_cluster") -> DataFrame:
    """Size, share, mean rating, anomaly and RED counts, top platforms, modal team, 1-2 star rows."""
    base = df.groupBy(cluster).agg(
        rows_n().alias("size"), F.round(F.avg("score"), 2).alias("avg_rating"),
        flag_n(F.col("isolation_anomaly")).alias("anomalies"),
        F.count_if(F.col("severity") == "RED").alias("red_severity"),
        F.count_if(F.col("score") <= 2).alias("complaints_1_2_star"),
    )
    base = base.withColumn("_all", df.agg(rows_n()).scalar())
    base = base.withColumn("share_pct", F.round(100 * F.col("size") / F.col("_all"), 1)).drop("_all")
    tops = top_counts_map(df, cluster, "platform").withColumnRenamed("top", "top_platforms")
    team = group_mode(df, cluster, "route_category").withColumnRenamed("mode", "top_routing_team")
    return base.join(tops, cluster, "left").join(team, cluster, "left")


def themes(df: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Per cluster: theme name (given label, else modal cluster name), reviews, share, rating, anomalies."""
    g = df.groupBy("kmeans_cluster").agg(
        rows_n().alias("reviews"), F.round(F.avg("score"), 2).alias("avg_rating"),
        flag_n(F.col("isolation_anomaly")).alias("anomalies"),
    ).withColumn("_all", df.agg(rows_n()).scalar())
    g = g.join(group_mode(df, "kmeans_cluster", "cluster_name"), "kmeans_cluster", "left")
    theme = F.col("mode")
    if names is not None:
        g = g.join(names, g.kmeans_cluster == names.cluster_id, "left")
        theme = F.coalesce(F.col("label"), theme)
    return g.select(
        "kmeans_cluster", theme.alias("theme"), "reviews",
        F.round(100 * F.col("reviews") / F.col("_all"), 1).alias("share_pct"), "avg_rating", "anomalies",
    )


def report_facts(df: DataFrame) -> DataFrame:
    """Long (section, key, value) of every number a written brief uses."""
    head = df.agg(
        rows_n().cast("double").alias("total_reviews"),
        F.round(F.avg("score"), 2).alias("avg_rating"),
        F.round(100 * F.avg(F.coalesce((F.col("score") <= 2).cast("double"), F.lit(0.0))), 1).alias("pct_1_or_2_star"),
        flag_n(F.col("isolation_anomaly")).cast("double").alias("critical_anomalies"),
    )
    parts = [head.unpivot([], head.columns, "key", "value").select(F.lit("head").alias("section"), "key", "value")]
    for section, c in (("severity", "severity"), ("platform", "platform"), ("routing_team", "route_category")):
        parts.append(
            group_counts(df.filter(F.col(c).isNotNull()), [c]).select(
                F.lit(section).alias("section"), F.col(c).alias("key"), F.col("n").cast("double").alias("value")
            )
        )
    t = themes(df)
    cols = ["reviews", "share_pct", "avg_rating", "anomalies"]
    t = t.select(F.col("kmeans_cluster").cast("string").alias("c"), *[F.col(x).cast("double").alias(x) for x in cols])
    t = t.unpivot("c", cols, "measure", "value")
    parts.append(t.select(F.lit("theme").alias("section"), F.concat("c", F.lit("/"), "measure").alias("key"), "value"))
    return reduce(DataFrame.unionByName, parts)


def mean_pair_cosine(
    df: DataFrame, bucket: str, vector: str, key: str = "id", first: int | None = None, minimum: int = 5
) -> DataFrame:
    """(left, right, mean cosine over all pairs) for every two buckets, self pairs included.

    The mean over all pairs of two sets equals the dot product of their mean unit vectors, so no pair of
    rows is ever formed. ``first`` takes that many rows per bucket by key; None takes all.
    """
    if first:
        w = W.partitionBy(bucket).orderBy(key)
        df = df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= first)
    m = df.withColumn("_u", vx.unit(F.col(vector))).groupBy(bucket).agg(
        vx.mean_vector(F.col("_u")).alias("m"), rows_n().alias("n")
    ).filter(F.col("n") >= minimum)
    a = m.select(F.col(bucket).alias("left"), F.col("m").alias("a"))
    b = m.select(F.col(bucket).alias("right"), F.col("m").alias("b"))
    return a.join(b, F.col("left") <= F.col("right")).select(
        "left", "right", F.round(vx.dot(F.col("a"), F.col("b")), 6).alias("mean_cosine")
    )


def spread_summary(df: DataFrame, group: str, value: str) -> DataFrame:
    """n, mean, population std, min, max, p25/50/75/90 per group, best mean first."""
    base = df.groupBy(group).agg(
        rows_n().alias("n_samples"), F.round(F.avg(value), 6).alias("avg_" + value),
        F.round(F.stddev_pop(value), 6).alias("std_" + value),
        F.round(F.min(value), 6).alias("min_" + value), F.round(F.max(value), 6).alias("max_" + value),
    )
    probs = {f"p{p}_{value}": p / 100 for p in (25, 50, 75, 90)}
    q = order.quantiles(df, value, probs, [group], digits=6).drop("_total")
    return base.join(q, group).orderBy(F.desc("avg_" + value), F.asc(group))


def filter_domains(df: DataFrame) -> DataFrame:
    """Choices for the filter controls: (domain, value); dates as text."""
    p = df.select(F.lit("platform").alias("domain"), F.col("platform").alias("value")).distinct()
    s = df.select(F.lit("star_bucket").alias("domain"), F.col("star_bucket").alias("value")).distinct()
    d = df.agg(F.min("at").alias("lo"), F.max("at").alias("hi"))
    d = d.select(F.inline(F.array(
        F.struct(F.lit("date_from").alias("domain"), F.to_date("lo").cast("string").alias("value")),
        F.struct(F.lit("date_to").alias("domain"), F.to_date("hi").cast("string").alias("value")),
    )))
    return p.unionByName(s).unionByName(d).orderBy("domain", "value")


def top_categories(df: DataFrame, column: str, top: int) -> DataFrame:
    """Rows of the ``top`` most frequent categories (ties: name); the kept list has at most ``top`` rows."""
    keep = group_counts(df.filter(F.col(column).isNotNull()), [column]).orderBy(F.desc("n"), F.asc(column)).limit(top)
    return df.join(F.broadcast(keep.select(column)), column, "left_semi")


def mean_bucket_counts(counts: DataFrame, cluster: str, bucket: str, n: str = "n", top: int = 6) -> DataFrame:
    """Mean count per bucket over the other keys, for the largest clusters by total count."""
    keep = counts.groupBy(cluster).agg(F.sum(n).alias("t")).orderBy(F.desc("t"), F.asc(cluster)).limit(top)
    kept = counts.join(F.broadcast(keep.select(cluster)), cluster, "left_semi")
    return kept.groupBy(bucket, cluster).agg(F.round(F.avg(n), 6).alias("mean_count"))
