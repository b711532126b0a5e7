"""Counts over calendar buckets: spikes and drift. Windows run over aggregated bucket tables only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from echofield.functions import vectors as vx
from echofield.operators import order
from echofield.operators.profile import rows_n

EPS = 1e-9


def bucket_counts(df: DataFrame, keys: list[str], bucket: str, name: str = "complaint_count") -> DataFrame:
    """Rows per (keys, bucket); null buckets are left out."""
    return df.filter(F.col(bucket).isNotNull()).groupBy(*keys, bucket).agg(rows_n().alias(name))


def densify(counts: DataFrame, keys: list[str], bucket: str, name: str = "complaint_count", days: int = 7) -> DataFrame:
    """Zero rows for the buckets between a key's first and last one."""
    span = counts.groupBy(*keys).agg(F.min(bucket).alias("lo"), F.max(bucket).alias("hi"))
    step = F.make_dt_interval(F.lit(days))
    grid = span.select(*keys, F.explode(F.sequence("lo", "hi", step)).alias(bucket))
    return grid.join(counts, [*keys, bucket], "left").withColumn(name, F.coalesce(name, F.lit(0).cast("long")))


def rolling(counts: DataFrame, keys: list[str], bucket: str, name: str, window: int = 4, minimum: int = 2,
            frame: str = "prior") -> DataFrame:
    """Rolling mean and sample deviation; null while the frame has fewer than ``minimum`` rows.

    ``inclusive`` ends the frame at the current row; ``prior`` ends it one row before, so that a jump is
    compared with the weeks that came before it.
    """
    lo, hi = {"inclusive": (-(window - 1), 0), "prior": (-window, -1)}[frame]
    w = W.partitionBy(*keys).orderBy(bucket).rowsBetween(lo, hi)
    enough = F.count(name).over(w) >= minimum
    return counts.select(
        "*",
        F.when(enough, F.round(F.avg(name).over(w), 6)).alias("rolling_mean"),
        F.when(enough, F.round(F.stddev_samp(name).over(w), 6)).alias("rolling_std"),
    )


def spikes(rolled: DataFrame, name: str = "complaint_count", threshold: float = 2.5) -> DataFrame:
    z = (F.col(name) - F.col("rolling_mean")) / F.nullif("rolling_std", F.lit(0.0))
    return rolled.withColumn("z_score", F.round(z, 6)).withColumn(
        "is_spike", F.coalesce(F.col("z_score") > threshold, F.lit(False))
    )


def spike_report(df: DataFrame, keys: list[str], bucket: str, frame: str = "prior", dense_days: int | None = None):
    counts = bucket_counts(df, keys, bucket)
    if dense_days:
        counts = densify(counts, keys, bucket, days=dense_days)
    return spikes(rolling(counts, keys, bucket, "complaint_count", frame=frame))


def consecutive(df: DataFrame, bucket: str, minimum: int = 5) -> DataFrame:
    """Present buckets paired with the previous present one; a pair needs ``minimum`` rows on both sides.

    The window runs over one row per bucket.
    """
    b = df.filter(F.col(bucket).isNotNull()).groupBy(bucket).agg(rows_n().alias("n"))
    w = W.orderBy(bucket)
    return b.select(
        bucket, F.lag(bucket).over(w).alias("prev_" + bucket), "n", F.lag("n").over(w).alias("prev_n")
    ).filter((F.col("n") >= minimum) & (F.col("prev_n") >= minimum))


def topic_shares(df: DataFrame, bucket: str, topic: str) -> DataFrame:
    counts = df.filter(F.col(bucket).isNotNull()).groupBy(bucket, topic).agg(rows_n().alias("n"))
    return counts.select(bucket, topic, (F.col("n") / F.sum("n").over(W.partitionBy(bucket))).alias("share"))


def aligned_shares(df: DataFrame, bucket: str, topic: str, minimum: int = 5) -> DataFrame:
    """(bucket, topic, p = share in the previous bucket, q = share in this one); absent topics count 0."""
    pairs = consecutive(df, bucket, minimum).select(bucket, "prev_" + bucket)
    s = topic_shares(df, bucket, topic)
    now = pairs.join(s, bucket).select(bucket, topic, F.lit(0.0).alias("p"), F.col("share").alias("q"))
    before = (
        pairs.join(s.withColumnRenamed(bucket, "prev_" + bucket), "prev_" + bucket)
        .select(bucket, topic, F.col("share").alias("p"), F.lit(0.0).alias("q"))
    )
    return now.unionByName(before).groupBy(bucket, topic).agg(F.sum("p").alias("p"), F.sum("q").alias("q"))


def divergence_terms(p: Column, q: Column) -> Column:
    m = 0.5 * (p + q)
    return 0.5 * (p * F.log((p + EPS) / (m + EPS)) + q * F.log((q + EPS) / (m + EPS)))


def share_divergence(df: DataFrame, bucket: str, topic: str, minimum: int = 5) -> DataFrame:
    """Jensen-Shannon divergence (natural log) between consecutive buckets."""
    a = aligned_shares(df, bucket, topic, minimum)
    return a.groupBy(bucket).agg(F.sum(divergence_terms(F.col("p"), F.col("q"))).alias("js_divergence"))


def centroid_shift(df: DataFrame, bucket: str, vector: str, minimum: int = 5) -> DataFrame:
    """Distance between the mean vectors of consecutive buckets."""
    pairs = consecutive(df, bucket, minimum).select(bucket, "prev_" + bucket)
    c = df.groupBy(bucket).agg(vx.mean_vector(F.col(vector)).alias("cur"))
    p = c.select(F.col(bucket).alias("prev_" + bucket), F.col("cur").alias("prev"))
    return pairs.join(c, bucket).join(p, "prev_" + bucket).select(
        bucket, "prev_" + bucket, vx.distance(F.col("cur"), F.col("prev")).alias("centroid_shift")
    )


def drift_report(df: DataFrame, bucket: str, topic: str, vector: str, minimum: int = 5, limit: float = 1.5):
    """Shift and divergence per bucket pair, their z-scores over the report, and the alert flag."""
    r = centroid_shift(df, bucket, vector, minimum).join(share_divergence(df, bucket, topic, minimum), bucket)
    r = r.withColumn("centroid_shift", F.round("centroid_shift", 6)).withColumn(
        "js_divergence", F.round("js_divergence", 6)
    )
    whole = W.partitionBy()  # one row per bucket pair

    def z(c):
        return F.round((F.col(c) - F.avg(c).over(whole)) / (F.stddev_samp(c).over(whole) + EPS), 4)

    r = r.withColumn("shift_z", z("centroid_shift")).withColumn("js_z", z("js_divergence"))
    return r.withColumn("is_drift_alert", F.coalesce((F.col("shift_z") > limit) | (F.col("js_z") > limit), F.lit(False)))


def drift_summary(report: DataFrame) -> DataFrame:
    """Long (metric, value, kind) over a drift report."""
    alert = F.col("is_drift_alert").cast("double")
    s = report.agg(
        rows_n().cast("double").alias("weeks_evaluated"), F.sum(alert).alias("drift_alert_weeks"),
        F.coalesce(F.avg(alert), F.lit(0.0)).alias("alert_rate"),
        F.avg("centroid_shift").alias("mean_centroid_shift"), F.stddev_samp("centroid_shift").alias("std_centroid_shift"),
        F.avg("js_divergence").alias("mean_js_divergence"), F.max("js_divergence").alias("max_js_divergence"),
        F.max("shift_z").alias("max_shift_z"), F.max("js_z").alias("max_js_z"),
    )
    kind = F.when(F.col("metric").isin("weeks_evaluated", "drift_alert_weeks"), "count").when(
        F.col("metric") == "alert_rate", "rate"
    ).otherwise("numeric")
    return s.unpivot([], s.columns, "metric", "value").select("metric", F.round("value", 6).alias("value"), kind.alias("kind"))


def cumulative_share(df: DataFrame, component: str, share: str) -> DataFrame:
    """Running sum over components; one row per component (bounded by the vector width)."""
    w = W.orderBy(component).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn("cumulative", F.sum(share).over(w))


def history_text(df: DataFrame, conv: str, turn: str, question: str, answer: str, turns: int = 3, cut: int = 300):
    """Q/A lines of up to ``turns`` earlier turns, whatever their numbers: turns are counted by their order.

    Places come from range sums, each turn hands its line to the next few places, and the lines meet by
    (conversation, place), so one very long conversation spreads over all tasks. Turns that share a number share a
    place; conversations and turns must not be null.
    """
    at = order.running_totals(df.select(conv, turn).distinct(), turn, {"n": F.count(F.lit(1))}, [conv]).select(conv, turn, F.col("run_n").alias("_at"))
    df = df.join(at, [conv, turn])
    line = F.concat(F.lit("Q: "), F.col(question), F.lit("\nA: "), F.substring(F.col(answer), 1, cut))
    given = df.select(conv, F.col("_at").alias("_from"), line.alias("_line")).withColumn(
        "_at", F.explode(F.sequence(F.col("_from") + 1, F.col("_from") + turns))
    )
    lines = given.groupBy(conv, "_at").agg(F.array_sort(F.collect_list(F.struct("_from", "_line"))).alias("_ls"))
    out = df.join(lines, [conv, "_at"], "left").drop("_at")
    text = F.array_join(F.transform("_ls", lambda x: x["_line"]), "\n")
    return out.withColumn("history", F.coalesce(text, F.lit(""))).drop("_ls")
