"""Queues, top-k and deterministic samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from echofield.functions import text as tx


def alert_queue(df: DataFrame) -> DataFrame:
    """Tier-1 rows, most isolated first, with a text preview."""
    return (
        df.filter("tier1_critical")
        .orderBy(F.desc("isolation_score"), F.asc("id"))
        .select("id", "platform", "cluster_name", tx.cut(F.col("content"), 180, "...").alias("content"),
                "isolation_score", "severity")
    )


def triage_queue(df: DataFrame, threshold: float = 0.8, top: int = 200) -> DataFrame:
    return df.filter(F.col("severity_score_ml") >= threshold).orderBy(F.desc("severity_score_ml"), F.asc("id")).limit(top)


def watchlist(df: DataFrame, top: int = 100) -> DataFrame:
    return df.orderBy(F.desc("churn_risk_score"), F.asc("id")).limit(top)


def critical_sample(df: DataFrame, top: int = 12, ascending: bool = False) -> DataFrame:
    """Anomalies with the highest isolation score (or the lowest with ``ascending``)."""
    order = F.asc("isolation_score") if ascending else F.desc("isolation_score")
    return df.filter("isolation_anomaly").orderBy(order, F.asc("id")).limit(top).withColumn(
        "content", tx.cut(F.col("content"), 220)
    )


def top_per_group(df: DataFrame, group: str, score: str, key: str, n: int, name: str = "rank") -> DataFrame:
    """The n best rows of every group, ranked; each task first cuts its share to n per group."""
    w = W.partitionBy(group).orderBy(F.desc(score), F.asc(key))
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)


def _lottery(key: str, seed: int):
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))


def sample_rows(df: DataFrame, n: int, key: str = "id", seed: int = 42) -> DataFrame:
    """n rows without replacement; the same rows whatever the partitioning."""
    return df.orderBy(_lottery(key, seed), F.asc(key)).limit(n)


def sample_per_label(df: DataFrame, label: str, n: int = 40, minimum: int = 120, key: str = "id", seed: int = 42):
    """Up to n rows per label, or none when the table is smaller than ``minimum``."""
    w = W.partitionBy(label).orderBy(_lottery(key, seed), F.asc(key))
    picked = df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r")
    return picked.withColumn("_n", df.agg(F.count(F.lit(1))).scalar()).filter(F.col("_n") >= minimum).drop("_n")


def best_model(metrics: DataFrame, metric: str, position: str = "position") -> DataFrame:
    """The row with the highest metric; the earliest candidate wins ties. One row per candidate goes in."""
    return metrics.filter(F.col(metric).isNotNull()).orderBy(F.desc(metric), F.asc(position)).limit(1)


def preview(df: DataFrame, n: int = 5, cut: int = 120) -> DataFrame:
    return df.filter(F.col("star_bucket") == "complaint").orderBy("id").limit(n).select(
        "id", "platform", tx.cut(F.col("cleaned_content"), cut).alias("preview")
    )
