"""Deduplication, unions and reshaping."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echofield.functions import vectors as vx


def keep_first(df: DataFrame, text: str, key: str = "id") -> DataFrame:
    """One row per distinct text: the one with the lowest key.

    Grouping is by the SHA-256 of the whole text, and copies collapse inside each task before the shuffle,
    so a text that a third of the rows share sends one row per task. Null texts are equal to each other only.
    """
    rest = [c for c in df.columns]
    g = df.groupBy(F.sha2(F.col(text), 256).alias("_h")).agg(
        F.min_by(F.struct(*rest), F.col(key)).alias("_row")
    )
    return g.select("_row.*")


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def candidate_pool(rankings: list[DataFrame], depth: int, query: str = "query_id", doc: str = "doc_id") -> DataFrame:
    """Union of the top ``depth`` of every ranking; a document keeps its first place (ranking order, then rank)."""
    tagged = [r.filter(F.col("rank") <= depth).select(query, doc, F.lit(i).alias("variant"), "rank") for i, r in enumerate(rankings)]
    return union_all(tagged).groupBy(query, doc).agg(F.min(F.struct("variant", "rank")).alias("first")).select(
        query, doc, F.col("first.variant").alias("variant"), F.col("first.rank").alias("rank")
    )


def melt(df: DataFrame, ids: list[str], values: list[str], name: str = "metric", value: str = "value") -> DataFrame:
    return df.unpivot(ids, [F.col(v).cast("double").alias(v) for v in values], name, value)


def transpose(df: DataFrame, variant: str, variants: list[str], metrics: list[str]) -> DataFrame:
    """Variant rows x metric columns -> metric rows x variant columns."""
    long = melt(df, [variant], metrics)
    return long.groupBy("metric").agg(*[F.max(F.when(F.col(variant) == v, F.col("value"))).alias(v) for v in variants])


def stack_features(df: DataFrame, numbers: list[str], vector: str, name: str = "features") -> DataFrame:
    """Numeric columns and a vector side by side as one ML vector."""
    d = df.withColumn("_v", vx.as_ml(F.col(vector)))
    return VectorAssembler(inputCols=[*numbers, "_v"], outputCol=name).transform(d).drop("_v")


def vector_array(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, vector_to_array(name))
