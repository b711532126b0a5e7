"""Reduced coordinates: principal components and seeded sign projections."""

from __future__ import annotations

import hashlib

from pyspark.ml import Pipeline
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from echofield.functions import vectors as vx


def principal_components(df: DataFrame, vector: str, k: int = 50, name: str = "pca"):
    """(rows with the k coordinates as an array, fitted pipeline). Vectors are centred first.

    The covariance is width x width whatever the row count; rows are read in one distributed pass.
    """
    d = df.withColumn("_v", vx.as_ml(F.col(vector)))
    stages = [StandardScaler(inputCol="_v", outputCol="_c", withMean=True, withStd=False), PCA(k=k, inputCol="_c", outputCol=name)]
    model = Pipeline(stages=stages).fit(d)
    out = model.transform(d).withColumn(name, vector_to_array(name)).drop("_v", "_c")
    return out, model


def variance_report(df: DataFrame, vector: str, k: int = 50) -> DataFrame:
    """(component, explained_variance, cumulative_explained_variance), one row per component."""
    _, model = principal_components(df, vector, k)
    ratios = [(i + 1, float(x)) for i, x in enumerate(model.stages[-1].explainedVariance)]
    r = df.sparkSession.createDataFrame(ratios, "component int, explained_variance double")
    w = W.orderBy("component").rowsBetween(W.unboundedPreceding, 0)  # k rows
    return r.withColumn("cumulative_explained_variance", F.sum("explained_variance").over(w))


def sign_matrix(k: int, width: int, seed: int = 42) -> list[list[float]]:
    """k x width of +-1/sqrt(k); the sign is the first hex digit of md5(seed|row|column) being even."""
    def sign(i, j):
        return 1.0 if int(hashlib.md5(f"{seed}|{i}|{j}".encode()).hexdigest()[0], 16) % 2 == 0 else -1.0

    return [[sign(i, j) / k**0.5 for j in range(width)] for i in range(k)]


def sign_projection(df: DataFrame, vector: str, width: int, k: int = 2, seed: int = 42, prefix: str = "coord") -> DataFrame:
    """coord_1 .. coord_k: a seeded linear projection that needs no fitting, so it is one narrow pass."""
    rows = [F.array(*[F.lit(x) for x in row]) for row in sign_matrix(k, width, seed)]
    return df.select("*", *[F.round(vx.dot(F.col(vector), r), 6).alias(f"{prefix}_{i + 1}") for i, r in enumerate(rows)])
