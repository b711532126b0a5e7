"""Vector scalars over ARRAY columns, and mean vectors."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column
from pyspark.sql import functions as F

from echofield.functions.numbers import let


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(doubles(a), doubles(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(doubles(v), F.lit(0.0), lambda s, x: s + x * x))


def unit(v: Column) -> Column:
    """L2-normalised; a zero vector stays zero."""
    return let(norm(v), lambda n: F.transform(doubles(v), lambda x: F.when(n > 0, x / n).otherwise(x)))


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(
        F.aggregate(
            F.zip_with(doubles(a), doubles(b), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x
        )
    )


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def as_ml(v: Column) -> Column:
    return array_to_vector(doubles(v))


def mean_vector(v: Column) -> Column:
    """Aggregate: element-wise mean. Partial sums merge map-side, so a hot group costs one row per task."""
    return vector_to_array(Summarizer.mean(as_ml(v)))
