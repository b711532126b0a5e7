"""Isolation forest, reference-set novelty, and the tier rule."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from echofield.functions import labels as lb
from echofield.functions import vectors as vx
from echofield.operators import order
from echofield.session import durable

_NODES = "tree int, node int, feature int, cut double, left int, right int, size int, depth int"


def _mean_path(n):
    """Average search depth in a random tree of n rows."""
    n = np.asarray(n, dtype=np.float64)
    safe = np.maximum(n, 2.0)
    out = 2.0 * (np.log(safe - 1.0) + 0.5772156649015329) - 2.0 * (safe - 1.0) / safe
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, out))


def isolation_trees(df: DataFrame, vector: str, trees: int = 200, subsample: int = 256, key: str = "id", seed: int = 42) -> DataFrame:
    """Node table of the forest, at most trees x 2 x subsample rows.

    Each tree takes the ``subsample`` rows of the lowest seeded hashes of (key, tree), whatever the number of rows; a rate from
    the row count holds back the others before the shuffle. Each tree grows in its own task.
    """
    size = df.count()
    if size == 0:
        raise ValueError("an isolation forest needs rows")
    # six deviations over the subsample, so that no tree falls short of it
    rate = min(1.0, (subsample + 6 * math.sqrt(subsample) + 6) / size)
    most = min(int(rate * 2.0**63), 2**63 - 1)
    lot = lambda t: F.shiftrightunsigned(F.xxhash64(F.col(key).cast("string"), t, F.lit(seed)), 1)
    mine = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: lot(t) <= F.lit(most))
    drawn = df.select(key, vector, F.explode(mine).alias("tree"))
    w = W.partitionBy("tree").orderBy(lot(F.col("tree")), key)
    dealt = drawn.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= subsample).drop("_r")

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(key)
        tree = int(pdf["tree"].iloc[0])
        rng = np.random.default_rng([seed, tree])
        x = np.vstack(pdf[vector].to_numpy()).astype(np.float64)
        limit = math.ceil(math.log2(max(len(x), 2)))
        nodes, stack = [], [(0, np.arange(len(x)), 0)]
        count = 1
        while stack:
            node, rows, depth = stack.pop()
            spans = x[rows].max(axis=0) - x[rows].min(axis=0)
            usable = np.flatnonzero(spans > 0)
            if depth >= limit or len(rows) <= 1 or not len(usable):
                nodes.append((tree, node, -1, 0.0, -1, -1, len(rows), depth))
                continue
            f = int(rng.choice(usable))
            lo, hi = x[rows, f].min(), x[rows, f].max()
            cut = rng.uniform(lo, hi)
            below = x[rows, f] <= cut
            nodes.append((tree, node, f, float(cut), count, count + 1, len(rows), depth))
            stack += [(count, rows[below], depth + 1), (count + 1, rows[~below], depth + 1)]
            count += 2
        return pd.DataFrame(nodes, columns=[c.split()[0] for c in _NODES.split(", ")])

    return dealt.withColumn("tree", F.col("tree").cast("int")).groupBy("tree").applyInPandas(grow, _NODES)


def isolation_scores(df: DataFrame, nodes: DataFrame, vector: str, key: str = "id", name: str = "raw_score") -> DataFrame:
    """(key, raw score in 0..1), higher = easier to isolate. Scoring is a map over partitions: no shuffle."""
    local = nodes.toPandas().sort_values(["tree", "node"])  # bounded by trees x 2 x subsample rows
    forest = [
        tuple(g[c].to_numpy() for c in ("feature", "cut", "left", "right", "size", "depth")) for _, g in local.groupby("tree")
    ]
    sample = max(int(f[4][0]) for f in forest)
    scale = max(float(_mean_path(sample)), 1.0)

    def run(batches):
        for pdf in batches:
            x = np.vstack(pdf[vector].to_numpy()).astype(np.float64) if len(pdf) else np.zeros((0, 1))
            total = np.zeros(len(pdf))
            for feature, cut, left, right, size, depth in forest:
                at = np.zeros(len(pdf), dtype=np.int64)
                while True:
                    f = feature[at]
                    inner = np.flatnonzero(f >= 0)
                    if not len(inner):
                        break
                    here = at[inner]
                    below = x[inner, f[inner]] <= cut[here]
                    at[inner] = np.where(below, left[here], right[here])
                total += depth[at] + _mean_path(size[at])
            yield pd.DataFrame({key: pdf[key], name: np.round(2.0 ** (-total / len(forest) / scale), 9)})

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, vector).mapInPandas(run, f"{key} {kind}, {name} double")


def isolation_flags(df: DataFrame, vector: str, trees: int = 200, subsample: int = 256, contamination: float = 0.05,
                    key: str = "id", seed: int = 42) -> DataFrame:
    """(key, isolation_score, isolation_anomaly): score minus its (1 - contamination) quantile; positive = anomaly."""
    nodes = isolation_trees(df, vector, trees, subsample, key, seed)
    s = durable(isolation_scores(df, nodes, vector, key))
    limit = order.quantiles(s, "raw_score", {"q": 1 - contamination}).select("q")
    d = s.withColumn("_q", limit.scalar())
    return d.select(key, (F.col("raw_score") - F.col("_q")).alias("isolation_score"), (F.col("raw_score") > F.col("_q")).alias("isolation_anomaly"))


def novelty(df: DataFrame, vector: str, reference: str, nu: float = 0.05, features: int = 256, minimum: int = 20,
            key: str = "id", seed: int = 42) -> DataFrame:
    """(key, ocsvm_score, ocsvm_anomaly) against the rows whose ``reference`` flag is true.

    Standardised vectors go through random Fourier features of an RBF kernel; a row's score is minus its
    similarity to the reference mean, shifted so that a share ``nu`` of the reference is flagged. Fewer than
    ``minimum`` reference rows give the neutral answer.
    """
    flagged = F.coalesce(F.col(reference), F.lit(False))
    if df.filter(flagged).limit(minimum).count() < minimum:
        return df.select(key, F.lit(0.0).alias("ocsvm_score"), F.lit(False).alias("ocsvm_anomaly"))
    d = df.withColumn("_v", vx.as_ml(F.col(vector)))
    scaled = StandardScaler(inputCol="_v", outputCol="_s", withMean=True, withStd=True).fit(d).transform(d)
    base = scaled.select(key, flagged.alias("_ref"), vector_to_array("_s").alias("_x"))
    width = int(df.select(F.size(vector)).first()[0])
    rng = np.random.default_rng(seed)
    weights = rng.normal(0.0, math.sqrt(2.0 / width), (width, features))
    shift = rng.uniform(0.0, 2.0 * math.pi, features)

    def lift(x):
        return math.sqrt(2.0 / features) * np.cos(np.vstack(x.to_numpy()) @ weights + shift)

    from pyspark.sql.types import ArrayType, DoubleType

    @F.pandas_udf(ArrayType(DoubleType()))
    def lifted(x: pd.Series) -> pd.Series:
        return pd.Series(list(lift(x)))

    centre = np.array(base.filter("_ref").agg(vx.mean_vector(lifted("_x")).alias("m")).first()["m"])  # one vector

    @F.pandas_udf(DoubleType())
    def distance(x: pd.Series) -> pd.Series:
        return pd.Series(np.round(-(lift(x) @ centre), 9))

    scored = durable(base.select(key, "_ref", distance("_x").alias("_d")))
    limit = order.quantiles(scored.filter("_ref"), "_d", {"q": 1 - nu}).select("q")
    out = scored.withColumn("_q", limit.scalar())
    return out.select(key, (F.col("_d") - F.col("_q")).alias("ocsvm_score"), (F.col("_d") > F.col("_q")).alias("ocsvm_anomaly"))


def tiers(df: DataFrame) -> DataFrame:
    """Tier-1 = isolated and density noise; severity colour from both flags."""
    iso, noise = F.col("isolation_anomaly"), F.col("hdbscan_is_noise")
    return df.withColumn("tier1_critical", iso & noise).withColumn("severity", lb.severity_colour(iso, noise))
