"""K-means with restarts, choice of k, silhouette, and density clusters on a grid."""

from __future__ import annotations

import math
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echofield.functions import vectors as vx
from echofield.operators import order, pick
from echofield.operators.profile import rows_n
from echofield.session import durable


ROWS_PER_PARTITION = 20_000


def _points(df: DataFrame, vector: str) -> DataFrame:
    """The vectors, persisted, in few partitions if they are few: every step of a fit is one job over them."""
    d = df.select(vx.as_ml(F.col(vector)).alias("features")).persist()
    return d.coalesce(max(1, d.count() // ROWS_PER_PARTITION))


def _best_fit(points: DataFrame, k: int, restarts: int, seed: int) -> KMeansModel:
    fits = (KMeans(k=k, seed=seed + i, initMode="k-means||").fit(points) for i in range(restarts))
    return min(fits, key=lambda m: m.summary.trainingCost)


def kmeans(df: DataFrame, vector: str, k: int, restarts: int = 20, seed: int = 42) -> KMeansModel:
    """The fit with the lowest cost over ``restarts`` seeds."""
    return _best_fit(_points(df, vector), k, restarts, seed)


def assign(df: DataFrame, model: KMeansModel, vector: str, name: str = "kmeans_cluster") -> DataFrame:
    d = model.transform(df.withColumn("features", vx.as_ml(F.col(vector))))
    return d.withColumnRenamed("prediction", name).drop("features")


def choose_k(df: DataFrame, vector: str, ks=range(3, 13), restarts: int = 20, seed: int = 42) -> DataFrame:
    """(k, inertia, silhouette) for every k. The silhouette is the linear-time squared-distance form."""
    evaluator = ClusteringEvaluator(featuresCol="features", predictionCol="cluster")
    rows = []
    points = _points(df, vector)
    for k in ks:
        model = _best_fit(points, k, restarts, seed)
        d = model.transform(points).withColumnRenamed("prediction", "cluster")
        sizes = d.select("cluster").distinct().count()
        rows.append((k, float(model.summary.trainingCost), float(evaluator.evaluate(d)) if sizes > 1 else None))
    return df.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


def best_k(report: DataFrame) -> DataFrame:
    """The k with the highest silhouette, the smallest such k on ties."""
    return report.orderBy(F.desc("silhouette"), F.asc("k")).limit(1)


def silhouette_sample(df: DataFrame, cluster: str, vector: str, n: int = 2000, key: str = "id", seed: int = 42) -> DataFrame:
    """(key, cluster, silhouette) with Euclidean distances for a seeded sample of at most n rows.

    The sample (n vectors) is the only thing that travels to the tasks.
    """
    s = pick.sample_rows(df.select(key, cluster, vector), n, key, seed)
    local = s.toPandas()  # at most n rows
    ids, labels = local[key].to_numpy(), local[cluster].to_numpy()
    points = np.vstack(local[vector].to_numpy()).astype(np.float64)
    groups = np.unique(labels)

    def run(batches):
        for pdf in batches:
            x = np.vstack(pdf[vector].to_numpy()).astype(np.float64)
            # explicit differences: exact zeros for equal points
            d = np.sqrt(((x[:, None, :] - points[None, :, :]) ** 2).sum(axis=2))
            means = np.full((len(pdf), len(groups)), np.nan)
            own = np.searchsorted(groups, pdf[cluster].to_numpy())
            for j, g in enumerate(groups):
                inside = labels == g
                count = inside.sum() - (own == j)
                with np.errstate(divide="ignore", invalid="ignore"):
                    means[:, j] = d[:, inside].sum(axis=1) / count
            a = means[np.arange(len(pdf)), own]
            means[np.arange(len(pdf)), own] = np.inf
            b = means.min(axis=1) if len(groups) > 1 else np.full(len(pdf), np.nan)
            sil = np.where(np.isfinite(a), (b - a) / np.maximum(a, b), 0.0)
            yield pd.DataFrame({key: pdf[key], cluster: pdf[cluster], "silhouette": np.round(sil, 6)})

    schema = f"{key} {df.schema[key].dataType.simpleString()}, {cluster} {df.schema[cluster].dataType.simpleString()}, silhouette double"
    spread = s.repartition(max(1, min(len(ids) // 256, df.sparkSession.sparkContext.defaultParallelism)) or 1)
    return spread.mapInPandas(run, schema)


#: Rows of a block of ``silhouette``; a task holds two blocks in Python. Blocks of one partition that all others read.
SILHOUETTE_BLOCK, SILHOUETTE_PANEL = 1024, 128


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows to rows: from products, and from explicit differences where these would lose digits."""
    explicit = lambda a, b: np.sqrt(((a - b) ** 2).sum(axis=-1))
    if not (np.isfinite(x).all() and np.isfinite(y).all()):
        return np.vstack([explicit(x[at : at + 16, None, :], y[None, :, :]) for at in range(0, len(x), 16)])
    size = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :]
    square = size - 2 * (x @ y.T)
    i, j = np.nonzero(square <= 1e-6 * size)
    out = np.sqrt(np.maximum(square, 0.0))
    for at in range(0, len(i), 1 << 16):
        k = slice(at, at + (1 << 16))
        out[i[k], j[k]] = explicit(x[i[k]], y[j[k]])
    return out


def _places(labels: pa.Array) -> tuple[list, np.ndarray]:
    """Different values (null is one) and the place of each row's value among them."""
    coded = labels.dictionary_encode(null_encoding="encode")
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)


def silhouette(df: DataFrame, cluster: str, vector: str, key: str = "id") -> DataFrame:
    """(key, cluster, silhouette) with Euclidean distances of every row to all rows, for unique keys.

    Rows are written in blocks once; tasks read the blocks that meet theirs from there, so pairs of blocks are not shuffled. A
    block leaves one partial sum per row and cluster for each partition of blocks that it meets. A row alone in its cluster has 0;
    with one cluster there is no value.
    """
    rows = df.select(F.col(key).alias("_k"), F.col(cluster).alias("_c"), F.col(vector).alias("_v"))
    n = math.ceil(max(1, rows.count()) / SILHOUETTE_BLOCK)
    packed = rows.groupBy(F.pmod(F.xxhash64("_k"), F.lit(n)).alias("_b")).agg(F.collect_list(F.struct("_k", "_c", "_v")).alias("_p"))
    packed = packed.select("_b", F.col("_p._k").alias("_k"), F.col("_p._c").alias("_c"), F.col("_p._v").alias("_v"))
    packed = durable(packed.repartition(min(n, 4 * df.sparkSession.sparkContext.defaultParallelism), "_b"))
    others = packed.select(F.col("_c").alias("_d"), F.col("_v").alias("_w")).coalesce(math.ceil(n / SILHOUETTE_PANEL))
    met = packed.join(others.hint("shuffle_replicate_nl"))

    def matrix(column: pa.ListArray, i: int) -> np.ndarray:
        rows = column.slice(i, 1).flatten()
        return rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), -1)

    def run(batches):
        held = None  # the block at hand, and its sums so far

        def told():
            _, keys, own, _, sums = held
            d, found = list(sums), list(sums.values())
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([keys] * len(d)), pa.concat_arrays([own] * len(d)), pa.array([g for g in d for _ in keys], own.type),
                pa.array(np.concatenate([s for s, _ in found])), pa.array(np.repeat([m for _, m in found], len(keys)).astype(np.int64)),
            ], ["_k", "_c", "_d", "_total", "_n"])

        for batch in batches:
            for i, b in enumerate(batch.column("_b").to_pylist()):
                if held is None or held[0] != b:
                    if held is not None:
                        yield from told()
                    held = b, batch.column("_k").slice(i, 1).flatten(), batch.column("_c").slice(i, 1).flatten(), matrix(batch.column("_v"), i), {}
                groups, place = _places(batch.column("_d").slice(i, 1).flatten())
                totals = _distances(held[3], matrix(batch.column("_w"), i)) @ np.eye(len(groups))[place]
                for j, (g, m) in enumerate(zip(groups, np.bincount(place, minlength=len(groups)))):
                    s, c = held[4].get(g, (0.0, 0))
                    held[4][g] = s + totals[:, j], c + m
        if held is not None:
            yield from told()

    kind, label = (rows.schema[c].dataType.simpleString() for c in ("_k", "_c"))
    sums = met.mapInArrow(run, f"_k {kind}, _c {label}, _d {label}, _total double, _n bigint").groupBy("_k", "_c", "_d").agg(F.sum("_total").alias("_total"), F.sum("_n").alias("_n"))
    same = F.col("_c") == F.col("_d")
    mean = F.try_divide("_total", F.col("_n") - same.cast("int"))
    d = sums.groupBy("_k", "_c").agg(F.max(F.when(same, mean)).alias("_in"), F.min(F.when(~same, mean)).alias("_out"))
    value = F.when(F.col("_out").isNull(), F.lit(None)).otherwise(F.coalesce(F.try_divide(F.col("_out") - F.col("_in"), F.greatest("_in", "_out")), F.lit(0.0)))
    return d.select(F.col("_k").alias(key), F.col("_c").alias(cluster), F.round(value, 6).alias("silhouette"))


# --- density clusters ----------------------------------------------------------------------------

_HALF = 1 << 20  # cell coordinates are stored with 21 bits each, so up to three dimensions


def _cell_number(parts) -> F.Column:
    """One number for a cell; a coordinate outside the range raises, since it would take another cell's number."""
    out = F.lit(0).cast("long")
    far = F.raise_error(F.lit(f"a coordinate is {_HALF} cells or more from the origin; choose a larger eps")).cast("long")
    for p in parts:
        out = out * F.lit(2 * _HALF) + F.when(F.abs(p) < _HALF - 1, p + _HALF).otherwise(far)
    return out


def density_clusters(
    df: DataFrame, coords: list[str], eps: float, min_points: int, min_cluster_size: int = 30, name: str = "hdbscan_cluster",
    max_rounds: int = 60,
) -> DataFrame:
    """Rows with a density cluster number, -1 for noise; at most three coordinates.

    Space is cut into cells of side ``eps``. A cell whose 3^d neighbourhood holds ``min_points`` rows is dense;
    touching dense cells form one cluster, a sparse cell joins the lowest-numbered dense neighbour, and
    clusters below ``min_cluster_size`` rows are noise. All joins run on the cell table, one row per occupied
    cell with its count, so a spot holding a third of the rows is one row and no two data rows ever meet.
    """
    at = [F.floor(F.col(c) / eps).cast("long") for c in coords]
    placed = df.withColumn("_cell", _cell_number(at))
    cells = durable(placed.groupBy("_cell").agg(rows_n().alias("n")))
    steps = [int(sum(d * (2 * _HALF) ** (len(coords) - 1 - i) for i, d in enumerate(o))) for o in product((-1, 0, 1), repeat=len(coords))]
    near = cells.select(F.col("_cell").alias("a"), "n").withColumn("b", F.explode(F.array(*[F.col("a") + F.lit(s) for s in steps])))
    around = near.groupBy(F.col("b").alias("_cell")).agg(F.sum("n").alias("around"))
    dense = durable(cells.join(around, "_cell").filter(F.col("around") >= min_points).select("_cell"))
    reach = near.join(dense.withColumnRenamed("_cell", "b"), "b", "left_semi").select("a", "b")  # cell -> dense neighbour
    edges = durable(reach.join(dense.withColumnRenamed("_cell", "a"), "a", "left_semi"))
    labels = components(dense, edges, max_rounds)
    joined = reach.join(labels.withColumnRenamed("_cell", "b"), "b").groupBy(F.col("a").alias("_cell")).agg(F.min("label").alias("label"))
    own = joined.join(labels.withColumnRenamed("label", "own"), "_cell", "left").select(
        "_cell", F.coalesce("own", "label").alias("label")
    )
    sized = own.join(cells, "_cell").groupBy("label").agg(F.sum("n").alias("size")).filter(F.col("size") >= min_cluster_size)
    numbered = order.dense_ids(sized.select("label"), "label", "_number")
    final = own.join(numbered, "label").select("_cell", "_number")
    return placed.join(final, "_cell", "left").withColumn(name, F.coalesce("_number", F.lit(-1)).cast("int")).drop("_cell", "_number")


def components(nodes: DataFrame, edges: DataFrame, max_rounds: int) -> DataFrame:
    """(_cell, label = lowest cell number reachable). Each round takes the lowest neighbour label and then that
    label's own label; lineage is cut every third round."""
    labels = nodes.select("_cell", F.col("_cell").alias("label"))
    for i in range(max_rounds):
        low = edges.join(labels.withColumnRenamed("_cell", "b"), "b").groupBy(F.col("a").alias("_cell")).agg(F.min("label").alias("low"))
        step = labels.join(low, "_cell", "left").select(
            "_cell", F.col("label").alias("old"), F.least("label", F.coalesce("low", "label")).alias("label")
        )
        jump = step.select(F.col("_cell").alias("label"), F.col("label").alias("far"))
        step = step.join(jump, "label", "left").select("_cell", "old", F.least("label", F.coalesce("far", "label")).alias("label"))
        if i % 3 == 2:
            step = durable(step)
            if step.filter(F.col("old") != F.col("label")).isEmpty():
                return step.select("_cell", "label")
        labels = step.select("_cell", "label")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds; raise max_rounds")
