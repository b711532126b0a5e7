"""Density clusters by mutual reachability, exact in any number of dimensions.

A row is core if at least ``min_points`` rows, itself included, lie within ``eps``. The mutual reachability of two rows is the
largest of their distance and their two core distances, so it is at most ``eps`` for two core rows within ``eps`` of each other
and for no others. Clusters are the components of core rows cut at ``eps``; all other rows are noise.

Nothing is written for a pair of rows, nor for a pair of cells:

* Equal points are one point with a weight. Space is cut into cells whose diagonal is below ``eps``: rows of one cell are
  neighbours without a comparison, and a cell of ``min_points`` rows is core as a whole.
* Points are dealt into blocks that are near each other along a Z-order curve, and blocks are written once. Tasks read the blocks that
  meet theirs from there. Two blocks meet if their boxes are within ``eps``; if the boxes lie within ``eps`` as a whole, they meet without comparisons.
* A block leaves one count for each of its points that no dense cell decides, in one row for each partition of blocks that it meets.
* Core points of a block that are linked inside it are one node. Two blocks leave at most a link for each of their nodes, and are
  compared only if the links of whole boxes have not connected them already.

In few coordinates most blocks are far apart or whole. In many coordinates all blocks meet: comparisons grow with the square of the
points, what is written and held does not. Bounds on boxes are monotone in floating point in the order of the distance itself, so they
never contradict it; distances come from products, and those next to ``eps`` from explicit differences in that order.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echofield.operators import order
from echofield.operators.clusters import components
from echofield.session import durable

#: Blocks of one partition that all others read, points of one block, and points of a block that are compared at once.
CELL_BLOCK, POINT_BLOCK, FACING_BLOCK = 128, 4096, 256
#: Share of the size of two points that the product form of their distance may be off by, far above its rounding.
DOUBT = 1e-9
_FAR = float(1 << 52)


def _total(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts)


def _square(c: Column) -> Column:
    return c * c


class _Space:
    """Expressions over ``d`` coordinates: points ``{p}x0..`` and boxes ``{p}lo0..``, ``{p}hi0..``."""

    def __init__(self, d: int):
        self.d = d

    def x(self, p: str = "") -> list[str]:
        return [f"{p}x{i}" for i in range(self.d)]

    def box(self, p: str = "") -> list[str]:
        return [f"{p}{e}{i}" for e in ("lo", "hi") for i in range(self.d)]

    def extent(self) -> list[Column]:
        return [f(f"x{i}").alias(f"{e}{i}") for e, f in (("lo", F.min), ("hi", F.max)) for i in range(self.d)]

    def _bounds(self, alo: str, ahi: str, b: str) -> tuple[Column, Column]:
        near, far = [], []
        for i in range(self.d):
            below, above = F.col(f"{b}lo{i}") - F.col(f"{ahi}{i}"), F.col(f"{alo}{i}") - F.col(f"{b}hi{i}")
            near.append(_square(F.greatest(below, above, F.lit(0.0))))
            far.append(_square(F.greatest(F.col(f"{b}hi{i}") - F.col(f"{alo}{i}"), F.col(f"{ahi}{i}") - F.col(f"{b}lo{i}"))))
        return _total(near), _total(far)

    def box_box(self, a: str, b: str) -> tuple[Column, Column]:
        return self._bounds(f"{a}lo", f"{a}hi", b)


def _prefixed(df: DataFrame, p: str) -> DataFrame:
    return df.toDF(*[f"{p}{c}" for c in df.columns])


def _both_ways(pairs: DataFrame) -> DataFrame:
    return pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _rows(column: pa.ListArray, i: int) -> np.ndarray:
    return column.slice(i, 1).flatten().to_numpy(zero_copy_only=False)


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts), kind))


def _within(x: np.ndarray, y: np.ndarray, limit: float) -> np.ndarray:
    """Which rows of ``x`` and ``y`` have a squared distance of at most ``limit``."""
    size = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :]
    square = size - 2 * (x @ y.T)
    near = square <= limit
    i, j = np.nonzero(~(np.abs(square - limit) > DOUBT * (size + limit)))
    for at in range(0, len(i), 1 << 16):
        k = slice(at, at + (1 << 16))
        total = np.zeros(len(i[k]))
        for c in range(x.shape[1]):
            total += (x[i[k], c] - y[j[k], c]) ** 2
        near[i[k], j[k]] = total <= limit
    return near


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the sets of ``i`` and ``j``; ``label`` is the smallest member of each one's set."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label[:] = label[label]


def _link(label: np.ndarray, x: np.ndarray, y: np.ndarray, own: np.ndarray, other: np.ndarray, limit: float) -> None:
    """Joins the sets ``own`` and ``other`` of rows of ``x`` and ``y`` within ``limit``, until all are one."""
    for at in range(0, len(x), FACING_BLOCK):
        if not label.any():
            return
        i, j = np.nonzero(_within(x[at : at + FACING_BLOCK], y, limit))
        _merge(label, own[i + at], other[j])


def _z_order(sp: _Space, low: list[float], high: list[float]):
    """Adds ``_z``, the interleaved bits of the coordinates on a grid over all points."""
    low, span = np.array(low), np.array(high) - np.array(low)
    span[span == 0] = 1.0

    def run(batches):
        for batch in batches:
            x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in sp.x()])
            grid = np.clip((x - low) / span * 65535, 0, 65535).astype(">u2")
            bits = np.unpackbits(np.ascontiguousarray(grid).view(np.uint8).reshape(len(x), sp.d, 2), axis=2)
            z = np.packbits(bits.transpose(0, 2, 1).reshape(len(x), -1), axis=1)
            column = pa.Array.from_buffers(pa.binary(z.shape[1]), len(z), [None, pa.py_buffer(z.tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, "_z"])

    return run


def _dealt(sp: _Space, size: int):
    """Blocks of ``size`` points of a sorted partition."""

    def told(held: list[pa.RecordBatch], number: int):
        t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        x = np.column_stack([t.column(c).to_numpy(zero_copy_only=False) for c in sp.x()])
        w, dense = (t.column(c).to_numpy(zero_copy_only=False) for c in ("w", "_dense"))
        columns = [
            pa.array([TaskContext.get().partitionId() << 32 | number]), _lists([x.ravel()], pa.float64()), _lists([w], pa.int64()), pa.array([int(w.sum())]),
            pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), t.column("_cell")), _lists([~dense], pa.bool_()), pa.array([int((~dense).sum())]),
        ]
        boxes = [pa.array([float(v)]) for v in (*x.min(axis=0), *x.max(axis=0))]
        return pa.RecordBatch.from_arrays([*columns, *boxes], ["_b", "_x", "_w", "_m", "_c", "_open", "_k", *sp.box()])

    def run(batches):
        held, n, number = [], 0, 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, size - n)
                held.append(part)
                at, n = at + part.num_rows, n + part.num_rows
                if n == size:
                    yield told(held, number)
                    held, n, number = [], 0, number + 1
        if n:
            yield told(held, number)

    return run


def _blocks(points: DataFrame, sp: _Space) -> DataFrame:
    """Blocks of points (coordinates, ``w``, ``_cell``, ``_dense``): their points, weight, cells, which a dense cell does not decide, how many these are, and the box."""
    spark, xs = points.sparkSession, sp.x()
    seen = points.agg(F.count(F.lit(1)).alias("n"), *sp.extent()).first()
    low, high = ([seen[f"{e}{i}"] or 0.0 for i in range(sp.d)] for e in ("lo", "hi"))
    parts = min(math.ceil(max(1, seen["n"]) / POINT_BLOCK), 4 * spark.sparkContext.defaultParallelism)
    kinds = ", ".join(f"{x} double" for x in xs)
    placed = points.select(*xs, "w", "_cell", "_dense").mapInArrow(_z_order(sp, low, high), f"{kinds}, w bigint, _cell string, _dense boolean, _z binary")
    placed = placed.repartitionByRange(parts, "_z", *xs).sortWithinPartitions("_z", *xs)
    boxes = ", ".join(f"{c} double" for c in sp.box())
    schema = f"_b bigint, _x array<double>, _w array<bigint>, _m bigint, _c array<string>, _open array<boolean>, _k bigint, {boxes}"
    return durable(placed.mapInArrow(_dealt(sp, POINT_BLOCK), schema))


def _met(left: DataFrame, right: DataFrame, count: int, condition: Column) -> DataFrame:
    """Pairs of blocks; every partition on the left reads those on the right from the written table."""
    return left.join(right.coalesce(math.ceil(max(1, count) / CELL_BLOCK)).hint("shuffle_replicate_nl"), condition)


def _core_blocks(blocks: DataFrame, sp: _Space, limit: float, min_points: int) -> DataFrame:
    """The blocks' core points: ``_x``, ``_w``, ``_node`` (of points that are linked inside the block, the smallest cell), ``_nodes`` (each once), and the box."""
    d, count = sp.d, blocks.count()
    asking = _prefixed(blocks.filter("_k > 0").select("_b", "_x", "_open", *sp.box()), "a_")
    asked = _prefixed(blocks.select("_x", "_w", "_m", *sp.box()), "b_")
    near, far = sp.box_box("a_", "b_")
    met = _met(asking, asked, count, near <= limit).select("a__b", "a__x", "a__open", "b__x", "b__w", "b__m", (far <= limit).alias("_whole"))

    def counted(batches):
        held = None  # the block at hand, its undecided points, and the rows found near them
        told = lambda: pa.RecordBatch.from_arrays([pa.array([held[0]], pa.int64()), _lists([held[2]], pa.int64())], ["_b", "_n"])
        for batch in batches:
            for i, (b, whole, m) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("a__b", "_whole", "b__m")))):
                if held is None or held[0] != b:
                    if held is not None:
                        yield told()
                    x = _rows(batch.column("a__x"), i).reshape(-1, d)[_rows(batch.column("a__open"), i).astype(bool)]
                    held = b, x, np.zeros(len(x), np.int64)
                if whole:
                    held[2][:] += m
                    continue
                y, w = _rows(batch.column("b__x"), i).reshape(-1, d), _rows(batch.column("b__w"), i).astype(np.float64)
                for at in range(0, len(held[1]), FACING_BLOCK):
                    k = slice(at, at + FACING_BLOCK)
                    held[2][k] += (_within(held[1][k], y, limit) @ w).astype(np.int64)
        if held is not None:
            yield told()

    counts = met.mapInArrow(counted, "_b bigint, _n array<bigint>").groupBy("_b").agg(F.collect_list("_n").alias("_n"))
    told = blocks.select("_b", "_x", "_w", "_c", "_open").join(counts, "_b", "left")

    def chosen(batches):
        for batch in batches:
            for i, b in enumerate(batch.column("_b").to_pylist()):
                x, w, is_open = _rows(batch.column("_x"), i).reshape(-1, d), _rows(batch.column("_w"), i), _rows(batch.column("_open"), i).astype(bool)
                core, found = ~is_open, batch.column("_n").slice(i, 1).flatten()
                if len(found):
                    core[is_open] = sum(_rows(found, k) for k in range(len(found))) >= min_points
                if not core.any():
                    continue
                x, w = x[core], w[core]
                cells = batch.column("_c").slice(i, 1).flatten().filter(pa.array(core))
                coded = cells.dictionary_encode()
                names, own = coded.dictionary.to_pylist(), coded.indices.to_numpy()
                label = np.arange(len(names))
                low, high = x.min(axis=0), x.max(axis=0)
                if sum((h - v) ** 2 for v, h in zip(low.tolist(), high.tolist())) <= limit:
                    label[:] = 0
                _link(label, x, x, own, own, limit)
                least: dict[int, str] = {}
                for at, name in zip(label.tolist(), names):
                    least[at] = min(name, least.get(at, name))
                nodes = sorted(least.values())
                columns = [pa.array([b]), _lists([x.ravel()], pa.float64()), _lists([w], pa.int64()), pa.array([[least[at] for at in label[own].tolist()]]), pa.array([nodes])]
                boxes = [pa.array([float(v)]) for v in (*low, *high)]
                yield pa.RecordBatch.from_arrays([*columns, *boxes], ["_b", "_x", "_w", "_node", "_nodes", *sp.box()])

    boxes = ", ".join(f"{c} double" for c in sp.box())
    return durable(told.mapInArrow(chosen, f"_b bigint, _x array<double>, _w array<bigint>, _node array<string>, _nodes array<string>, {boxes}"))


def _links(cores: DataFrame, sp: _Space, limit: float, max_rounds: int) -> DataFrame:
    """(``_cell``, ``label``, ``size``) of the nodes: the smallest node of their component, and their core rows."""
    d, count = sp.d, cores.count()
    sizes = cores.select(F.explode(F.arrays_zip("_node", "_w")).alias("_p")).groupBy(F.col("_p._node").alias("_cell")).agg(F.sum("_p._w").alias("size"))
    sizes = durable(sizes)
    nodes = sizes.select("_cell")
    near, far = sp.box_box("a_", "b_")
    box = cores.select("_b", "_nodes", *sp.box())
    whole = _met(_prefixed(box, "a_"), _prefixed(box, "b_"), count, (F.col("a__b") < F.col("b__b")) & (far <= limit))
    edges = whole.select(F.col("a__nodes")[0].alias("a"), F.explode(F.array_union("a__nodes", "b__nodes")).alias("b")).filter("a <> b").distinct()
    edges = durable(edges)
    labels = nodes.withColumn("label", F.col("_cell")) if edges.isEmpty() else durable(components(nodes, _both_ways(edges), max_rounds))
    # points against points, where it still matters
    inside = cores.select("_b", F.explode("_nodes").alias("_cell")).join(labels, "_cell").groupBy("_b").agg(F.min("label").alias("_one"), F.max("label").alias("_last"))
    known = durable(cores.select("_b", "_x", "_node", *sp.box()).join(inside, "_b"))
    apart = (F.col("a__one") != F.col("b__one")) | (F.col("a__one") != F.col("a__last")) | (F.col("b__one") != F.col("b__last"))
    met = _met(_prefixed(known, "a_"), _prefixed(known, "b_"), count, (F.col("a__b") < F.col("b__b")) & (near <= limit) & (far > limit) & apart)

    def linked(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                x, y = (_rows(batch.column(c), i).reshape(-1, d) for c in ("a__x", "b__x"))
                named = pa.concat_arrays([batch.column(c).slice(i, 1).flatten() for c in ("a__node", "b__node")]).dictionary_encode()
                names, at = named.dictionary.to_pylist(), named.indices.to_numpy()
                label = np.arange(len(names))
                _link(label, x, y, at[: len(x)], at[len(x) :], limit)
                k = np.flatnonzero(label != np.arange(len(names))).tolist()
                yield pa.RecordBatch.from_arrays([pa.array([names[v] for v in label[k].tolist()], pa.string()), pa.array([names[v] for v in k], pa.string())], ["a", "b"])

    close = durable(met.select("a__x", "a__node", "b__x", "b__node").mapInArrow(linked, "a string, b string").distinct())
    if not close.isEmpty():
        labels = durable(components(nodes, _both_ways(edges.unionByName(close)), max_rounds))
    return labels.join(sizes, "_cell")


def _points(cores: DataFrame, sp: _Space) -> DataFrame:
    """Coordinates and node (``_node``) of every core point."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                x = _rows(batch.column("_x"), i).reshape(-1, sp.d)
                yield pa.RecordBatch.from_arrays([*[pa.array(x[:, c].copy()) for c in range(sp.d)], batch.column("_node").slice(i, 1).flatten()], [*sp.x(), "_node"])

    return cores.select("_x", "_node").mapInArrow(run, ", ".join(f"{x} double" for x in sp.x()) + ", _node string")


def reachability_clusters(
    df: DataFrame, coords: list[str], eps: float, min_points: int = 30, min_cluster_size: int = 30, name: str = "hdbscan_cluster", max_rounds: int = 60,
) -> DataFrame:
    """The rows with ``is_core`` and the number of their cluster, -1 for noise.

    Clusters are components of core rows whose mutual reachability is at most ``eps``; those below ``min_cluster_size`` rows
    are noise with ``is_core`` kept. Rows with a null, NaN or infinite coordinate are noise and nobody's neighbour. Repeated rows count
    as often as they come. Columns of ``df`` may have any names but ``is_core`` and ``name``; an empty table gives no rows.
    """
    if not coords or eps <= 0 or min_points < 1:
        raise ValueError("coordinates, a positive eps and at least one point are needed")
    sp = _Space(len(coords))
    xs, limit = sp.x(), eps * eps
    side = eps / math.sqrt(sp.d) * (1 - 1e-9)
    own = {c: f"_own{i}" for i, c in enumerate(df.columns)}
    rows = df.toDF(*own.values()).select("*", *[F.col(own[c]).cast("double").alias(x) for c, x in zip(coords, xs)])
    finite = reduce(lambda a, b: a & b, [F.col(x).isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")) for x in xs])
    far = F.raise_error(F.lit("a coordinate is too far from the origin for this eps")).cast("bigint")
    at = [F.when(F.abs(F.col(x) / side) < _FAR, F.floor(F.col(x) / side)).otherwise(far).cast("string") for x in xs]
    # 0.0 takes the sign from -0.0, so that equal points are equal keys
    rows = rows.select(*own.values(), *[(F.col(x) + F.lit(0.0)).alias(x) for x in xs], F.when(finite, F.concat_ws(",", *at)).alias("_cell"))
    points = rows.filter(F.col("_cell").isNotNull()).groupBy("_cell", *xs).agg(F.count(F.lit(1)).alias("w"))
    points = durable(points)
    dense = points.groupBy("_cell").agg(F.sum("w").alias("n")).filter(F.col("n") >= min_points).select("_cell", F.lit(True).alias("_dense"))
    located = points.join(dense, "_cell", "left").withColumn("_dense", F.coalesce("_dense", F.lit(False)))
    cores = _core_blocks(_blocks(located, sp), sp, limit, min_points)
    linked = durable(_links(cores, sp, limit, max_rounds))
    sizes = linked.groupBy("label").agg(F.sum("size").alias("_size")).filter(F.col("_size") >= min_cluster_size)
    numbers = order.dense_ids(sizes.select("label"), "label", "_number")
    numbered = linked.join(numbers, "label", "left").select("_cell", "_number")

    flags = _points(cores, sp).join(numbered.withColumnRenamed("_cell", "_node"), "_node")
    told = rows.drop("_cell").join(flags, xs, "left")
    is_core = F.col("_node").isNotNull()
    return told.select(
        *[F.col(new).alias(old) for old, new in own.items()], is_core.alias("is_core"), F.when(is_core, F.coalesce("_number", F.lit(-1))).otherwise(-1).cast("int").alias(name)
    )
