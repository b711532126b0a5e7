"""Density clusters by mutual reachability against brute force."""

import numpy as np
import pytest

from echofield.operators import density


def brute(x, eps, min_points, min_size):
    """Core flags and, for each row, the rows of its cluster."""
    d2 = np.zeros((len(x), len(x)))
    for i in range(x.shape[1]):
        d2 = d2 + (x[:, None, i] - x[None, :, i]) ** 2
    near = d2 <= eps * eps
    core = near.sum(1) >= min_points
    label = np.where(core, np.arange(len(x)), -1)
    while True:
        low = np.where(core, np.where(near & core[None, :], label[None, :], len(x)).min(1), -1)
        if (low == label).all():
            break
        label = low
    sizes = np.bincount(label[core], minlength=len(x))
    return core, np.where(core & (sizes[label] >= min_size), label, -1)


def compare(spark, x, eps, min_points, min_size, parts=3):
    names = [f"c{i}" for i in range(x.shape[1])]
    rows = [(i, *map(float, r)) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"{c} double" for c in names)).repartition(parts)
    got = density.reachability_clusters(df, names, eps, min_points, min_size).orderBy("id").collect()
    core, label = brute(x, eps, min_points, min_size)
    assert [r.is_core for r in got] == core.tolist()
    number = [r.hdbscan_cluster for r in got]
    seen = dict(zip(label.tolist(), number))
    assert number == [seen[v] for v in label.tolist()]
    assert len(set(number)) == len(set(label.tolist())) and seen.get(-1, -1) == -1
    return number


@pytest.mark.parametrize("d, eps", [(2, 0.35), (3, 0.6), (10, 2.6)])
def test_equals_brute_force_with_a_spot_of_a_third(spark, monkeypatch, d, eps):
    monkeypatch.setattr(density, "CELL_BLOCK", 16)
    monkeypatch.setattr(density, "POINT_BLOCK", 32)
    monkeypatch.setattr(density, "FACING_BLOCK", 8)
    rng = np.random.default_rng(d)
    spot = np.vstack([np.full((60, d), 0.3), 0.3 + 0.2 * eps / np.sqrt(d) * rng.normal(size=(60, d))])
    blobs = np.vstack([c + 0.9 * rng.normal(size=(60, d)) for c in rng.uniform(-5, 5, size=(3, d))])
    x = np.vstack([spot, blobs, rng.uniform(-8, 8, size=(60, d))])
    number = compare(spark, x, eps, 6, 10)
    assert max(number) >= 0 and -1 in number


def test_chains_of_single_points_and_dense_cells_that_only_their_points_link(spark):
    line = np.array([[0.5 * i, 0.0] for i in range(40)])
    left = np.array([[100 + 0.001 * i, 0.001 * (i % 7)] for i in range(20)])
    beside = np.array([[101.0 + 0.001 * i, 0.001 * (i % 5)] for i in range(20)])
    apart = np.array([[102.03 + 0.001 * i, 0.0] for i in range(20)])
    number = compare(spark, np.vstack([line, left, beside, apart]), 1.0, 3, 5)
    assert number[40] == number[60] != number[80]


def test_distance_of_exactly_eps_and_negative_zero(spark):
    compare(spark, np.array([[0.0, 0.0], [-0.0, 0.0], [0.5, 0.0], [1.0, 0.0], [-0.5, 0.0], [2.0, 0.0], [2.0, 0.0]]), 0.5, 2, 2)


def test_nulls_not_finite_repeats_clashing_names_and_empty(spark):
    schema = "_cell string, n double, w double, _own0 int"
    rows = [("a", 0.0, 0.0, 1)] * 3 + [("b", None, 0.0, 2), (None, float("nan"), 0.0, 3), ("d", float("inf"), 0.0, None)]
    got = density.reachability_clusters(spark.createDataFrame(rows, schema), ["n", "w"], 1.0, 3, 3).collect()
    assert sorted(((r._own0 or 0), r.is_core, r.hdbscan_cluster) for r in got) == [(0, False, -1), (1, True, 0), (1, True, 0), (1, True, 0), (2, False, -1), (3, False, -1)]
    assert got[0].__fields__ == ["_cell", "n", "w", "_own0", "is_core", "hdbscan_cluster"]
    assert density.reachability_clusters(spark.createDataFrame([], schema), ["n", "w"], 1.0).collect() == []
    with pytest.raises(ValueError):
        density.reachability_clusters(spark.createDataFrame(rows, schema), [], 1.0)


def test_no_row_is_written_for_a_pair_of_points(spark, monkeypatch):
    written, real = [], density.durable

    def durable(df):
        out = real(df)
        written.append(out.count())
        return out

    monkeypatch.setattr(density, "durable", durable)
    x = np.random.default_rng(5).normal(size=(400, 10))
    compare(spark, x, 2.5, 6, 10)
    assert max(written) <= len(x)
