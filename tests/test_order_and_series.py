"""Order statistics, series and drift against brute force."""

import datetime as dt
import math

import numpy as np
from pyspark.sql import functions as F

from echofield.functions import calendar as cal
from echofield.operators import order, series


def test_quantiles_with_hot_value(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([np.full(700, 3.25), rng.normal(0, 5, 1300)])
    g = rng.integers(0, 3, len(x))
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(g, x)], "g int, x double").repartition(7)
    got = {r.g: (r.a, r.b, r._total) for r in order.quantiles(df, "x", {"a": 0.8, "b": 0.37}, ["g"]).collect()}
    for k in range(3):
        v = x[g == k]
        assert got[k][2] == len(v)
        np.testing.assert_allclose(got[k][:2], np.quantile(v, [0.8, 0.37]), rtol=1e-12)


def test_small_quantiles_and_nearest_rank(spark):
    five = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 10)], "x double")
    assert abs(order.quantiles(five, "x", {"q": 0.8}).first().q - 5.2) < 1e-12
    ten = spark.createDataFrame([(float(v),) for v in range(1, 11)], "x double")
    r = order.nearest_rank(ten, "x", {"p50": 50, "p95": 95}).first()
    assert (r.p50, r.p95) == (5.0, 10.0)
    one = spark.createDataFrame([(7.0,)], "x double")
    assert order.nearest_rank(one, "x", {"p95": 95}).first().p95 == 7.0


def test_dense_ids(spark):
    keys = [5, 900, -3, 77, 12]
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(4)
    got = {r.k: r.row_id for r in order.dense_ids(df, "k").collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}


def _weekly(spark, counts):
    start = dt.date(2024, 1, 1)
    return spark.createDataFrame([("p", start + dt.timedelta(weeks=i), c) for i, c in enumerate(counts)], "p string, week date, complaint_count long")


def test_spike_frames(spark):
    counts = _weekly(spark, [1, 2, 1, 2, 1, 2, 1, 2, 1, 1_000_000])
    last = lambda frame: series.spikes(series.rolling(counts, ["p"], "week", "complaint_count", frame=frame)).orderBy(F.desc("week")).first()
    inside, prior = last("inclusive"), last("prior")
    assert abs(inside.z_score - 1.5) < 1e-6 and not inside.is_spike
    assert prior.z_score > 1e6 and prior.is_spike
    assert series.densify(_weekly(spark, [1]).union(_weekly(spark, [3]).withColumn("week", F.date_add("week", 21))), ["p"], "week").count() == 4


def test_week_labels(spark):
    df = spark.createDataFrame([("2025-10-05 23:59:59",), ("2026-01-01 00:00:00",), (None,)], "t string")
    got = [r[0] for r in df.select(cal.week_label(F.to_timestamp_ntz("t"))).collect()]
    assert got == ["2025-09-29/2025-10-05", "2025-12-29/2026-01-04", None]


def test_divergence(spark):
    rows = [("2024-01-01", "a")] * 5 + [("2024-01-01", "b")] * 5 + [("2024-01-02", "a")] * 10 + [("2024-01-03", "a")] * 2
    df = spark.createDataFrame(rows, "d string, topic string")
    got = series.share_divergence(df, "d", "topic").collect()
    assert len(got) == 1 and got[0].d == "2024-01-02"  # the last day has too few rows
    m = [0.75, 0.25]
    want = 0.5 * (0.5 * math.log(0.5 / m[0]) + 0.5 * math.log(0.5 / m[1])) + 0.5 * math.log(1 / m[0])
    assert abs(got[0].js_divergence - want) < 1e-6
    assert abs(want - 0.215762) < 1e-6


def test_history(spark):
    df = spark.createDataFrame([(1, i, f"q{i}", f"a{i}") for i in range(6)], "c int, t int, q string, a string")
    got = {r.t: r.history for r in series.history_text(df, "c", "t", "q", "a").collect()}
    assert got[0] == "" and got[5] == "Q: q2\nA: a2\nQ: q3\nA: a3\nQ: q4\nA: a4"
