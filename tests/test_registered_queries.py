"""The registry is consistent, and a few whole queries equal their SQL twins at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def test_names():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 184
    sections = {n.split("_")[0] for n in q}
    wanted = {"a": 12, "b": 16, "c": 13, "d": 25, "e": 11, "f": 15, "g": 10, "h": 29, "i": 7, "j": 11, "k": 3, "l": 10, "m": 12, "n": 10}
    for letter, n in wanted.items():
        assert {f"{letter}{i}" for i in range(1, n + 1)} <= sections, letter


@pytest.mark.parametrize("name", ["b15_low_distance_rows", "d11_cluster_stats", "e3_spike_flags", "g2_dedup_cleaned", "m8_average_precision_auc"])
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = entry.queries()[name](spark, SF).toArrow()
    want = con.sql(entry.oracle_sql()[name]).to_arrow_table()
    cols = sorted(got.column_names)
    assert cols == sorted(want.column_names)
    rows = lambda t: sorted(str([r[c] for c in cols]) for r in t.to_pylist())
    assert rows(got) == rows(want) and got.num_rows > 0


def test_choice_of_k_takes_all_restarts(spark, monkeypatch):
    from echofield.operators import clusters

    seen = []
    monkeypatch.setattr(clusters, "_best_fit", lambda points, k, restarts, seed: seen.append((k, restarts)) or 1 / 0)
    with pytest.raises(ZeroDivisionError):
        entry.queries()["j4_choose_k"](spark, SF)
    assert seen == [(3, 20)]


@pytest.mark.parametrize("name", [
    "l2_cross_validation", "l3_severity_candidates", "l3_calibrated_margins", "l4_router_candidates", "l5_churn_candidates", "l7_select_refit_score", "l8_confidence",
    "l9_route_new_texts",
])
def test_training_takes_all_trees_and_steps(spark, monkeypatch, name):
    from echofield.operators import training

    class Asked(Exception):
        pass

    def asked(scale=1.0):
        raise Asked(scale)

    for kind in ("severity", "router", "churn"):
        monkeypatch.setattr(training, f"{kind}_candidates", asked)
    with pytest.raises(Asked) as e:
        entry.queries()[name](spark, SF)
    assert e.value.args == (1.0,)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
