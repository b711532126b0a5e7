"""Metrics, retrieval, clustering and outliers against brute force on small input."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from echofield import fixed
from echofield.operators import clusters, combine, joins, metrics, outliers, pick, tfidf
from echofield.operators import retrieval as rt
from echofield.operators import rows as rw
from echofield.sources import tables as src


def test_average_precision_and_auc(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.7, 1), (0.1, 0)], "s double, y int")
    r = metrics.ranking_quality(df, "y", "s").first()
    assert abs(r.average_precision - 0.833333) < 1e-6 and r.roc_auc == 0.75


def test_auc_with_ties_matches_pairs(spark):
    rng = np.random.default_rng(3)
    s, y = rng.integers(0, 5, 120) / 5, rng.integers(0, 2, 120)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)], "s double, y int")
    pos, neg = s[y == 1], s[y == 0]
    want = np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg])
    assert abs(metrics.ranking_quality(df, "y", "s").first().roc_auc - want) < 1e-6


def test_fusion(spark):
    ranked = lambda ids: spark.createDataFrame([(1, d, i + 1) for i, d in enumerate(ids)], "query_id int, doc_id string, rank int")
    out = rt.fuse([ranked("ABC"), ranked("CBZ")]).orderBy("rank").collect()
    assert [r.doc_id for r in out] == ["C", "B", "A", "Z"]


def test_question_metrics(spark):
    ranking = spark.createDataFrame([(1, ord(c), i + 1) for i, c in enumerate("abcdefgh")], "query_id int, doc_id int, rank int")
    truth = spark.createDataFrame([(1, ord("b"), "judged"), (1, ord("z"), "judged")], "query_id int, doc_id int, mode string")
    r = rt.evaluate(ranking, truth).first()
    assert (r.hit_1, r.hit_3, r.precision_3, r.recall_8, r.rr) == (0, 1, 0.333, 0.5, 0.5)
    assert rt.metric_block(rt.evaluate(ranking, truth.limit(0)), ["mode"]).count() == 0


def test_passage_relevance_matches_plain_search(spark):
    docs = ["xx the red fox ran off yy", "the red fox", "red", "a The red fox ran off", "the red fox ran offside"]
    asks = ["the red fox ran off", "red", "fox ran", "", "he red fo"]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    q = spark.createDataFrame(list(enumerate(asks)), "query_id long, question string")
    want = {(i, j) for i, a in enumerate(asks) for j, d in enumerate(docs) if a in d}
    assert {(r.query_id, r.doc_id) for r in rt.passage_relevance(df, q).collect()} == want
    hits = rt.keyword_relevance(df, [(0, "FOX|zz"), (1, "side$")])
    assert {(r.query_id, r.doc_id) for r in hits.collect()} == {(0, 0), (0, 1), (0, 3), (0, 4), (1, 4)}


def test_citation_audit(spark):
    a = spark.createDataFrame([(1, "Slow [R0002][R0001]. Again [R0002]."), (2, "Claim [R9999].")], "query_id int, answer string")
    got = spark.createDataFrame([(1, "R0001"), (1, "R0002"), (2, "R0001")], "query_id int, sid string")
    out = {r.query_id: r for r in rt.citation_audit(a, got).collect()}
    assert out[1].cited_ids == ["R0002", "R0001"] and out[1].invalid_citations == []
    assert out[2].invalid_citations == ["R9999"]


def test_filter_builder_and_variant():
    assert rw.metadata_filter() == {} and rw.metadata_filter(platform=[]) == {}
    assert rw.metadata_filter(platform="Nykaa", anomaly_only=True) == {"platform": "Nykaa", "is_anomaly": True}
    with pytest.raises(ValueError):
        rt.search(None, None, None, None, variant="fuzzy")


def test_lexical_scores_match_brute_force(spark):
    docs = ["red fox jumps", "red red dog", "blue cat", "green bird sings red", "", "red ant", "odd fish"]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    q = spark.createDataFrame([(1, "red fox fox")], "query_id long, question string")
    toks = [d.split() for d in docs]
    n, avg = len(docs), sum(map(len, toks)) / len(docs)
    vocab = {w for t in toks for w in t}
    dfreq = {w: sum(w in t for t in toks) for w in vocab}
    idf = {w: math.log(n - c + 0.5) - math.log(c + 0.5) for w, c in dfreq.items()}
    mean = sum(idf.values()) / len(idf)
    idf = {w: v if v >= 0 else 0.25 * mean for w, v in idf.items()}
    want = {}
    for i, t in enumerate(toks):
        s = sum(idf[w] * t.count(w) * 2.5 / (t.count(w) + 1.5 * (0.25 + 0.75 * len(t) / avg)) for w in "red fox fox".split() if w in t)
        if s > 0:
            want[i] = round(s, 6)
    got = {r.doc_id: r.score for r in rt.lexical_topn(q, rt.lexical_index(df)).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 2e-6 for k in want)


def test_dense_topn_exact_in_blocks_with_copies_and_filter(spark):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(300, 8))
    v[100:200] = v[100]  # a third of the corpus is one point
    q = rng.normal(size=(5, 8))
    q[0] = v[100]
    corpus = spark.createDataFrame([(i, [float(x) for x in r], "ab"[i % 2]) for i, r in enumerate(v)], "doc_id long, embedding array<double>, kind string").repartition(6)
    queries = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(q)], "query_id long, embedding array<double>")
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    sims = np.round(unit(q) @ unit(v).T, 6)
    filters = spark.createDataFrame([(2, "kind", "a")], "query_id long, column string, value string")
    got = rt.dense_topn(queries, corpus, 7, filters, block_bytes=128).collect()
    for j in range(5):
        ids = [i for i in range(300) if j != 2 or i % 2 == 0]
        want = sorted(ids, key=lambda i: (-sims[j, i], i))[:7]
        assert [r.doc_id for r in sorted((r for r in got if r.query_id == j), key=lambda r: r.rank)] == want


def test_salted_join_equals_broadcast(spark):
    big = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(300)], "id long, k string")
    small = spark.createDataFrame([("hot", 1), ("hot", 2), ("k3", 3)], "k string, v int")
    a = joins.bounded_join(big, small, ["k"], "id").select("id", "v")
    b = joins.bounded_join(big, small, ["k"], "id", max_rows=1).select("id", "v")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and a.count() == 401


def test_keep_first_with_hot_copy(spark):
    df = spark.createDataFrame([(i, "same" if i % 3 else f"t{i}") for i in range(90)], "id long, content string").repartition(5)
    got = {r.content: r.id for r in combine.keep_first(df, "content").collect()}
    assert len(got) == 31 and got["same"] == 1


def test_silhouette_of_every_row(spark, monkeypatch):
    monkeypatch.setattr(clusters, "SILHOUETTE_BLOCK", 20)
    rng = np.random.default_rng(6)
    x, c = rng.normal(size=(90, 3)), np.append(rng.integers(0, 3, 89), 7)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    want = {}
    for i in range(90):
        inside = (c == c[i]).sum() - 1
        a = d[i, c == c[i]].sum() / inside if inside else None
        b = min(d[i, c == g].mean() for g in set(c) - {c[i]})
        want[i] = 0.0 if a is None else (b - a) / max(a, b)
    df = spark.createDataFrame([(i, int(c[i]), [float(v) for v in x[i]]) for i in range(90)], "id long, g long, e array<double>")
    got = {r.id: r.silhouette for r in clusters.silhouette(df, "g", "e").collect()}
    assert len(got) == 90 and all(abs(got[i] - want[i]) < 2e-6 for i in want)


def test_density_clusters(spark):
    rng = np.random.default_rng(2)
    pts = np.concatenate([rng.normal(0, 0.1, (60, 2)), rng.normal(5, 0.1, (50, 2)), [[20, 20], [-9, 4]], rng.normal(9, 0.02, (10, 2))])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(pts)], "id long, x double, y double")
    out = {r.id: r.hdbscan_cluster for r in clusters.density_clusters(df, ["x", "y"], 0.5, 5, 30).collect()}
    assert len({out[i] for i in range(60)}) == 1 and len({out[i] for i in range(60, 110)}) == 1
    assert out[0] != out[60] and {out[i] for i in range(110, 122)} == {-1}


def test_isolation_forest_repeats_and_finds_outliers(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 3))
    x[:4] += 12
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, e array<double>")
    a = {r.id: r for r in outliers.isolation_flags(df, "e", trees=40, contamination=0.02).collect()}
    b = {r.id: r for r in outliers.isolation_flags(df.repartition(9), "e", trees=40, contamination=0.02).collect()}
    assert {i for i, r in a.items() if r.isolation_anomaly} == {0, 1, 2, 3}
    assert all(abs(a[i].isolation_score - b[i].isolation_score) < 1e-9 for i in a)


def test_isolation_trees_of_one_more_row(spark):
    """One row more at trees x subsample rows changes only the trees that draw it."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(rng.normal(size=(128, 3)))]
    grown = []
    for n in (127, 128):
        nodes = outliers.isolation_trees(spark.createDataFrame(rows[:n], "id long, e array<double>"), "e", 8, 16).toPandas()
        grown.append({k: g.sort_values("node").to_records(index=False).tolist() for k, g in nodes.groupby("tree")})
    assert all(t[0][6] == 16 for g in grown for t in g.values())
    assert len(grown[0]) == 8 and sum(grown[0][k] == grown[1][k] for k in range(8)) >= 4


def test_novelty_gate(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0], i < 5) for i in range(40)], "id long, e array<double>, ref boolean")
    out = outliers.novelty(df, "e", "ref").collect()
    assert {(r.ocsvm_score, r.ocsvm_anomaly) for r in out} == {(0.0, False)}


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(500)
    a = [r.id for r in pick.sample_rows(df.repartition(3), 20).collect()]
    assert a == [r.id for r in pick.sample_rows(df.repartition(11), 20).collect()]


def test_sources(spark, tmp_path):
    p = tmp_path / "r.csv"
    p.write_bytes("﻿review_id,score,content,extra\na,4,\"two\nlines \"\"q\"\"\",x\nb,bad,,y\n".encode())
    got = src.read_csv(spark, str(p), src.REVIEW_SCHEMA).orderBy("review_id").collect()
    assert [(r.review_id, r.score, r.content) for r in got] == [("a", 4.0, 'two\nlines "q"'), ("b", None, None)]
    t = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    out = str(tmp_path / "t")
    assert src.write_if_changed(t, out) and not src.write_if_changed(t.orderBy(F.desc("id")), out)
    assert src.write_if_changed(t.limit(1), out)
    assert src.first_existing(spark, [str(tmp_path / "none"), out]) == out
    with pytest.raises(ValueError):
        src.require_aligned(t, t.limit(1), "id")


def test_encoder_is_unit_length(spark):
    df = spark.createDataFrame([(1, "late refund"), (2, "late refund"), (3, "")], "id long, text string")
    got = {r.id: np.array(r.embedding) for r in tfidf.encode(df, "id", "text", 32).collect()}
    assert abs(np.linalg.norm(got[1]) - 1) < 1e-9 and np.array_equal(got[1], got[2]) and not got[3].any()


def test_fixed_lists():
    assert len(set(fixed.HINGLISH_WORDS)) == len(fixed.HINGLISH_WORDS)
    assert set(fixed.HINGLISH_ENGLISH_OVERLAP) <= set(fixed.HINGLISH_WORDS)
