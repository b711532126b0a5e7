"""Findings of round 3: what is shuffled, written and sent, and that bounds do not change an answer."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF
from echofield.operators import clusters, language_profiles, retrieval, training
from echofield.plans import section_n, views


def _plan(df):
    return df._jdf.queryExecution().toString()


def _rows(d):
    return sorted(map(tuple, d.collect()))


@pytest.fixture(scope="module")
def lexical(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(30)]
    texts = [" ".join(rng.choice(words, rng.integers(1, 60))) for _ in range(80)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4).persist()
    queries = spark.createDataFrame([(1, "w1 w2 w2"), (2, "w3"), (3, "w9 w8 w7 w6"), (None, "w1"), (4, "none")], "query_id long, question string")
    return docs, queries


def test_no_postings_in_the_shuffle_of_a_lexical_search(lexical):
    docs, queries = lexical
    plan = _plan(retrieval.lexical_topn(queries, retrieval.lexical_index(docs, stored=True), 5))
    assert "hashpartitioning(query_id" in plan and "block" not in plan


def test_bounds_and_blocks_of_questions_do_not_change_a_lexical_search(lexical):
    docs, queries = lexical
    index = retrieval.lexical_index(docs, stored=True)
    all_scores = retrieval.lexical_scores(queries.filter("query_id is not null"), index).filter("score > 0").collect()
    want = []
    for q in {r.query_id for r in all_scores}:
        ranked = sorted((-r.score, r.doc_id) for r in all_scores if r.query_id == q)[:5]
        want += [(q, d, -s, k + 1) for k, (s, d) in enumerate(ranked)]
    assert _rows(retrieval.lexical_topn(queries, index, 5)) == sorted(want)
    assert _rows(retrieval.lexical_topn(queries, index, 5, pairs_at_once=3)) == sorted(want)
    assert _rows(retrieval.lexical_topn(queries, index, 5, block_bytes=100)) == sorted(want)


def test_rows_of_one_document_are_added_up_in_a_lexical_search(lexical):
    docs, queries = lexical
    more = docs.unionByName(docs.filter("doc_id < 7")).unionByName(docs.filter("doc_id = 9").withColumn("doc_id", F.lit(None).cast("long")))
    index = retrieval.lexical_index(more, stored=True)
    scores = retrieval.lexical_scores(queries.filter("query_id is not null"), index).filter("score > 0")
    assert _rows(retrieval.lexical_topn(queries, index, 200).drop("rank").filter("doc_id is not null")) == _rows(scores.filter("doc_id is not null"))
    assert scores.filter("doc_id is null").count() == retrieval.lexical_topn(queries, index, 200).filter("doc_id is null").count()


def test_answers_and_their_audit_share_one_search(spark, monkeypatch):
    class Tables:
        queries = spark.createDataFrame([(1, "a b")], "query_id long, question string")

    calls = []
    ranked = spark.createDataFrame([(1, 7, 1.0, 1)], "query_id long, doc_id long, score double, rank int")
    monkeypatch.setattr(section_n, "_lexical", lambda t, n: calls.append(n) or ranked)
    got = section_n.c6(Tables())
    assert [(r.query_id, r.sid) for r in got.orderBy("sid").collect()] == [(1, "R0001"), (1, "R990001")] and len(calls) == 1


def test_trigrams_are_not_unfolded_into_rows(spark):
    df = spark.createDataFrame([(1, "il servizio clienti", "it"), (2, "de klantenservice", "nl")], "k int, text string, lang string")
    profiles = language_profiles.fit(df, "text", "lang")
    told = language_profiles.detect(df, "text", "k", profiles)
    assert "Generate" not in _plan(profiles) + _plan(told)
    assert {r.k: r.detected_lang for r in told.collect()} == {1: "it", 2: "nl"}


def test_pairs_of_blocks_are_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(clusters, "SILHOUETTE_BLOCK", 4)
    monkeypatch.setattr(clusters, "SILHOUETTE_PANEL", 2)
    x = np.repeat(np.random.default_rng(5).normal(100.0, 1.0, (10, 3)), 2, axis=0)
    df = spark.createDataFrame([(i, i % 3, [float(v) for v in x[i]]) for i in range(20)], "id long, g long, e array<double>")
    out = clusters.silhouette(df, "g", "e")
    assert "CartesianProduct" in _plan(out) and "hashpartitioning(_b" not in _plan(out)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    assert np.allclose(clusters._distances(x, x), d, rtol=1e-9, atol=0) and (clusters._distances(x, x)[d == 0] == 0).all()
    g = np.arange(20) % 3
    for r in out.collect():
        a = d[r.id, g == g[r.id]].sum() / ((g == g[r.id]).sum() - 1)
        b = min(d[r.id, g == k].mean() for k in set(g) - {g[r.id]})
        assert abs(r.silhouette - (b - a) / max(a, b)) < 2e-6


def test_tasks_of_a_fit_do_not_grow_with_its_rows(spark):
    cores = spark.sparkContext.defaultParallelism
    many = spark.range(1000).repartition(5 * cores)
    assert training.packed(many, 10).rdd.getNumPartitions() == 1
    assert training.packed(many, 100 * cores * training.ROWS_PER_PARTITION // 10).rdd.getNumPartitions() == cores


def test_texts_are_read_before_the_join_of_a_view(spark):
    rows = views.Tables(spark, SF).scored.select("id", "severity_label_weak", "review_length")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.index("Join") < plan.index("RLIKE") and plan.index("Join") < plan.index("split(")
