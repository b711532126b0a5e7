"""Filters on both sides of a search, bounded dense search, and rules for gaps, far cells and nulls."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from echofield.operators import clusters, combine, order, retrieval, series, tfidf
from echofield.sources import tables


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(4)
    rows = [(i, f"word{i % 5} common text {i}", "ab"[i % 2], "xyz"[i % 3], [float(v) for v in rng.normal(size=8)]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, platform string, kind string, embedding array<double>").repartition(5).persist()
    queries = spark.createDataFrame([(1, "word1 common"), (2, "word2 text"), (3, "common")], "query_id long, question string")
    vectors = spark.createDataFrame([(q, [float(v) for v in rng.normal(size=8)]) for q in (1, 2, 3)], "query_id long, embedding array<double>")
    return docs, queries, vectors


@pytest.mark.parametrize("variant", ["dense", "hybrid", "rerank"])
def test_filters_hold_on_both_sides(spark, corpus, variant):
    docs, queries, vectors = corpus
    filters = spark.createDataFrame([(1, "platform", "a"), (2, "platform", "b"), (2, "kind", "x"), (2, "kind", "y")], "query_id long, column string, value string")
    facts = docs.select("doc_id", "platform", "kind")
    hits = retrieval.search(queries, docs.select("doc_id", "text"), vectors, docs.select("doc_id", "embedding"), 8, variant, filters=filters, facts=facts)
    got = hits.join(facts, "doc_id").collect()
    assert all(r.platform == "a" for r in got if r.query_id == 1)
    assert all(r.platform == "b" and r.kind in "xy" for r in got if r.query_id == 2)
    assert {r.platform for r in got if r.query_id == 3} == {"a", "b"} and len(got) == 24


def test_dense_bounds_do_not_change_the_answer(corpus):
    docs, _, vectors = corpus
    rows = lambda d: sorted(map(tuple, d.collect()))
    c = docs.select("doc_id", "embedding")
    want = rows(retrieval.dense_topn(vectors, c, 5))
    assert rows(retrieval.dense_topn(vectors, c, 5, pairs_at_once=4)) == want
    assert rows(retrieval.dense_topn(vectors, c, 5, block_bytes=64)) == want
    x = np.array([r.embedding for r in c.orderBy("doc_id").collect()])
    q = np.array([r.embedding for r in vectors.orderBy("query_id").collect()])
    cos = np.round((x / np.linalg.norm(x, axis=1, keepdims=True)) @ (q / np.linalg.norm(q, axis=1, keepdims=True)).T, 6)
    best = {(k + 1, int(d)) for k in range(3) for d in np.lexsort((np.arange(60), -cos[:, k]))[:5]}
    assert {(r[0], r[1]) for r in want} == best


def test_stored_index(spark, corpus):
    docs, queries, _ = corpus
    index = retrieval.lexical_index(docs.select("doc_id", "text"))
    again = index.write(tables.shared_folder(spark, "test-index"))
    rows = lambda i: sorted(map(tuple, retrieval.lexical_topn(queries, i, 10).collect()))
    assert rows(again) == rows(index) == rows(retrieval.lexical_index(docs.select("doc_id", "text"), stored=True))


def test_history_over_gaps(spark):
    turns = spark.createDataFrame([("c", n, f"q{n}", f"a{n}") for n in (1, 5, 9, 20, 21)], "conv string, turn int, q string, a string")
    got = {r.turn: r.history for r in series.history_text(turns, "conv", "turn", "q", "a").collect()}
    assert got[1] == "" and got[9] == "Q: q1\nA: a1\nQ: q5\nA: a5" and got[21].count("Q: ") == 3 and "q1\n" not in got[21]


def test_far_cells_do_not_alias(spark):
    df = spark.createDataFrame([(i, 0.5, 1.5) for i in range(40)] + [(40 + i, 0.5, 2.0**21 + 0.5) for i in range(40)], "id int, x double, y double")
    with pytest.raises(Exception, match="larger eps"):
        clusters.density_clusters(df, ["x", "y"], 1.0, 5).collect()


def test_null_text_is_not_empty(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, None), (4, "")], "id int, text string")
    assert sorted(r.id for r in combine.keep_first(df, "text").collect()) == [1, 2]


def test_fingerprint_tells_columns_apart(spark):
    mark = lambda rows, names: tuple(tables.fingerprint(spark.createDataFrame(rows, names)).first())
    assert mark([("a|", "b")], ["x", "y"]) != mark([("a", "|b")], ["x", "y"]) != mark([("a", "|b")], ["x", "z"])


def test_running_totals_in_skewed_groups(spark):
    rng = np.random.default_rng(2)
    data = [("hot", float(v)) for v in rng.normal(100, 0.001, 3000)] + [("cold", float(v)) for v in rng.normal(0, 1000, 50)]
    df = spark.createDataFrame(data, "g string, x double").repartition(6)
    got = {(r.g, r.x): r.run_n for r in order.running_totals(df, "x", {"n": F.count(F.lit(1))}, ["g"]).collect()}
    for g in ("hot", "cold"):
        xs = sorted(x for h, x in data if h == g)
        assert all(got[(g, x)] == i + 1 for i, x in enumerate(xs))


@pytest.mark.parametrize("n", [3, 40])
def test_skipped_blocks_do_not_change_the_answer(spark, n, monkeypatch):
    """Long documents, one text that a third of all rows repeat, empty and null texts, ties, a question without a known word."""
    monkeypatch.setattr(retrieval, "BLOCK_DOCS", 8)
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(60)]
    share = 1 / np.arange(1, 61)
    texts = [" ".join(rng.choice(words, rng.integers(1, 400), p=share / share.sum())) for _ in range(200)]
    texts += ["w3 w30 w41"] * 100 + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    questions = [(1, "w41 w30 w30"), (2, "w1"), (3, "w55 w2 w59"), (4, "nothing"), (5, None)]
    queries = spark.createDataFrame(questions, "query_id long, question string")
    index = retrieval.lexical_index(docs, stored=True, block_docs=8)
    everything = {}
    for r in retrieval.lexical_scores(queries, index).collect():
        if r.score > 0:
            everything.setdefault(r.query_id, []).append((-r.score, r.doc_id))
    want = {(q, d, -s, k + 1) for q, found in everything.items() for k, (s, d) in enumerate(sorted(found)[:n])}
    got = {(r.query_id, r.doc_id, r.score, r["rank"]) for r in retrieval.lexical_topn(queries, index, n).collect()}
    assert got == want and {q for q, *_ in got} == {1, 2, 3}

    wanted, _ = retrieval._weighted_terms(queries, index)
    limits = retrieval.block_limits(wanted, index).persist()
    top = spark.createDataFrame(sorted(got), "query_id long, doc_id long, score double, rank int")
    left = retrieval.blocks_left(limits, limits.limit(0), top, n)
    assert left.count() < limits.count() or n == 40
    placed = index.blocks.select("block", F.explode("docs.doc_id").alias("doc_id")).distinct()
    best = top.join(placed, "doc_id").select("query_id", "block").distinct()
    assert best.join(left, ["query_id", "block"], "left_anti").count() == 0


def test_postings_of_an_empty_corpus(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    queries = spark.createDataFrame([(1, "w1")], "query_id long, question string")
    assert retrieval.lexical_topn(queries, retrieval.lexical_index(docs)).count() == 0


def test_weights_inside_the_row(spark):
    rows = [(1, "late refund late"), (2, "refund now"), (3, "zz"), (4, ""), (5, None), (6, "late refund late")]
    df = spark.createDataFrame(rows, "id long, text string")
    vocab = tfidf.vocabulary(tfidf.term_counts(df, "id", "text"), df, min_df=2, max_df=1.0).persist()
    wide = tfidf.weights_in_row(df, vocab, "id", "text")
    assert {r.id: len(r["items"]) for r in wide.collect()} == {1: 4, 2: 1, 3: 0, 4: 0, 5: 0, 6: 4}
    want = tfidf.weights(tfidf.term_counts(df, "id", "text"), vocab, "id")
    flat = lambda d: sorted((r.id, r.term, r.term_index, round(r.weight, 12)) for r in d.collect())
    assert flat(tfidf.fit_weights(df, "id", "text", min_df=2, max_df=1.0)[0]) == flat(want)
    none = tfidf.weights_in_row(df, vocab.limit(0), "id", "text").collect()
    assert len(none) == 6 and not any(r["items"] for r in none)
