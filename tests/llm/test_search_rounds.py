"""Blocks of queries are searched one after the other: what is on its way to the shards does not grow with the number of blocks."""

import pytest

from echofield.llm import topk


@pytest.mark.parametrize("long_query", [64, 1])
def test_blocks_take_rounds_and_the_same_answers(spark, monkeypatch, long_query):
    words = [f"w{i}" for i in range(40)]
    text = lambda i: " ".join(words[(i * k * k + k) % 40] for k in range(3 + i % 9))
    docs = spark.createDataFrame([(i if i else None, text(i)) for i in range(160)] + [(7, text(7)), (8, None)], "doc_id long, text string").repartition(20)
    asked = spark.createDataFrame([(i, text(3 * i)) for i in range(30)] + [(None, text(1)), (5, "w1 w2"), (31, "")], "query_id long, text string")
    index = topk.staged(topk.build_index(docs), "search-index")
    told = lambda: sorted((r.query_id if r.query_id is not None else -1, r["rank"], r.id if r.id is not None else -1, r.score) for r in topk.search(index, asked, 5, long_query=long_query).collect())
    once, staged, seen = told(), topk.staged, []
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    monkeypatch.setattr(topk, "staged", lambda d, name: seen.append(name) or staged(d, name))
    assert told() == once and len(once) > 100
    blocks, shards = 9, index.filter("kind = 1").count()
    at_once = topk._blocks_at_once(shards, spark.sparkContext.defaultParallelism)
    assert at_once == 1 and seen.count("search-best") == blocks
