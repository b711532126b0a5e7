"""The registered queries against their SQL twins or plain Python at the smallest scale, and the pipeline's stages."""

import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
import llm_data as data
from echofield.llm import queries
from echofield.llm.common import staged

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got, want = entry.queries()[name](spark, SF).toArrow(), con.sql(queries.ORACLES[name]).to_arrow_table()
    cols = sorted(got.column_names)
    assert cols == sorted(want.column_names)
    rows = lambda t: sorted(str([r[c] for c in cols]) for r in t.to_pylist())
    assert rows(got) == rows(want) and got.num_rows > 0


def test_documents_as_search_queries(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.sql(queries.TOPK_SQL.replace("from benchmark where", "from (select doc_id as item_id, text from documents) where")).fetchall()
    got = [(r.query_id, r["rank"], r.doc_id, r.score) for r in entry.queries()["document_search_op9"](spark, SF).collect()]
    assert [x[:2] for x in sorted(got)] == [x[:2] for x in sorted(want)] and len(got) >= 90
    assert all(abs(a[3] - b[3]) < 2e-6 for a, b in zip(sorted(got), sorted(want)))


def test_every_operator_has_one_query():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()


def test_language_on_held_out(spark):
    got = entry.queries()["op1_language_id"](spark, SF).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r.lang_pred == lang[r.doc_id] for r in got if r.held_out]
    assert sum(held) >= 0.97 * len(held)


def test_lm_beats_its_base_on_held_out(spark):
    got = [r for r in entry.queries()["op7_lm_score"](spark, SF).collect() if r.held_out]
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_stages(spark, empty):
    docs = staged(data.frame(spark, [] if empty else None).repartition(3), "test-docs")
    rows = [tuple(r) for r in docs.collect()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = staged(stage(spark, docs, SF), "test-stage")
        got = [tuple(r) for r in out.collect()]
        if i < 4:
            assert out.columns == docs.columns and set(got) <= set(rows), name
        if name == "language":
            assert {r[0] for r in rows if re.search(r"[^\W\d_]", r[1] or "")} == {r[0] for r in got}
        elif name == "exact duplicates":
            plain = lambda r: re.sub(r"[\x20\x09-\x0D]+", "", r[1] or "")
            assert len(got) == len({plain(r) for r in rows}) == len({plain(r) for r in got})
        elif name == "near duplicates":
            want = [r for r, (_, c) in zip(rows, data.near_components(rows, corpus_pipeline.NEAR_THRESHOLD)) if r[0] == c]
            assert sorted(map(str, got)) == sorted(map(str, want))
        elif name == "tokens":
            assert sorted(str(r[0]) for r in rows) == sorted(str(r[0]) for r in got)
        docs, rows = out, got


def test_mix_stage_repeats_rows(spark):
    from echofield.llm import mixing

    docs = staged(spark.read.parquet(f"{SF}/documents.parquet"), "test-docs")
    want = {r.doc_id: r.copies for r in mixing.mix(docs).collect() if r.copies}
    got = {r.doc_id: r["count"] for r in corpus_pipeline.mix_sources(spark, docs, SF).groupBy("doc_id").count().collect()}
    assert got == want


def test_run_is_the_stages(spark):
    assert corpus_pipeline.run(spark, SF).filter(F.col("n_tokens") > 0).count() > 0
