"""Retrieval for all benchmark passages at once, fusion, evaluation, citation audit."""

from pyspark.sql import functions as F

from echofield import fixed
from echofield.functions import text as tx
from echofield.operators import combine, joins, profile
from echofield.operators import retrieval as rt
from echofield.plans.registry import query
from echofield.plans.views import SCORED, VECTORS
from echofield.sources.tables import written

_TOKENS = r"regexp_extract_all(lower(text), '[a-z0-9]+|[\x{0900}-\x{097F}]+')"

LEXICAL = f"""qt AS (SELECT query_id, term, count(*) AS qf FROM (SELECT item_id AS query_id, unnest({_TOKENS}) AS term FROM benchmark) GROUP BY ALL),
    dt0 AS (SELECT doc_id, {_TOKENS} AS t FROM documents), dl AS (SELECT doc_id, len(t) AS dl FROM dt0),
    dt AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM dt0) GROUP BY ALL),
    st AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl), tdf AS (SELECT term, count(*) AS df FROM dt GROUP BY 1),
    idf0 AS (SELECT term, df, ln(n - df + 0.5) - ln(df + 0.5) AS idf FROM tdf, st),
    idf AS (SELECT term, df, CASE WHEN idf < 0 THEN 0.25::DOUBLE * (SELECT avg(idf) FROM idf0) ELSE idf END AS idf FROM idf0),
    bm25 AS (SELECT query_id, doc_id, round(sum(qf * idf * tf * 2.5::DOUBLE / (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avgdl))), 6) AS score
      FROM qt JOIN dt USING (term) JOIN idf USING (term) JOIN dl USING (doc_id), st GROUP BY ALL),
    lexical AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM bm25 WHERE score > 0) WHERE rank <= 40)"""

DENSE = VECTORS + """, qv AS (SELECT item_id AS query_id, embedding::DOUBLE[] AS qe FROM benchmark JOIN embeddings ON vec_id = item_id),
    sims AS (SELECT query_id, id AS doc_id, round(list_cosine_similarity(qe, embedding::DOUBLE[]), 6) AS score FROM qv, vectors),
    dense AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM sims) WHERE rank <= 40)"""

FUSED = f"""{LEXICAL}, {DENSE},
    lists AS (SELECT query_id, doc_id, rank, 0 AS src FROM dense UNION ALL SELECT query_id, doc_id, rank, 1 FROM lexical),
    fused0 AS (SELECT query_id, doc_id, round(sum(1.0::DOUBLE / (60 + rank)), 12) AS fused, min(src * 1000 + rank) AS seen FROM lists GROUP BY ALL),
    fused AS (SELECT query_id, doc_id, fused, row_number() OVER (PARTITION BY query_id ORDER BY fused DESC, seen)::INTEGER AS rank FROM fused0)"""

HYBRID = FUSED + """, hybrid AS (SELECT query_id, doc_id, coalesce(score, 0.0) AS score, f.rank FROM fused f LEFT JOIN (SELECT query_id, doc_id, score FROM dense) USING (query_id, doc_id))"""

RERANK = HYBRID + f""", qtok AS (SELECT item_id AS query_id, {_TOKENS} AS q FROM benchmark),
    pairs AS (SELECT query_id, doc_id, q, t AS d, list_distinct([q[i] || ' ' || q[i + 1] for i in range(1, len(q))]) AS q2,
      list_distinct([t[i] || ' ' || t[i + 1] for i in range(1, len(t))]) AS d2 FROM fused JOIN qtok USING (query_id) JOIN dt0 USING (doc_id) WHERE rank <= 40),
    scoredp AS (SELECT query_id, doc_id, round(0.5::DOUBLE * len(list_intersect(list_distinct(q), list_distinct(d))) / greatest(len(list_distinct(q)), 1)
      + 0.3::DOUBLE * len(list_intersect(q2, d2)) / greatest(len(q2), 1) + 0.2::DOUBLE * coalesce(score, 0), 6) AS pair_score, score AS cos
      FROM pairs LEFT JOIN (SELECT query_id, doc_id, score FROM dense) USING (query_id, doc_id)),
    rerank AS (SELECT query_id, doc_id, coalesce(cos, pair_score) AS score, pair_score,
      row_number() OVER (PARTITION BY query_id ORDER BY pair_score DESC, doc_id)::INTEGER AS rank FROM scoredp)"""

TRUTH = """questions AS (SELECT item_id AS query_id, item_id % 10 = 9 AS unanswerable FROM benchmark),
    judged AS (SELECT q.item_id AS query_id, v.id AS doc_id FROM benchmark q JOIN embeddings e ON e.vec_id = q.item_id JOIN vectors v ON v.label = e.label
      WHERE q.item_id % 3 = 0 AND v.id % 4 = 0 AND q.item_id = v.id // 4 % (SELECT count(*) FROM benchmark)),
    keyword AS (SELECT item_id AS query_id, doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)),
    truth AS (SELECT query_id, doc_id, 'judged' AS mode FROM judged
      UNION ALL SELECT query_id, doc_id, 'keyword' FROM keyword JOIN questions USING (query_id) WHERE NOT unanswerable AND query_id NOT IN (SELECT query_id FROM judged))"""


def _docs(t):
    return t("documents").select("doc_id", "text")


def _doc_vectors(t, *extra):
    return t.vectors.select(F.col("id").alias("doc_id"), "embedding", *extra)


def _query_vectors(t):
    e = t("embeddings").select(F.col("vec_id").alias("query_id"), "embedding")
    return t.queries.select("query_id").join(e, "query_id")


def _dense(t, n=fixed.SHORTLIST):
    return rt.dense_topn(_query_vectors(t), _doc_vectors(t), n)


def _lexical(t, n=fixed.SHORTLIST):
    return rt.lexical_topn(t.queries, rt.lexical_index(_docs(t), stored=True), n)


def _search(t, variant, k=fixed.ANSWER_K):
    """Variants of one query share the stored shortlists of both sides."""
    if "search_parts" not in t.__dict__:
        t.search_parts = written(_dense(t), "dense"), written(_lexical(t), "lexical")
    dense, lexical = t.search_parts
    return rt.search(t.queries, _docs(t), _query_vectors(t), _doc_vectors(t), k, variant, dense=dense, lexical=lexical)


def _filters(t):
    """Every second question asks for two sources and one language."""
    asked = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(v).alias("value")) for c, v in (("source", "src1"), ("source", "src2"), ("lang", "en"))]))
    return t.queries.filter("query_id % 2 = 0").select("query_id", asked.alias("f")).select("query_id", "f.*")


def _facts(t):
    return t("documents").select("doc_id", "source", "lang")


@query("n1_dense_topn", f"WITH {DENSE} SELECT query_id, doc_id, score, rank FROM dense")
def n1(t):
    return _dense(t)


@query("n1_dense_filtered", f"""WITH {DENSE}, f AS (SELECT s.*, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::INTEGER AS rank
      FROM sims s JOIN documents USING (doc_id) WHERE query_id % 2 = 1 OR (source IN ('src1', 'src2') AND lang = 'en'))
    SELECT query_id, doc_id, score, rank FROM f WHERE rank <= 8""")
def n1_filtered(t):
    corpus = _doc_vectors(t).join(t("documents").select("doc_id", "source", "lang"), "doc_id")
    return rt.dense_topn(_query_vectors(t), corpus, 8, _filters(t))


@query("c11_all_pairs_topn", """WITH q AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS qe FROM embeddings WHERE vec_id % 10 = 0),
    s AS (SELECT query_id, vec_id AS doc_id, round(list_cosine_similarity(qe, embedding::DOUBLE[]), 6) AS score FROM q, embeddings)
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM s) WHERE rank <= 10""")
def c11(t):
    e = t("embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    q = e.filter(F.col("doc_id") % 10 == 0).withColumnRenamed("doc_id", "query_id")
    return rt.dense_topn(q, e, 10)


@query("n2_lexical_index", f"WITH {LEXICAL} SELECT term, df, round(idf, 6) AS idf FROM idf")
def n2(t):
    return rt.lexical_index(_docs(t)).terms.select("term", "df", F.round("idf", 6).alias("idf"))


@query("n3_lexical_topn", f"WITH {LEXICAL} SELECT query_id, doc_id, score, rank FROM lexical")
def n3(t):
    return _lexical(t)


@query("c12_query_term_postings", f"WITH {LEXICAL} SELECT query_id, count(*) AS postings, count(DISTINCT term) AS terms, sum(qf * tf)::BIGINT AS weight FROM qt JOIN dt USING (term) GROUP BY 1")
def c12(t):
    m = rt.matching_postings(t.queries, rt.lexical_index(_docs(t)))
    return m.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("postings"), F.countDistinct("term").alias("terms"), F.sum(F.col("qf") * F.col("tf")).alias("weight")
    )


@query("n4_rank_fusion", f"WITH {FUSED} SELECT query_id, doc_id, fused, rank FROM fused")
def n4(t):
    return rt.fuse([_dense(t), _lexical(t)])


@query("n5_hybrid_search", f"WITH {HYBRID} SELECT query_id, doc_id, score, rank FROM hybrid WHERE rank <= 8")
def n5(t):
    return _search(t, "hybrid")


# Both sides under the same filters: every second question takes two sources and one language only.
FILTERED = (
    RERANK.replace("FROM qv, vectors)", "FROM qv, vectors JOIN documents ON doc_id = id WHERE query_id % 2 = 1 OR (source IN ('src1', 'src2') AND lang = 'en'))")
    .replace("FROM bm25 WHERE score > 0)", "FROM bm25 JOIN documents USING (doc_id) WHERE score > 0 AND (query_id % 2 = 1 OR (source IN ('src1', 'src2') AND lang = 'en')))")
)


def _filtered(t, variant):
    return rt.search(t.queries, _docs(t), _query_vectors(t), _doc_vectors(t), fixed.ANSWER_K, variant, filters=_filters(t), facts=_facts(t))


@query("n5_hybrid_filtered", f"WITH {FILTERED} SELECT query_id, doc_id, score, rank FROM hybrid WHERE rank <= 8")
def n5_filtered(t):
    return _filtered(t, "hybrid")


@query("n6_rerank_filtered", f"WITH {FILTERED} SELECT query_id, doc_id, score, rank FROM rerank WHERE rank <= 8")
def n6_filtered(t):
    return _filtered(t, "rerank")


@query("n6_rerank_search", f"WITH {RERANK} SELECT query_id, doc_id, score, rank FROM rerank WHERE rank <= 8")
def n6(t):
    return _search(t, "rerank")


@query("n7_variant_dispatch", f"""WITH {HYBRID} SELECT 'dense' AS variant, query_id, doc_id, score, rank FROM dense WHERE rank <= 3
    UNION ALL SELECT 'hybrid', query_id, doc_id, score, rank FROM hybrid WHERE rank <= 3""")
def n7(t):
    return combine.union_all([_search(t, v, 3).select(F.lit(v).alias("variant"), "query_id", "doc_id", "score", "rank") for v in ("dense", "hybrid")])


_POOL = RERANK + """, pool0 AS (SELECT query_id, doc_id, 0 AS variant, rank FROM dense WHERE rank <= 12 UNION ALL SELECT query_id, doc_id, 1, rank FROM hybrid WHERE rank <= 12
      UNION ALL SELECT query_id, doc_id, 2, rank FROM rerank WHERE rank <= 12),
    pool AS (SELECT query_id, doc_id, variant, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id, doc_id ORDER BY variant, rank) AS r FROM pool0) WHERE r = 1)"""


def _rankings(t, k=fixed.POOL_DEPTH):
    return [_search(t, v, k) for v in fixed.VARIANTS]


@query("g4_candidate_pool", f"WITH {_POOL} SELECT query_id, doc_id, variant, rank FROM pool")
def g4(t):
    return combine.candidate_pool(_rankings(t), fixed.POOL_DEPTH)


@query("n8_label_pool", f"""WITH {_POOL}, sig AS (SELECT query_id, md5(string_agg(sid, ',' ORDER BY sid)) AS signature, count(*) AS pool_size FROM (
      SELECT query_id, 'R' || CASE WHEN doc_id > 9999 THEN doc_id::VARCHAR ELSE lpad(doc_id::VARCHAR, 4, '0') END AS sid FROM pool) GROUP BY 1)
    SELECT query_id, doc_id, variant, rank, substr(text, 1, 400) AS preview, signature, pool_size FROM pool JOIN sig USING (query_id) JOIN documents USING (doc_id)""")
def n8(t):
    bound = t.queries.count() * fixed.POOL_DEPTH * len(fixed.VARIANTS)
    return rt.label_pool(_rankings(t), _docs(t), at_most=bound)


@query("c4_ranked_documents", f"WITH {LEXICAL} SELECT query_id, rank, doc_id, lang, source FROM lexical JOIN documents USING (doc_id) WHERE rank <= 8")
def c4(t):
    docs = t("documents").select("doc_id", "lang", "source")
    bound = t.queries.count() * fixed.ANSWER_K
    return rt.with_documents(_lexical(t, fixed.ANSWER_K).drop("score"), docs, bound)


def _questions(t):
    return t.queries.select("query_id", (F.col("query_id") % 10 == 9).alias("unanswerable"))


def _judged(t):
    """Every fourth document has been shown to one question; it is relevant if both have the same label."""
    labels = t("embeddings").select(F.col("vec_id").alias("query_id"), "label").filter(F.col("query_id") % 3 == 0)
    q = t.queries.select("query_id").join(labels, "query_id")
    shown = F.floor(F.col("id") / 4) % t.queries.agg(F.count(F.lit(1))).scalar()
    docs = t.vectors.filter(F.col("id") % 4 == 0).select(F.col("id").alias("doc_id"), "label", shown.alias("query_id"))
    return docs.join(q, ["query_id", "label"]).select("query_id", "doc_id")


def _keyword(t):
    return rt.passage_relevance(_docs(t), t.queries)


def _truth(t):
    return rt.ground_truth(_questions(t), _judged(t), _keyword(t))


@query("c5_relevance_membership", f"""WITH {LEXICAL}, {VECTORS}, {TRUTH} SELECT query_id, l.doc_id, rank, mode IS NOT NULL AS relevant FROM lexical l LEFT JOIN truth USING (query_id, doc_id)
    WHERE rank <= 8""")
def c5(t):
    truth = _truth(t).select("query_id", "doc_id", F.lit(True).alias("relevant"))
    return _lexical(t, 8).drop("score").join(truth, ["query_id", "doc_id"], "left").withColumn("relevant", F.coalesce("relevant", F.lit(False)))


@query("e10_first_relevant_rank", f"""WITH {LEXICAL}, {VECTORS}, {TRUTH} SELECT query_id, min(rank)::INTEGER AS first_rank, round(1 / min(rank), 4) AS rr
    FROM lexical JOIN truth USING (query_id, doc_id) GROUP BY 1""")
def e10(t):
    hits = joins.valid_only(_lexical(t), _truth(t), ["query_id", "doc_id"])
    return hits.groupBy("query_id").agg(F.min("rank").alias("first_rank")).withColumn("rr", F.round(1 / F.col("first_rank"), 4))


# Answers: every third question is refused; the others cite their two best documents and one invented id.
_ANSWERS = f"""{LEXICAL}, ids AS (SELECT query_id, rank, 'R' || CASE WHEN doc_id > 9999 THEN doc_id::VARCHAR ELSE lpad(doc_id::VARCHAR, 4, '0') END AS sid FROM lexical WHERE rank <= 8),
    answers AS (SELECT item_id AS query_id, item_id % 10 = 9 AS unanswerable, CASE WHEN item_id % 3 = 2 THEN 'Not enough evidence in the retrieved reviews to answer this.'
      ELSE 'Late [' || coalesce(a.sid, 'R0000') || '] and [' || coalesce(b.sid, 'R0001') || '], see [R99' || lpad((item_id % 100)::VARCHAR, 4, '0') || '] and [' || coalesce(a.sid, 'R0000') || '].' END AS answer
      FROM benchmark LEFT JOIN ids a ON a.query_id = item_id AND a.rank = 1 LEFT JOIN ids b ON b.query_id = item_id AND b.rank = 2),
    cites AS (SELECT query_id, unanswerable, contains(lower(answer), 'not enough evidence in the retrieved reviews to answer this') AS refused,
      list_filter(regexp_extract_all(answer, 'R[0-9]{{4,}}'), lambda x, i: list_position(regexp_extract_all(answer, 'R[0-9]{{4,}}'), x) = i) AS cited FROM answers)"""


def _retrieved(t):
    """Stored for the query: answers and their audit read the same list."""
    if "retrieved" not in t.__dict__:
        t.retrieved = written(_lexical(t, fixed.ANSWER_K).select("query_id", "rank", tx.short_id(F.col("doc_id")).alias("sid")), "retrieved")
    return t.retrieved


def _answers(t):
    top = _retrieved(t).filter(F.col("rank") <= 2).groupBy("query_id").agg(
        F.max(F.when(F.col("rank") == 1, F.col("sid"))).alias("a"), F.max(F.when(F.col("rank") == 2, F.col("sid"))).alias("b")
    )
    q = _questions(t).join(top, "query_id", "left")
    a, b = F.coalesce("a", F.lit("R0000")), F.coalesce("b", F.lit("R0001"))
    fake = F.lpad((F.col("query_id") % 100).cast("string"), 4, "0")
    cited = F.concat(F.lit("Late ["), a, F.lit("] and ["), b, F.lit("], see [R99"), fake, F.lit("] and ["), a, F.lit("]."))
    return q.select(
        "query_id", "unanswerable", F.when(F.col("query_id") % 3 == 2, fixed.REFUSAL_SENTENCE).otherwise(cited).alias("answer")
    )


_AUDIT = f"""{_ANSWERS}, flat AS (SELECT query_id, unnest(cited) AS sid, generate_subscripts(cited, 1) AS i FROM cites),
    bad AS (SELECT * FROM flat f WHERE NOT EXISTS (SELECT 1 FROM ids WHERE ids.query_id = f.query_id AND ids.sid = f.sid))"""


@query("n9_citation_audit", f"""WITH {_AUDIT} SELECT query_id, array_to_string(cited, ',') AS cited, coalesce((SELECT string_agg(sid, ',' ORDER BY i) FROM bad WHERE bad.query_id = cites.query_id), '') AS invalid, refused FROM cites""")
def n9(t):
    a = rt.citation_audit(_answers(t), _retrieved(t))
    return a.select("query_id", F.array_join("cited_ids", ",").alias("cited"), F.array_join("invalid_citations", ",").alias("invalid"), "refused")


@query("c6_invalid_citations", f"WITH {_AUDIT} SELECT query_id, sid FROM bad")
def c6(t):
    cited = _answers(t).select("query_id", F.explode(tx.citations(F.col("answer"))).alias("sid"))
    return joins.invalid_only(cited, _retrieved(t), ["query_id", "sid"])


@query("c7_valid_label_ids", f"WITH {_AUDIT} SELECT query_id, sid FROM flat EXCEPT SELECT query_id, sid FROM bad")
def c7(t):
    cited = _answers(t).select("query_id", F.explode(tx.citations(F.col("answer"))).alias("sid"))
    return joins.valid_only(cited, _retrieved(t), ["query_id", "sid"])


@query("n10_question_contexts", f"""WITH {SCORED}, {LEXICAL}, l AS (SELECT query_id, rank, '[' || sid || '] (platform=' || platform || ', rating=' || coalesce(s.score::VARCHAR, 'None') || ', date=' || strftime("at", '%Y-%m-%d')
      || ', severity=' || severity || ', team=' || coalesce(route_category, 'None') || ') ' || regexp_replace(content, '^\\s+|\\s+$', '', 'g') AS line FROM lexical JOIN scored s ON id = doc_id WHERE rank <= 8)
    SELECT query_id, string_agg(line, chr(10) ORDER BY rank) AS context FROM l GROUP BY 1""")
def n10(t):
    docs = t.scored.select(F.col("id").alias("doc_id"), "sid", "platform", F.col("score").alias("rating"), "at", "severity", "route_category", "content")
    ranked = rt.with_documents(_lexical(t, fixed.ANSWER_K).drop("score"), docs, t.queries.count() * fixed.ANSWER_K)
    line = tx.context_line(F.col("sid"), F.col("platform"), F.col("rating"), F.to_date("at"), F.col("severity"), F.col("route_category"), F.col("content"))
    return rt.contexts(ranked, line)


@query("m11_ground_truth", f"WITH {VECTORS}, {TRUTH} SELECT query_id, doc_id, mode FROM truth")
def m11(t):
    return _truth(t)


_KS = fixed.METRIC_KS


def _eval_sql(name: str) -> str:
    per = ", ".join(
        f"(coalesce(h{k}, 0) > 0)::INTEGER AS hit_{k}, round(coalesce(h{k}, 0) / {k}::DOUBLE, 3) AS precision_{k}, round(coalesce(h{k}, 0) / n_relevant::DOUBLE, 3) AS recall_{k}" for k in _KS
    )
    hits = ", ".join(f"count_if(rank <= {k}) AS h{k}" for k in _KS)
    return f"""(SELECT query_id, mode, n_relevant, first_rank, {per}, coalesce(round(1 / first_rank, 4), 0.0) AS rr
      FROM (SELECT query_id, count(*) AS n_relevant, max(mode) AS mode FROM truth GROUP BY 1)
      LEFT JOIN (SELECT query_id, min(rank)::INTEGER AS first_rank, {hits} FROM {name} JOIN truth USING (query_id, doc_id) WHERE rank <= 8 GROUP BY 1) USING (query_id))"""


@query("m10_question_metrics", f"WITH {HYBRID}, {TRUTH} SELECT * FROM {_eval_sql('hybrid')}")
def m10(t):
    return rt.evaluate(_search(t, "hybrid"), _truth(t))


def _block_sql(name: str) -> str:
    means = ", ".join(f"round(avg({m}_{k}), 3) AS {m}_{k}" for m in ("hit", "precision", "recall") for k in _KS)
    return f"SELECT '{name}' AS variant, {means}, round(avg(rr), 3) AS mrr, count(*) AS n_scored FROM {_eval_sql(name)}"


def _blocks(t, variants):
    truth = written(_truth(t), "truth")  # read twice for each variant
    parts = [rt.evaluate(_search(t, v), truth).withColumn("variant", F.lit(v)) for v in variants]
    return rt.metric_block(combine.union_all(parts), ["variant"])


@query("d19_retrieval_metric_block", f"WITH {HYBRID}, {TRUTH} {_block_sql('dense')} UNION ALL {_block_sql('hybrid')}")
def d19(t):
    return _blocks(t, ["dense", "hybrid"])


_ROWS = ["hit_1", "hit_3", "hit_5", "hit_8", "mrr", "precision_5", "recall_8"]


@query("m12_variant_comparison", f"""WITH {RERANK}, {TRUTH}, b AS ({_block_sql('dense')} UNION ALL {_block_sql('hybrid')} UNION ALL {_block_sql('rerank')}),
    l AS (SELECT variant, metric, value FROM (UNPIVOT b ON {', '.join(_ROWS)} INTO NAME metric VALUE value))
    SELECT metric, {', '.join(f"max(CASE WHEN variant = '{v}' THEN value END) AS {v}" for v in fixed.VARIANTS)} FROM l GROUP BY 1""")
def m12(t):
    return rt.compare_variants(_blocks(t, list(fixed.VARIANTS)), list(fixed.VARIANTS), _ROWS)


@query("d21_run_header", f"""WITH {VECTORS}, {TRUTH} SELECT (SELECT count(*) FROM questions) AS n_questions, (SELECT count_if(unanswerable) FROM questions)::BIGINT AS n_unanswerable,
    (SELECT count(DISTINCT query_id) FROM truth) AS n_retrieval_scored, (SELECT string_agg(DISTINCT mode, '+' ORDER BY mode) FROM truth) AS ground_truth,
    (SELECT count(*) FROM documents) AS corpus_size, 'hybrid' AS retriever_variant""")
def d21(t):
    return rt.run_header(_questions(t), _truth(t), t("documents"), "hybrid")


@query("d20_generation_summary", f"""WITH {_AUDIT}, a AS (SELECT query_id, unanswerable, refused, CASE WHEN refused OR unanswerable THEN NULL ELSE 1 + query_id % 5 END AS faithfulness,
      CASE WHEN refused OR unanswerable THEN NULL ELSE 1 + query_id % 4 END AS relevance, len(cited) AS n_cited, (SELECT count(*) FROM bad WHERE bad.query_id = cites.query_id) AS n_invalid FROM cites)
    SELECT count(faithfulness) AS n_judged, round(avg(faithfulness), 2) AS faithfulness_mean, round(avg(relevance), 2) AS relevance_mean,
      round(count_if(faithfulness >= 4) / count(faithfulness)::DOUBLE, 3) AS faithful_rate, round(count_if(faithfulness IS NOT NULL AND n_cited > 0) / count(faithfulness)::DOUBLE, 3) AS citation_rate,
      round((sum(n_cited) FILTER (faithfulness IS NOT NULL) - sum(n_invalid) FILTER (faithfulness IS NOT NULL)) / greatest(1, sum(n_cited) FILTER (faithfulness IS NOT NULL))::DOUBLE, 3) AS citation_validity,
      round(count_if(NOT unanswerable AND refused) / count_if(NOT unanswerable)::DOUBLE, 3) AS false_refusal_rate, round(count_if(unanswerable AND refused) / count_if(unanswerable)::DOUBLE, 3) AS refusal_accuracy FROM a""")
def d20(t):
    ans = _answers(t)
    a = rt.citation_audit(ans, _retrieved(t)).join(ans.select("query_id", "unanswerable"), "query_id")
    rated = ~F.col("refused") & ~F.col("unanswerable")
    return rt.generation_summary(a.select(
        "unanswerable", "refused", F.when(rated, 1 + F.col("query_id") % 5).alias("faithfulness"),
        F.when(rated, 1 + F.col("query_id") % 4).alias("relevance"), F.size("cited_ids").alias("n_cited"), F.size("invalid_citations").alias("n_invalid"),
    ))
