"""Queues, samples, deduplication, reshaping."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from echofield.functions import text as tx
from echofield.operators import combine, groups, pick, profile
from echofield.plans.registry import query
from echofield.plans.views import CLEANED, REVIEWS, SCORED, VECTORS, clean_sql


@query("f1_alert_queue", f"""WITH {SCORED} SELECT id, platform, cluster_name, substr(content, 1, 180) || '...' AS content, isolation_score, severity
    FROM scored WHERE tier1_critical ORDER BY isolation_score DESC, id""")
def f1(t):
    return pick.alert_queue(t.scored)


@query("f2_triage_queue", f"""WITH {SCORED} SELECT id, platform, severity_score_ml, score, thumbs_up, review_length FROM scored
    WHERE severity_score_ml >= 0.6 ORDER BY severity_score_ml DESC, id LIMIT 200""")
def f2(t):
    return pick.triage_queue(t.scored, 0.6).select("id", "platform", "severity_score_ml", "score", "thumbs_up", "review_length")


@query("f3_churn_watchlist", f"""WITH {SCORED} SELECT id, platform, churn_risk_score, churn_risk_label, route_category FROM scored
    ORDER BY churn_risk_score DESC, id LIMIT 100""")
def f3(t):
    return pick.watchlist(t.scored).select("id", "platform", "churn_risk_score", "churn_risk_label", "route_category")


@query("f5_top_per_group", """SELECT * FROM (SELECT l_suppkey, l_orderkey * 10 + l_linenumber AS line_key, l_extendedprice,
      row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey * 10 + l_linenumber)::INTEGER AS rank FROM lineitem) WHERE rank <= 5""")
def f5(t):
    li = t("lineitem").select(
        "l_suppkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_key"), "l_extendedprice"
    )
    return pick.top_per_group(li, "l_suppkey", "l_extendedprice", "line_key", 5)


_CENT = """cents AS (SELECT label, list(m ORDER BY i) AS c FROM (SELECT label, i, avg(x) AS m FROM (
      SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY label, i) GROUP BY label)"""


@query("f6_nearest_members", f"""WITH {_CENT}, s AS (SELECT label, vec_id, round(list_cosine_similarity(embedding::DOUBLE[], c), 6) AS cosine FROM embeddings JOIN cents USING (label))
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY cosine DESC, vec_id)::INTEGER AS rank FROM s) WHERE rank <= 12""")
def f6(t):
    return groups.nearest_members(t("embeddings"), "label", "embedding", 12, "vec_id").select("label", "vec_id", "cosine", "rank")


@query("f7_critical_sample", f"""WITH {SCORED} SELECT sid, platform, score, substr(content, 1, 220) AS content, isolation_score FROM scored
    WHERE isolation_anomaly ORDER BY isolation_score DESC, id LIMIT 12""")
def f7(t):
    return pick.critical_sample(t.scored).select("sid", "platform", "score", "content", "isolation_score")


@query("f8_top_categories", f"""WITH {SCORED}, k AS (SELECT cluster_name FROM scored GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 6)
    SELECT id, cluster_name FROM scored WHERE cluster_name IN (SELECT * FROM k)""")
def f8(t):
    return profile.top_categories(t.scored, "cluster_name", 6).select("id", "cluster_name")


@query("f9_seeded_sample", """SELECT event_id, user_id FROM events ORDER BY md5(event_id || '|42'), event_id LIMIT 400""")
def f9(t):
    return pick.sample_rows(t("events"), 400, "event_id").select("event_id", "user_id")


@query("f10_stratified_sample", f"""WITH {SCORED}, r AS (SELECT id, severity_label_gold, row_number() OVER (PARTITION BY severity_label_gold ORDER BY md5(id || '|42'), id) AS r FROM scored)
    SELECT id, severity_label_gold FROM r WHERE r <= 40 AND (SELECT count(*) FROM scored) >= 120""")
def f10(t):
    return pick.sample_per_label(t.scored.select("id", "severity_label_gold"), "severity_label_gold")


@query("f12_preview", f"""WITH {CLEANED} SELECT id, platform, substr(cleaned_content, 1, 120) AS preview FROM cleaned WHERE star_bucket = 'complaint' ORDER BY id LIMIT 5""")
def f12(t):
    return pick.preview(t.cleaned)


@query("f13_best_model", """WITH m AS (SELECT event_type AS model, min(event_id) AS position, round(avg(value), 6) AS metric FROM events GROUP BY 1)
    SELECT * FROM m ORDER BY metric DESC, position LIMIT 1""")
def f13(t):
    m = t("events").groupBy(F.col("event_type").alias("model")).agg(
        F.min("event_id").alias("position"), F.round(F.avg("value"), 6).alias("metric")
    )
    return pick.best_model(m, "metric")


@query("f14_insights_by_size", f"""WITH {SCORED}, i AS (SELECT 'kmeans' AS algorithm, kmeans_cluster AS cluster_id, count(*) AS size FROM scored GROUP BY ALL
      UNION ALL SELECT 'hdbscan', hdbscan_cluster, count(*) FROM scored GROUP BY ALL)
    SELECT * FROM i WHERE algorithm = 'hdbscan' AND cluster_id <> -1 ORDER BY size DESC, cluster_id""")
def f14(t):
    parts = [
        profile.group_counts(t.scored, [c], "size").select(F.lit(a).alias("algorithm"), F.col(c).alias("cluster_id"), "size")
        for a, c in (("kmeans", "kmeans_cluster"), ("hdbscan", "hdbscan_cluster"))
    ]
    both = combine.union_all(parts)
    return both.filter((F.col("algorithm") == "hdbscan") & (F.col("cluster_id") != -1)).orderBy(F.desc("size"), "cluster_id")


@query("f15_landscape_points", f"""WITH {SCORED} SELECT s.id, platform, cluster_name, star_bucket, coalesce(embedding[1]::DOUBLE, 0.0) AS x, coalesce(embedding[2]::DOUBLE, 0.0) AS y
    FROM scored s LEFT JOIN embeddings e ON e.vec_id = s.id WHERE platform IN ('src1', 'src2')""")
def f15(t):
    pts = t("embeddings").select(F.col("vec_id").alias("id"), "embedding")
    at = lambda i: F.coalesce(F.col("embedding")[i].cast("double"), F.lit(0.0))
    return t.scored.filter(F.col("platform").isin("src1", "src2")).join(pts, "id", "left").select(
        "id", "platform", "cluster_name", "star_bucket", at(0).alias("x"), at(1).alias("y")
    )


@query("g1_dedup_raw", f"WITH {REVIEWS} SELECT id, review_id, platform FROM (SELECT *, row_number() OVER (PARTITION BY content ORDER BY id) AS r FROM reviews) WHERE r = 1")
def g1(t):
    return combine.keep_first(t.reviews.select("id", "review_id", "platform", "content"), "content").drop("content")


@query("g2_dedup_cleaned", f"""WITH {CLEANED} SELECT id, review_length FROM (SELECT *, row_number() OVER (PARTITION BY cleaned_content ORDER BY id) AS r
    FROM cleaned WHERE length(cleaned_content) >= 10) WHERE r = 1""")
def g2(t):
    c = t.cleaned.filter(F.length("cleaned_content") >= 10).select("id", "review_length", "cleaned_content")
    return combine.keep_first(c, "cleaned_content").drop("cleaned_content")


@query("g3_union_sources", """SELECT 'doc-' || doc_id AS review_id, text AS content, lang FROM documents
    UNION ALL SELECT 'page-' || page_id, html, NULL FROM pages""")
def g3(t):
    tag = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string")).alias("review_id")
    return combine.union_all([
        t("documents").select(tag("doc-", "doc_id"), F.col("text").alias("content"), "lang"),
        t("pages").select(tag("page-", "page_id"), F.col("html").alias("content")),
    ])


@query("g5_ordered_distinct_citations", """SELECT conv_id, list_aggregate(list_distinct_ordered, 'string_agg', ',') AS cited FROM (
    SELECT conv_id, list_filter(xs, lambda x, i: list_position(xs, x) = i) AS list_distinct_ordered FROM (
      SELECT conv_id, regexp_extract_all('see R000' || (conv_id % 7) || ' and R' || (10000 + conv_id) || ', again R000' || (conv_id % 7), 'R[0-9]{4,}') AS xs FROM conversations))""")
def g5(t):
    c = F.col("conv_id")
    k = (c % 7).cast("string")
    answer = F.concat(F.lit("see R000"), k, F.lit(" and R"), (c + 10000).cast("string"), F.lit(", again R000"), k)
    return t("conversations").select("conv_id", F.array_join(tx.citations(answer), ",").alias("cited"))


@query("g6_token_overlap", """WITH b AS (SELECT item_id, list_distinct(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM benchmark),
    d AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM documents)
    SELECT doc_id, len(list_intersect(d.w, b.w))::INTEGER AS shared, (len(d.w) + len(b.w) - len(list_intersect(d.w, b.w)))::INTEGER AS either
    FROM d JOIN b ON item_id = doc_id % (SELECT count(*) FROM benchmark)""")
def g6(t):
    toks = lambda: F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)))
    b = t("benchmark").select("item_id", toks().alias("bw"))
    d = t("documents").select("doc_id", toks().alias("dw")).withColumn("_n", b.agg(F.count(F.lit(1))).scalar())
    j = d.withColumn("item_id", F.col("doc_id") % F.col("_n")).join(b, "item_id")
    return j.select(
        "doc_id", F.size(F.array_intersect("dw", "bw")).alias("shared"), F.size(F.array_union("dw", "bw")).alias("either")
    )


_METRICS = """m AS (SELECT event_type AS variant, count(*)::DOUBLE AS n, round(avg(value), 6) AS mean, max(value) AS top FROM events GROUP BY 1)"""


def _metrics(t):
    return t("events").groupBy(F.col("event_type").alias("variant")).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.round(F.avg("value"), 6).alias("mean"), F.max("value").alias("top")
    )


@query("g7_melt_metrics", f"WITH {_METRICS} SELECT variant, metric, value FROM (UNPIVOT m ON n, mean, top INTO NAME metric VALUE value)")
def g7(t):
    return combine.melt(_metrics(t), ["variant"], ["n", "mean", "top"])


@query("g8_transpose_metrics", f"""WITH {_METRICS}, l AS (UNPIVOT m ON n, mean, top INTO NAME metric VALUE value)
    SELECT metric, max(CASE WHEN variant = 'click' THEN value END) AS click, max(CASE WHEN variant = 'view' THEN value END) AS "view",
      max(CASE WHEN variant = 'error' THEN value END) AS error FROM l GROUP BY 1""")
def g8(t):
    return combine.transpose(_metrics(t), "variant", ["click", "view", "error"], ["n", "mean", "top"])


@query("g10_stack_features", f"""WITH {CLEANED}, {VECTORS} SELECT id, list_concat([review_length::DOUBLE, coalesce(score, 3.0)::DOUBLE], embedding::DOUBLE[]) AS features
    FROM cleaned JOIN vectors USING (id)""")
def g10(t):
    d = t.cleaned.select("id", "review_length", F.coalesce("score", F.lit(3.0)).alias("score")).join(t.vectors, "id")
    return combine.stack_features(d, ["review_length", "score"], "embedding").select(
        "id", vector_to_array("features").alias("features")
    )
