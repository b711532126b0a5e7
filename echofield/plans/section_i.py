"""Term weights, keywords, encoder."""

from pyspark.sql import functions as F

from echofield.functions import vectors as vx
from echofield.operators import tfidf
from echofield.plans.registry import query
from echofield.plans.views import SCORED, VECTORS
from echofield.sources import tables as src

_TOK = r"regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}_]{2,}')"
MAX_FEATURES = 5000


def tfidf_sql(src_name: str = "documents", fit: str = "documents", low: int = 1, min_df: int = 3, max_features: int = MAX_FEATURES) -> str:
    grams = "list_concat(w, [w[i] || ' ' || w[i + 1] for i in range(1, len(w))])"
    count = lambda s: f"""SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({grams}) AS term FROM (
        SELECT doc_id, {_TOK} AS w FROM {s})) GROUP BY ALL"""  # noqa: E731
    return f"""counts AS ({count(src_name)}), fit_counts AS ({count(fit)}),
    nd AS (SELECT count(*) AS n FROM {fit}),
    vocab AS (SELECT term, total, df, ln((1 + n) / (1 + df)::DOUBLE) + 1 AS idf FROM (
        SELECT term, sum(tf)::BIGINT AS total, count(*) AS df FROM fit_counts GROUP BY 1), nd
      WHERE df >= {min_df} AND df <= 0.85 * n ORDER BY total DESC, term LIMIT {max_features}),
    raw AS (SELECT doc_id, term, (1 + ln(tf)) * idf AS w FROM counts JOIN vocab USING (term)),
    weights AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM raw)"""


def _fit(t, **kw):
    return tfidf.fit_weights(t("documents").select("doc_id", "text"), "doc_id", "text", max_features=MAX_FEATURES, **kw)


@query("i1_vocabulary", f"WITH {tfidf_sql()} SELECT term, total, df, round(idf, 6) AS idf FROM vocab")
def i1(t):
    return _fit(t)[1].select("term", "total", "df", F.round("idf", 6).alias("idf"))


@query("i2_tfidf_weights", f"WITH {tfidf_sql()} SELECT doc_id, term, round(weight, 6) AS weight FROM weights")
def i2(t):
    return _fit(t)[0].select("doc_id", "term", F.round("weight", 6).alias("weight"))


@query("a5_sparse_matrix_table", f"WITH {tfidf_sql()} SELECT doc_id, count(*) AS nonzero, round(sum(weight), 6) AS total FROM weights GROUP BY 1")
def a5(t):
    path = src.shared_folder(t.spark, "tfidf")
    src.write_parquet(_fit(t)[0], path)
    back = t.spark.read.parquet(path)
    return back.groupBy("doc_id").agg(F.count(F.lit(1)).alias("nonzero"), F.round(F.sum("weight"), 6).alias("total"))


@query("i3_train_only_vocabulary", f"""WITH train AS (SELECT * FROM documents WHERE source NOT IN ('src1', 'src2', 'src3', 'src4', 'src5')),
    {tfidf_sql(fit='train', min_df=2)} SELECT doc_id, term, round(weight, 6) AS weight FROM weights""")
def i3(t):
    train = t("documents").filter(~F.col("source").isin("src1", "src2", "src3", "src4", "src5")).select("doc_id", "text")
    return _fit(t, train=train, min_df=2)[0].select("doc_id", "term", F.round("weight", 6).alias("weight"))


@query("i4_text_encoder", r"""WITH w AS (SELECT doc_id, w, count(*) AS c FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+|[\x{0900}-\x{097F}]+')) AS w FROM documents) GROUP BY ALL),
    f AS (SELECT doc_id, c, md5(unnest(list_concat([w], [substr(w, i, 3) for i in range(1, length(w) - 1)]))) AS h FROM w),
    cells AS (SELECT doc_id, ('0x' || substr(h, 1, 8))::BIGINT % 64 AS cell, sum(CASE WHEN ('0x' || substr(h, 9, 1))::INT % 2 = 0 THEN c ELSE -c END)::DOUBLE AS x FROM f GROUP BY ALL),
    n AS (SELECT doc_id, sqrt(sum(x * x)) AS n FROM cells GROUP BY 1)
    SELECT doc_id, cell::INTEGER AS cell, round(x / n, 6) AS x FROM cells JOIN n USING (doc_id) WHERE x <> 0""")
def i4(t):
    e = tfidf.encode(t("documents"), "doc_id", "text")
    return e.select("doc_id", F.posexplode("embedding").alias("cell", "v")).filter(F.col("v") != 0).select(
        "doc_id", "cell", F.round("v", 6).alias("x")
    )


_KW = f"""{VECTORS}, {tfidf_sql()}, members AS (SELECT id AS doc_id, label FROM vectors), sizes AS (SELECT label, count(*) AS size FROM members GROUP BY 1),
    kw AS (SELECT label, term, round(sum(weight) / any_value(size), 6) AS mean_weight FROM weights JOIN members USING (doc_id) JOIN sizes USING (label) GROUP BY ALL),
    keywords AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY mean_weight DESC, term)::INTEGER AS rank FROM kw) WHERE rank <= 10)"""


def _members(t):
    return t.vectors.select(F.col("id").alias("doc_id"), "label")


@query("i5_cluster_keywords", f"WITH {_KW} SELECT label, term, mean_weight, rank FROM keywords")
def i5(t):
    return tfidf.cluster_keywords(_fit(t)[0], _members(t), "doc_id", "label")


@query("f11_top_terms_per_cluster", f"WITH {_KW} SELECT label, term, rank FROM keywords WHERE rank <= 3")
def f11(t):
    return tfidf.cluster_keywords(_fit(t)[0], _members(t), "doc_id", "label", 3).select("label", "term", "rank")


@query("d10_cluster_profiles", f"""WITH {_KW}, t AS (SELECT label, string_agg(term, ', ' ORDER BY rank) AS top_terms FROM keywords GROUP BY 1)
    SELECT label, 'Cluster ' || label AS name, size, top_terms FROM sizes JOIN t USING (label)""")
def d10(t):
    m = _members(t).withColumn("name", F.concat(F.lit("Cluster "), F.col("label").cast("string")))
    kw = tfidf.cluster_keywords(_fit(t)[0], m, "doc_id", "label")
    return tfidf.cluster_profiles(kw, m, "label", "name")


@query("i6_term_contributions", f"""WITH {_KW}, c AS (SELECT doc_id, term, round(abs(weight * coalesce(mean_weight, 1)), 6) AS contribution
      FROM weights JOIN members USING (doc_id) LEFT JOIN keywords USING (label, term))
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY contribution DESC, term)::INTEGER AS rank FROM c) WHERE rank <= 5""")
def i6(t):
    w, m = _fit(t)[0], _members(t)
    kw = tfidf.cluster_keywords(w, m, "doc_id", "label")
    coef = kw.select("label", "term", F.col("mean_weight").alias("coefficient"))
    return tfidf.term_contributions(w, m, coef, "doc_id", "label")


@query("i7_unit_vectors", """SELECT vec_id, [round(x * 3 / (3 * sqrt(list_dot_product(v, v))), 6) for x in v] AS unit FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)""")
def i7(t):
    v = vx.unit(F.transform(vx.doubles(F.col("embedding")), lambda x: x * 3))
    return t("embeddings").select("vec_id", F.transform(v, lambda x: F.round(x, 6)).alias("unit"))


@query("k1_dot", "SELECT a.vec_id, round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS dot FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def k1(t):
    return _next(t).select("vec_id", F.round(vx.dot(F.col("a"), F.col("b")), 6).alias("dot"))


@query("k2_l2_distance", "SELECT a.vec_id, round(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS distance FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def k2(t):
    return _next(t).select("vec_id", F.round(vx.distance(F.col("a"), F.col("b")), 6).alias("distance"))


@query("k3_cosine", "SELECT a.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS cosine FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def k3(t):
    return _next(t).select("vec_id", F.round(vx.cosine(F.col("a"), F.col("b")), 6).alias("cosine"))


def _next(t):
    e = t("embeddings")
    b = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b"))
    return e.select("vec_id", F.col("embedding").alias("a")).join(b, "vec_id")


_CENT = """cents AS (SELECT label, list(m ORDER BY i) AS c FROM (SELECT label, i, avg(x) AS m FROM (
      SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY label, i) GROUP BY label)"""


@query("j9_centroid_distance", f"WITH {_CENT} SELECT vec_id, round(list_distance(embedding::DOUBLE[], c), 6) AS dist FROM embeddings JOIN cents USING (label)")
def j9(t):
    from echofield.operators import groups

    return groups.centroid_distance(t("embeddings"), "label", "embedding").select("vec_id", F.round("dist", 6).alias("dist"))


@query("c10_row_to_centroid", f"WITH {VECTORS}, {_CENT} SELECT id, label, round(list_cosine_similarity(embedding::DOUBLE[], c), 6) AS cosine FROM vectors JOIN cents USING (label)")
def c10(t):
    from echofield.operators import groups

    c = groups.centroids(t("embeddings"), "label", "embedding")
    return t.vectors.join(c, "label").select("id", "label", F.round(vx.cosine(F.col("embedding"), F.col("centroid")), 6).alias("cosine"))


@query("c1_vector_alignment", """SELECT doc_id, CAST(len(v) AS INTEGER) AS width, round(v[1]::DOUBLE, 6) AS first FROM (
    SELECT doc_id, coalesce(embedding, [0.0::FLOAT for i in range(16)]) AS v FROM documents LEFT JOIN embeddings ON vec_id = doc_id)""")
def c1(t):
    from echofield.operators import joins

    e = t("embeddings").withColumnRenamed("vec_id", "doc_id")
    a = joins.aligned(t("documents").select("doc_id"), e, "doc_id", "embedding")
    return a.select("doc_id", F.size("embedding").alias("width"), F.round(F.col("embedding")[0].cast("double"), 6).alias("first"))


@query("c2_label_lookup", f"""WITH {SCORED} SELECT id, cluster_name, CASE severity_label_weak WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' WHEN 2 THEN 'High' ELSE 'Unknown' END AS severity_name FROM scored""")
def c2(t):
    from echofield import fixed

    d = src.lookup(t.scored.drop("cluster_name"), "kmeans_cluster", fixed.CLUSTER_NAMES, "cluster_name",
                   F.concat(F.lit("Cluster "), F.col("kmeans_cluster").cast("string")))
    return src.lookup(d, "severity_label_weak", fixed.SEVERITY_NAMES, "severity_name", F.lit("Unknown")).select(
        "id", "cluster_name", "severity_name"
    )


@query("c3_theme_lookup", f"""WITH {SCORED}, labels2 AS (SELECT kmeans_cluster AS cluster_id, 'Theme of ' || min(sid) AS label FROM scored WHERE kmeans_cluster % 2 = 0 GROUP BY 1)
    SELECT kmeans_cluster, coalesce(any_value(label), any_value(cluster_name)) AS theme, count(*) AS reviews FROM scored LEFT JOIN labels2 ON cluster_id = kmeans_cluster GROUP BY 1""")
def c3(t):
    from echofield.operators import profile

    names = t.scored.filter(F.col("kmeans_cluster") % 2 == 0).groupBy(F.col("kmeans_cluster").alias("cluster_id")).agg(
        F.concat(F.lit("Theme of "), F.min("sid")).alias("label")
    )
    return profile.themes(t.scored, names).select("kmeans_cluster", "theme", "reviews")
