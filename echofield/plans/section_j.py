"""Reduction, clusters, anomalies, worklist."""

from itertools import product

from pyspark.sql import functions as F

from echofield.operators import clusters, coords, density, outliers, worklist
from echofield.plans.registry import query
from echofield.plans.views import SCORED, VECTORS
from echofield.session import durable

WIDTH = 64  # width of the driver vectors


@query("j1_pca_variance")
def j1(t):
    return coords.variance_report(t("embeddings"), "embedding", 50)


@query("j1_pca_coordinates")
def j1_coordinates(t):
    out, _ = coords.principal_components(t("embeddings"), "embedding", 10)
    return out.select("vec_id", F.posexplode("pca").alias("component", "value"))


@query("j1_pca_invariants", f"""WITH x AS (SELECT vec_id, unnest(embedding::DOUBLE[]) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
    s AS (SELECT i, var_samp(v) AS s FROM x GROUP BY 1) SELECT {WIDTH}::BIGINT AS components, round(sum(s), 4) AS total_variance, 0.0::DOUBLE AS largest_mean FROM s""")
def j1_invariants(t):
    """All components together keep the whole variance, and their coordinates are centred."""
    out, _ = coords.principal_components(t("embeddings"), "embedding", WIDTH)
    c = out.select(F.posexplode("pca").alias("i", "x")).groupBy("i").agg(F.var_samp("x").alias("s"), F.avg("x").alias("m"))
    return c.agg(F.count(F.lit(1)).alias("components"), F.round(F.sum("s"), 4).alias("total_variance"), F.round(F.max(F.abs("m")), 6).alias("largest_mean"))


def _projection_sql(k: int) -> str:
    cols = ", ".join(
        f"round(list_dot_product(embedding::DOUBLE[], [(CASE WHEN ('0x' || substr(md5('42|{i}|' || j), 1, 1))::INT % 2 = 0 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END) / sqrt({k}::DOUBLE) for j in range({WIDTH})]), 6) AS coord_{i + 1}"
        for i in range(k)
    )
    return f"SELECT vec_id, label, {cols} FROM embeddings"


@query("j2_low_dimensional_coordinates", _projection_sql(2))
def j2(t):
    return coords.sign_projection(t("embeddings"), "embedding", WIDTH, 2).drop("embedding")


@query("j3_kmeans")
def j3(t):
    e = t("embeddings")
    model = clusters.kmeans(e, "embedding", 8, restarts=20)
    return clusters.assign(e, model, "embedding").select("vec_id", "kmeans_cluster")


@query("j3_kmeans_invariants", "SELECT count(*) AS n_rows, 8::BIGINT AS n_clusters, 0::BIGINT AS not_nearest FROM embeddings")
def j3_invariants(t):
    """Every row is with its nearest centre, and no cluster is empty."""
    e = t("embeddings")
    model = clusters.kmeans(e, "embedding", 8, restarts=3)
    gap = lambda c: F.aggregate(
        F.zip_with("embedding", F.array(*[F.lit(float(v)) for v in c]), lambda a, b: (a.cast("double") - b) * (a.cast("double") - b)), F.lit(0.0), lambda s, x: s + x)
    d = clusters.assign(e, model, "embedding").withColumn("gaps", F.array(*[gap(c) for c in model.clusterCenters()]))
    return d.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("kmeans_cluster").alias("n_clusters"),
                 F.count_if(F.element_at("gaps", F.col("kmeans_cluster") + 1) > F.array_min("gaps") + 1e-6).alias("not_nearest"))


@query("j4_choose_k")
def j4(t):
    c, _ = coords.principal_components(t("embeddings"), "embedding", 10)
    return clusters.choose_k(durable(c.select("pca")), "pca", range(3, 13))


@query("j4_silhouette_sample", """WITH s AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings ORDER BY md5(vec_id || '|42'), vec_id LIMIT 400),
    d AS (SELECT a.vec_id, a.label, b.label AS other, sum(list_distance(a.v, b.v)) AS total, count(*) - max((a.label = b.label)::INT) AS n FROM s a, s b GROUP BY a.vec_id, a.label, b.label),
    m AS (SELECT vec_id, label, max(CASE WHEN other = label THEN total / n END) AS a, min(CASE WHEN other <> label THEN total / n END) AS b FROM d GROUP BY vec_id, label)
    SELECT vec_id, label, round((b - a) / greatest(a, b), 6) AS silhouette FROM m""")
def j4_silhouette(t):
    return clusters.silhouette_sample(t("embeddings"), "label", "embedding", 400, "vec_id")


@query("j4_silhouette_rows")
def j4_silhouette_rows(t):
    """The silhouette of every row; the twin of the sample keeps its 400 rows."""
    return clusters.silhouette(t("embeddings"), "label", "embedding", "vec_id")


_EPS, _MIN, _SIZE = 0.12, 12, 30
_OFFSETS = " UNION ALL ".join(f"SELECT {a} AS dx, {b} AS dy" for a, b in product((-1, 0, 1), repeat=2))


@query("j5_density_clusters", f"""WITH RECURSIVE pts AS ({_projection_sql(2)}),
    placed AS (SELECT vec_id, floor(coord_1 / {_EPS})::BIGINT AS x, floor(coord_2 / {_EPS})::BIGINT AS y FROM pts),
    cells AS (SELECT x, y, (x + 1048576) * 2097152 + y + 1048576 AS c, count(*) AS n FROM placed GROUP BY ALL),
    off AS ({_OFFSETS}),
    around AS (SELECT a.c, sum(b.n) AS m FROM cells a, off JOIN cells b ON b.x = a.x + dx AND b.y = a.y + dy GROUP BY 1),
    dense AS (SELECT cells.* FROM cells JOIN around USING (c) WHERE m >= {_MIN}),
    edges AS (SELECT a.c AS a, b.c AS b FROM dense a, off JOIN dense b ON b.x = a.x + dx AND b.y = a.y + dy),
    reach(c, root) AS (SELECT c, c FROM dense UNION SELECT e.b, r.root FROM reach r JOIN edges e ON e.a = r.c),
    comp AS (SELECT c, min(root) AS label FROM reach GROUP BY 1),
    own AS (SELECT c, label FROM comp UNION ALL SELECT a.c, min(label) FROM cells a, off JOIN dense b ON b.x = a.x + dx AND b.y = a.y + dy JOIN comp ON comp.c = b.c
      WHERE a.c NOT IN (SELECT c FROM dense) GROUP BY 1),
    sized AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS num FROM (SELECT label FROM own JOIN cells USING (c) GROUP BY label HAVING sum(n) >= {_SIZE}))
    SELECT vec_id, coalesce(num, -1)::INTEGER AS hdbscan_cluster FROM placed JOIN cells USING (x, y) LEFT JOIN own USING (c) LEFT JOIN sized USING (label)""")
def j5(t):
    c = coords.sign_projection(t("embeddings"), "embedding", WIDTH, 2)
    d = clusters.density_clusters(c.select("vec_id", "coord_1", "coord_2"), ["coord_1", "coord_2"], _EPS, _MIN, _SIZE)
    return d.select("vec_id", "hdbscan_cluster")


_REACH, _CORE, _WIDE = 0.85, 12, 10
_APART = " + ".join(f"(a.coord_{i} - b.coord_{i}) * (a.coord_{i} - b.coord_{i})" for i in range(1, _WIDE + 1))


@query("j5_reachability_clusters", f"""WITH RECURSIVE pts AS MATERIALIZED ({_projection_sql(_WIDE)}),
    near AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM pts a JOIN pts b ON {_APART} <= {_REACH * _REACH!r}::DOUBLE),
    core AS MATERIALIZED (SELECT a FROM near GROUP BY a HAVING count(*) >= {_CORE}),
    edges AS MATERIALIZED (SELECT a, b FROM near WHERE a IN (SELECT a FROM core) AND b IN (SELECT a FROM core)),
    reach(v, root) AS (SELECT a, a FROM core UNION SELECT e.b, r.root FROM reach r JOIN edges e ON e.a = r.v),
    comp AS (SELECT v, min(root) AS first_id FROM reach GROUP BY 1),
    sized AS (SELECT first_id FROM comp GROUP BY 1 HAVING count(*) >= {_SIZE})
    SELECT vec_id, vec_id IN (SELECT a FROM core) AS is_core, sized.first_id FROM pts LEFT JOIN comp ON v = vec_id LEFT JOIN sized USING (first_id)""")
def j5_reachability(t):
    """Clusters over ten coordinates, each named by its smallest id; noise has none."""
    c = coords.sign_projection(t("embeddings"), "embedding", WIDTH, _WIDE)
    names = [f"coord_{i + 1}" for i in range(_WIDE)]
    d = durable(density.reachability_clusters(c.select("vec_id", *names), names, _REACH, _CORE, _SIZE).select("vec_id", "is_core", "hdbscan_cluster"))
    first = d.filter("hdbscan_cluster >= 0").groupBy("hdbscan_cluster").agg(F.min("vec_id").alias("first_id"))
    return d.join(first, "hdbscan_cluster", "left").select("vec_id", "is_core", "first_id")


@query("j7_isolation_forest")
def j7(t):
    return outliers.isolation_flags(t("embeddings"), "embedding", trees=200, key="vec_id")


@query("j8_reference_novelty")
def j8(t):
    d = t("embeddings").withColumn("is_reference", F.col("label") == 5)
    return outliers.novelty(d, "embedding", "is_reference", key="vec_id")


@query("j10_tier_rule", f"WITH {SCORED} SELECT id, tier1_critical, severity FROM scored")
def j10(t):
    return outliers.tiers(t.scored.drop("tier1_critical", "severity")).select("id", "tier1_critical", "severity")


_REPS = f"""{SCORED}, {{cent}}, r0 AS (SELECT s.*, v.embedding::DOUBLE[] AS e, coalesce(s.score <= 2, false) AS low FROM scored s JOIN vectors v USING (id)),
    cents AS (SELECT kmeans_cluster, list(m ORDER BY i) AS c FROM (SELECT kmeans_cluster, i, avg(x) AS m FROM (
      SELECT kmeans_cluster, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM r0) GROUP BY ALL) GROUP BY 1),
    foc AS (SELECT kmeans_cluster, count_if(low) >= 10 AS focus FROM r0 GROUP BY 1),
    cosines AS (SELECT kmeans_cluster, focus, id, sid, round(list_cosine_similarity(e, c), 6) AS cosine FROM r0 JOIN cents USING (kmeans_cluster) JOIN foc USING (kmeans_cluster) WHERE low OR NOT focus),
    reps AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY kmeans_cluster ORDER BY cosine DESC, id)::INTEGER AS rank FROM cosines) WHERE rank <= 12),
    sigs AS (SELECT kmeans_cluster, focus, md5(CASE WHEN focus THEN 'c' ELSE 'a' END || string_agg(sid, ',' ORDER BY rank)) AS signature, string_agg(sid, ',' ORDER BY rank) AS ids FROM reps GROUP BY kmeans_cluster, focus)""".replace(", {cent}", "")


@query("j11_representative_worklist", f"""WITH {_REPS} SELECT kmeans_cluster, focus, ids, signature, size, complaints FROM sigs
    JOIN (SELECT kmeans_cluster, count(*) AS size, CAST(count_if(score <= 2) AS BIGINT) AS complaints FROM scored GROUP BY 1) USING (kmeans_cluster)""")
def j11(t):
    d = t.scored.join(t.vectors.select("id", "embedding"), "id")
    w = worklist.insight_worklist(d, "kmeans_cluster", "embedding")
    return w.select("kmeans_cluster", "focus", F.array_join("ids", ",").alias("ids"), "signature", "size",
                    F.col("complaints_1_2_star").alias("complaints"))


@query("c13_changed_clusters", f"""WITH {_REPS} SELECT kmeans_cluster, signature FROM sigs WHERE kmeans_cluster % 2 = 1""")
def c13(t):
    from echofield.sources import tables as src

    d = t.scored.join(t.vectors.select("id", "embedding"), "id")
    current = worklist.insight_worklist(d, "kmeans_cluster", "embedding").select("kmeans_cluster", "signature")
    stale = F.when(F.col("kmeans_cluster") % 2 == 0, F.col("signature")).otherwise("stale")
    return src.changed_keys(current, current.select("kmeans_cluster", stale.alias("signature")), ["kmeans_cluster"])
