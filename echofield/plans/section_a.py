"""Sources, sinks, catalog, registry."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from echofield.functions import text as tx
from echofield.plans.registry import query
from echofield.plans.views import REVIEWS, SCORED
from echofield.sources import tables as src


@query("a1_ingest_newest", f"""WITH {REVIEWS}, r AS (SELECT review_id, platform, 'store' AS source, lang, trim(coalesce(content, '')) AS content,
      score, coalesce(thumbs_up, 0) AS thumbs_up, row_number() OVER (PARTITION BY platform, lang ORDER BY "at" DESC, review_id)::INTEGER AS newest_rank FROM reviews)
    SELECT * FROM r WHERE newest_rank <= 500""")
def a1(t):
    return src.ingest(t.reviews, 500).drop("at")


_CSV = T.StructType([T.StructField("id", T.LongType()), T.StructField("content", T.StringType()),
                     T.StructField("score", T.DoubleType()), T.StructField("topic", T.StringType())])


@query("a2_csv_read", f"WITH {REVIEWS} SELECT id, content, score, topic FROM reviews")
def a2(t):
    path = src.shared_folder(t.spark, "csv")
    src.write_csv(t.reviews.select("id", "content", "score", "topic"), path)
    return src.read_csv(t.spark, path, _CSV)


@query("a3_csv_write", f"WITH {REVIEWS} SELECT platform, count(*) AS n, sum(length(content))::BIGINT AS chars FROM reviews GROUP BY 1")
def a3(t):
    path = src.shared_folder(t.spark, "csv")
    src.write_csv(t.reviews.select("platform", "content"), path)
    back = src.read_csv(t.spark, path, T.StructType([_CSV["content"], T.StructField("platform", T.StringType())]))
    return back.groupBy("platform").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("content")).alias("chars"))


@query("a4_vector_table", "SELECT vec_id, CAST(len(embedding) AS INTEGER) AS width, embedding[1]::DOUBLE AS first FROM embeddings")
def a4(t):
    path = src.shared_folder(t.spark, "vectors")
    src.write_parquet(t("embeddings").select("vec_id", "embedding"), path)
    back = t.spark.read.parquet(path)
    return back.select("vec_id", F.size("embedding").alias("width"), F.col("embedding")[0].cast("double").alias("first"))


@query("a6_json_files", """SELECT user_id, count(*) AS n, sum(CAST(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS k_total FROM events GROUP BY 1""")
def a6(t):
    path = src.shared_folder(t.spark, "json")
    src.write_json(t("events").select("user_id", F.from_json("props", "k bigint").alias("props")), path)
    schema = T.StructType.fromDDL("user_id bigint, props struct<k: bigint>")
    back = src.read_json(t.spark, path, schema, multiline=False)
    return back.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("props.k").alias("k_total"))


@query("a7_first_existing_table", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def a7(t):
    names = ["events_scored", "events_routed", "events", "documents"]
    path = src.first_existing(t.spark, [f"{t.folder}/{n}.parquet" for n in names])
    return t.spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def _part(c: str) -> str:
    v = f"{c}::VARCHAR"
    return f"'{len(c)}:{c}=' || coalesce(length({v}) || ':' || {v}, '~')"


@query("a8_fingerprint", f"""WITH h AS (SELECT md5(concat_ws('|', {', '.join(_part(c) for c in ('event_id', 'user_id', 'event_type', 'props'))})) AS h FROM events)
    SELECT count(*) AS n_rows, sum(('0x' || substr(h, 1, 8))::BIGINT)::BIGINT AS hash_sum, bit_xor(('0x' || substr(h, 9, 15))::BIGINT) AS hash_xor FROM h""")
def a8(t):
    return src.fingerprint(t("events"), ["event_id", "user_id", "event_type", "props"])


@query("a9_alignment_check", """SELECT (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS left_only,
    (SELECT count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)) AS right_only,
    (SELECT count(*) FROM documents JOIN labels USING (doc_id)) AS matched""")
def a9(t):
    return src.alignment(t("documents"), t("labels"), "doc_id")


@query("a10_search_corpus", f"""WITH {SCORED} SELECT sid, review_id, platform, score AS rating, strftime("at", '%Y-%m-%d') AS date, kmeans_cluster, cluster_name,
    hdbscan_cluster, severity, CASE severity_label_weak WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' ELSE 'High' END AS severity_ml,
    coalesce(isolation_anomaly, false) AS is_anomaly, route_category AS routing_team, lang, content FROM scored""")
def a10(t):
    from echofield import fixed

    named = src.lookup(t.scored, "severity_label_weak", fixed.SEVERITY_NAMES, "severity_label_ml", F.lit("High"))
    return src.corpus(named)


@query("a11_id_map", f"WITH {SCORED} SELECT sid, review_id FROM scored")
def a11(t):
    return src.id_map(t.scored)


_LOG = """log AS (SELECT event_type AS task, 'model-' || user_id AS model, value AS primary_metric, event_id AS run_ts, '{"source":"' || event_type || '"}' AS extra FROM events),
    latest AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY task ORDER BY run_ts DESC, model DESC) = 1)"""


@query("a12_model_registry", f"""WITH {_LOG} SELECT * FROM latest WHERE task <> 'click'
    UNION ALL SELECT 'click', 'model-new', 1.0::DOUBLE, 9223372036854775807, '{{}}'""")
def a12(t):
    log = t("events").select(
        F.col("event_type").alias("task"), F.concat(F.lit("model-"), F.col("user_id").cast("string")).alias("model"),
        F.col("value").alias("primary_metric"), F.col("event_id").alias("run_ts"),
        F.to_json(F.create_map(F.lit("source"), F.col("event_type"))).alias("extra"),
    )
    latest = src.latest_models(log)
    new = latest.filter(F.col("task") == "click").select(
        "task", F.lit("model-new").alias("model"), F.lit(1.0).alias("primary_metric"), F.lit(9223372036854775807).alias("run_ts"),
        F.lit("{}").alias("extra"),
    )
    return src.upsert_models(latest, new)
