"""Filters, coercions, projections."""

from pyspark.sql import functions as F

from echofield.functions import vectors as vx
from echofield.operators import order, rows
from echofield.plans.registry import query
from echofield.plans.views import CLEANED, REVIEWS, SCORED, VECTORS


@query("b1_min_length", f"WITH {REVIEWS} SELECT id, length(content) AS n FROM reviews WHERE length(content) >= 10")
def b1(t):
    return rows.min_length(t.reviews, "content", 10).select("id", F.length("content").cast("long").alias("n"))


@query(
    "b2_coercion",
    """SELECT event_id, TRY_CAST(nullif(regexp_extract(props, '"k": ([0-9]+)', 1), '7') AS DOUBLE) AS k_num,
              TRY_CAST(event_type AS DOUBLE) AS type_num FROM events""",
)
def b2(t):
    raw = F.regexp_extract("props", '"k": ([0-9]+)', 1)
    return t("events").select(
        "event_id",
        rows.to_number(F.when(raw != "7", raw)).alias("k_num"),
        rows.to_number(F.col("event_type")).alias("type_num"),
    )


@query(
    "b3_dense_row_id",
    f"""WITH {REVIEWS} SELECT id, row_number() OVER (ORDER BY id) - 1 AS row_id
        FROM reviews WHERE length(content) >= 10""",
)
def b3(t):
    return order.dense_ids(rows.min_length(t.reviews.select("id", "content"), "content", 10), "id").select(
        "id", "row_id"
    )


@query("b4_projection", f"WITH {SCORED} SELECT id, review_id, platform, source_lang, score FROM (SELECT *, lang AS source_lang FROM scored)")
def b4(t):
    df = t.scored.withColumnRenamed("lang", "source_lang")
    return rows.project(df, ["id", "review_id", "platform", "source_lang", "missing_column", "score"])


@query(
    "b5_set_filter",
    f"""WITH {CLEANED} SELECT id, platform, star_bucket FROM cleaned
        WHERE platform IN ('src1', 'src5', 'src9') AND star_bucket IN ('complaint', 'mixed')""",
)
def b5(t):
    return t.cleaned.filter(
        rows.in_set(F.col("platform"), ["src1", "src5", "src9"])
        & rows.in_set(F.col("star_bucket"), ["complaint", "mixed"])
    ).select("id", "platform", "star_bucket")


@query(
    "b6_date_range",
    """SELECT event_id, user_id FROM events
       WHERE ts >= TIMESTAMP '2024-01-03' AND ts <= TIMESTAMP '2024-01-06 23:59:59.999999'""",
)
def b6(t):
    return rows.date_range(t("events"), "ts", "2024-01-03", "2024-01-06").select("event_id", "user_id")


@query(
    "b7_filter_builder",
    f"""WITH {SCORED} SELECT sid, platform, severity FROM scored
        WHERE platform IN ('src2', 'src4') AND severity IN ('AMBER', 'RED') AND isolation_anomaly""",
)
def b7(t):
    want = rows.metadata_filter(platform=["src2", "src4"], severity=["AMBER", "RED"], anomaly_only=True)
    return rows.candidate_mask(t.scored, want).select("sid", "platform", "severity")


@query(
    "b8_candidate_mask",
    f"""WITH {SCORED} SELECT sid, platform, route_category FROM scored
        WHERE platform = 'src3' AND route_category IN ('error', 'click')""",
)
def b8(t):
    want = rows.metadata_filter(platform="src3", routing_team=["error", "click"])
    want["severity"] = ["RED", "AMBER", "GREEN"]
    return rows.candidate_mask(t.scored, want).select("sid", "platform", "route_category")


@query(
    "b9_threshold_filters",
    f"""WITH {SCORED} SELECT id, severity_score_ml, score FROM scored
        WHERE severity_score_ml >= 0.8 AND score <= 2""",
)
def b9(t):
    return t.scored.filter((F.col("severity_score_ml") >= 0.8) & (F.col("score") <= 2)).select(
        "id", "severity_score_ml", "score"
    )


@query(
    "b10_trailing_window",
    """SELECT event_id, user_id FROM events WHERE event_type = 'error'
       AND ts >= (SELECT max(ts) FROM events WHERE event_type = 'error') - INTERVAL 7 DAY""",
)
def b10(t):
    df = t("events").withColumnRenamed("event_type", "platform")
    return rows.trailing_days(df, "ts", 7, "error").select("event_id", "user_id")


@query(
    "b11_name_contains",
    f"""WITH {SCORED} SELECT id, coalesce(contains(lower(cluster_name), 'positive'), false) AS is_positive
        FROM scored""",
)
def b11(t):
    return t.scored.select("id", rows.name_contains(F.col("cluster_name"), "Positive").alias("is_positive"))


@query(
    "b12_drop_nulls",
    f"WITH {SCORED} SELECT id, score, route_category FROM scored WHERE score IS NOT NULL AND route_category IS NOT NULL",
)
def b12(t):
    return t.scored.select("id", "score", "route_category").dropna(subset=["score", "route_category"])


@query(
    "b13_category_order",
    f"""WITH {SCORED} SELECT churn_risk_label, category_order, count(*) AS n FROM (
          SELECT churn_risk_label, CASE churn_risk_label WHEN 'Low' THEN 1 WHEN 'High' THEN 3 END AS category_order
          FROM scored WHERE churn_risk_label IN ('Low', 'High')) GROUP BY ALL""",
)
def b13(t):
    kept = rows.known_categories(t.scored.select("churn_risk_label"), "churn_risk_label", ["Low", "Unseen", "High"])
    return kept.groupBy("churn_risk_label", "category_order").agg(F.count(F.lit(1)).alias("n"))


@query(
    "b14_keyword_filter",
    f"""WITH {SCORED} SELECT sid FROM scored
        WHERE platform = 'src6' AND regexp_matches(content, '(?i)stupid|trash|clown')""",
)
def b14(t):
    inside = rows.candidate_mask(t.scored, rows.metadata_filter(platform="src6"))
    return inside.filter(rows.keyword_match(F.col("content"), "stupid|trash|clown")).select("sid")


_CENTROIDS = """cents AS (
  SELECT label, list(m ORDER BY i) AS c FROM (
    SELECT label, i, avg(x) AS m FROM (
      SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)
    GROUP BY label, i) GROUP BY label)"""


@query(
    "b15_low_distance_rows",
    f"""WITH {_CENTROIDS}, d AS (
          SELECT vec_id, round(list_distance(embedding::DOUBLE[], c), 6) AS dist
          FROM embeddings JOIN cents USING (label))
        SELECT vec_id, dist FROM d WHERE dist <= (SELECT quantile_cont(dist, 0.4) FROM d)""",
)
def b15(t):
    from echofield.operators import groups

    d = groups.centroid_distance(t("embeddings"), "label", "embedding").select(
        "vec_id", F.round("dist", 6).alias("dist")
    )
    limit = order.quantiles(d, "dist", {"limit": 0.4}).select("limit")
    return d.withColumn("_limit", limit.scalar()).filter(F.col("dist") <= F.col("_limit")).select("vec_id", "dist")


@query(
    "b16_fallback_chain",
    f"""WITH {SCORED} SELECT id, coalesce(route_category, cluster_name, 'General') AS topic,
          coalesce(score, 3) AS score, coalesce(review_length, 0) AS review_length FROM scored""",
)
def b16(t):
    df = t.scored
    return df.select(
        "id",
        rows.first_present(df, ["route_category", "cluster_name"], "General").alias("topic"),
        rows.first_present(df, ["score"], 3.0).alias("score"),
        rows.first_present(df, ["review_length"], 0).alias("review_length"),
    )
