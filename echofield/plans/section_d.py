"""Counts, cross-tabs, summaries, facts."""

from pyspark.sql import functions as F

from echofield.functions import text as tx
from echofield.operators import groups, order, profile
from echofield.plans.registry import query
from echofield.plans.views import CLEANED, REVIEWS, SCORED, VECTORS


@query("d1_weekly_counts", f"""WITH {SCORED} SELECT platform, cluster_name, week, count(*) AS complaint_count
    FROM scored GROUP BY ALL""")
def d1(t):
    return profile.group_counts(t.scored, ["platform", "cluster_name", "week"], "complaint_count")


@query("d2_kpi_row", f"""WITH {SCORED} SELECT count(*) AS total_reviews, count(DISTINCT platform) AS platforms,
    CAST(count_if(tier1_critical) AS BIGINT) AS tier1_alerts,
    (SELECT cluster_name FROM scored GROUP BY 1 ORDER BY count(*) DESC, cluster_name LIMIT 1) AS top_cluster FROM scored""")
def d2(t):
    return profile.kpi_row(t.scored)


@query("d3_platform_cluster_volume", f"WITH {SCORED} SELECT platform, cluster_name, count(*) AS n FROM scored GROUP BY ALL")
def d3(t):
    return profile.group_counts(t.scored, ["platform", "cluster_name"])


_STARS = ", ".join(
    f"CAST(count_if(greatest(1, least(5, CAST(score AS INTEGER))) = {s}) AS BIGINT) AS star_{s}" for s in range(1, 6)
)


@query("d4_platform_star_crosstab", f"WITH {REVIEWS} SELECT platform, {_STARS} FROM reviews WHERE score IS NOT NULL GROUP BY platform")
def d4(t):
    return profile.star_crosstab(t.reviews)


@query("d5_row_share_crosstab", f"""WITH {SCORED}, c AS (SELECT platform, kmeans_cluster, count(*) AS n FROM scored GROUP BY ALL)
    SELECT platform, kmeans_cluster, n, round(n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY platform), 4) AS pct FROM c""")
def d5(t):
    return profile.row_shares(t.scored, "platform", "kmeans_cluster")


@query("d6_mean_length_interval", f"""WITH {SCORED}, g AS (
      SELECT cluster_name, avg(review_length) AS m, stddev_samp(review_length) AS s, count(*) AS n FROM scored GROUP BY 1)
    SELECT cluster_name, n, round(m, 6) AS mean, round(m - 1.96::DOUBLE * s / sqrt(n), 6) AS low,
           round(m + 1.96::DOUBLE * s / sqrt(n), 6) AS high FROM g""")
def d6(t):
    return profile.mean_with_interval(t.scored, "cluster_name", "review_length").orderBy(F.desc("mean"))


@query("d7_histogram", """WITH s AS (SELECT min(value) AS lo, max(value) AS hi FROM events)
    SELECT event_type, CAST(least(floor((value - lo) / ((hi - lo) / 40)), 39) AS INTEGER) AS bin, count(*) AS n
    FROM events, s GROUP BY ALL""")
def d7_histogram(t):
    return profile.histogram(t("events"), "value", "event_type")


@query("d7_five_number_summary", """WITH q AS (
      SELECT event_type, count(value) AS n, quantile_cont(value, [0.0, 0.25, 0.5, 0.75, 1.0]) AS q FROM events GROUP BY 1)
    SELECT event_type, n, round(q[1], 6) AS minimum, round(q[2], 6) AS q1, round(q[3], 6) AS median, round(q[4], 6) AS q3,
      round(q[5], 6) AS maximum,
      round(round(q[2], 6) - 1.5::DOUBLE * (round(q[4], 6) - round(q[2], 6)), 6) AS low_fence,
      round(round(q[4], 6) + 1.5::DOUBLE * (round(q[4], 6) - round(q[2], 6)), 6) AS high_fence FROM q""")
def d7_five(t):
    return profile.five_numbers(t("events"), "value", "event_type")


@query("d7_density", """WITH s AS (SELECT o_orderstatus AS g, count(*) AS n, stddev_samp(o_totalprice) AS sd,
      min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders GROUP BY 1),
    b AS (SELECT *, sd * pow(n, -0.2::DOUBLE) AS h FROM s),
    p AS (SELECT *, unnest(range(200))::INTEGER AS point FROM b),
    x AS (SELECT *, lo - 3 * h + ((hi + 3 * h) - (lo - 3 * h)) * point / 199 AS x FROM p)
    SELECT g AS o_orderstatus, point, round(first(x), 6) AS x,
      round(sum(exp(-0.5::DOUBLE * pow((x - o_totalprice) / h, 2)) / (sqrt(2.0::DOUBLE * pi()) * h * n)), 9) AS density
    FROM x JOIN orders ON o_orderstatus = g GROUP BY g, point""")
def d7_density(t):
    return profile.density(t("orders"), "o_totalprice", "o_orderstatus", digits=9)


_NULLS = " UNION ALL ".join(
    f"SELECT 'nulls' AS section, '{c}' AS key, CAST(count_if({c} IS NULL) AS DOUBLE) AS value FROM scored"
    for c in ("score", "route_category", "platform", "content")
)
_COUNTS = " UNION ALL ".join(
    f"SELECT '{c}' AS section, {c} AS key, CAST(count(*) AS DOUBLE) AS value FROM scored GROUP BY {c}"
    for c in ("platform", "lang", "star_bucket")
)


@query("d8_quality_report", f"""WITH {SCORED}, l AS (SELECT CAST(review_length AS DOUBLE) AS x FROM scored),
    d AS (SELECT count(x)::DOUBLE AS "count", avg(x) AS mean, stddev_samp(x) AS std, min(x) AS "min", max(x) AS "max",
      quantile_cont(x, 0.25) AS p25, quantile_cont(x, 0.5) AS p50, quantile_cont(x, 0.75) AS p75 FROM l)
    SELECT 'rows' AS section, 'total' AS key, CAST(count(*) AS DOUBLE) AS value FROM scored
    UNION ALL SELECT * FROM ({_NULLS}) WHERE value > 0
    UNION ALL SELECT 'review_length', key, round(value, 6) FROM (UNPIVOT d ON "count", mean, std, "min", "max", p25, p50, p75 INTO NAME key VALUE value)
    UNION ALL {_COUNTS}""")
def d8(t):
    return profile.quality_report(
        t.scored, ["score", "route_category", "platform", "content"], ["platform", "lang", "star_bucket"], "review_length"
    )


@query("d9_value_counts", f"""WITH {REVIEWS} SELECT topic AS value, count(*) AS n,
    round(count(*) / (SELECT count(*) FROM reviews)::DOUBLE, 6) AS share FROM reviews GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 4""")
def d9(t):
    return profile.value_counts(t.reviews, "topic", 4)


_TOP3 = """SELECT kmeans_cluster, string_agg(platform || ':' || n, ',' ORDER BY r) AS top_platforms FROM (
    SELECT *, row_number() OVER (PARTITION BY kmeans_cluster ORDER BY n DESC, platform) AS r FROM (
      SELECT kmeans_cluster, platform, count(*) AS n FROM scored GROUP BY ALL)) WHERE r <= 3 GROUP BY 1"""
_TEAM = """SELECT kmeans_cluster, route_category AS top_routing_team FROM (
    SELECT *, row_number() OVER (PARTITION BY kmeans_cluster ORDER BY n DESC, route_category) AS r FROM (
      SELECT kmeans_cluster, route_category, count(*) AS n FROM scored WHERE route_category IS NOT NULL GROUP BY ALL)) WHERE r = 1"""


@query("d11_cluster_stats", f"""WITH {SCORED}, b AS (SELECT kmeans_cluster, count(*) AS size, round(avg(score), 2) AS avg_rating,
      CAST(count_if(isolation_anomaly) AS BIGINT) AS anomalies, CAST(count_if(severity = 'RED') AS BIGINT) AS red_severity,
      CAST(count_if(score <= 2) AS BIGINT) AS complaints_1_2_star,
      round(100 * count(*) / (SELECT count(*) FROM scored)::DOUBLE, 1) AS share_pct FROM scored GROUP BY 1)
    SELECT * FROM b LEFT JOIN ({_TOP3}) USING (kmeans_cluster) LEFT JOIN ({_TEAM}) USING (kmeans_cluster)""")
def d11(t):
    pairs = F.transform(F.map_entries("top_platforms"), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string")))
    return profile.cluster_stats(t.scored).withColumn("top_platforms", F.array_join(pairs, ","))


@query("d12_report_facts", f"""WITH {SCORED}, h AS (SELECT count(*)::DOUBLE AS total_reviews, round(avg(score), 2) AS avg_rating,
      round(100 * avg(CASE WHEN score <= 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 1) AS pct_1_or_2_star,
      count_if(isolation_anomaly)::DOUBLE AS critical_anomalies FROM scored),
    th AS (SELECT kmeans_cluster::VARCHAR AS c, count(*)::DOUBLE AS reviews,
      round(100 * count(*) / (SELECT count(*) FROM scored)::DOUBLE, 1) AS share_pct, round(avg(score), 2) AS avg_rating,
      count_if(isolation_anomaly)::DOUBLE AS anomalies FROM scored GROUP BY 1)
    SELECT 'head' AS section, key, value FROM (UNPIVOT h ON total_reviews, avg_rating, pct_1_or_2_star, critical_anomalies INTO NAME key VALUE value)
    UNION ALL SELECT 'severity', severity, count(*)::DOUBLE FROM scored GROUP BY severity
    UNION ALL SELECT 'platform', platform, count(*)::DOUBLE FROM scored GROUP BY platform
    UNION ALL SELECT 'routing_team', route_category, count(*)::DOUBLE FROM scored WHERE route_category IS NOT NULL GROUP BY route_category
    UNION ALL SELECT 'theme', c || '/' || key, value FROM (UNPIVOT th ON reviews, share_pct, avg_rating, anomalies INTO NAME key VALUE value)""")
def d12(t):
    return profile.report_facts(t.scored)


@query("d13_group_mean_vector", """SELECT label, i - 1 AS pos, round(avg(x), 6) AS mean FROM (
      SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1)::INTEGER AS i FROM embeddings) GROUP BY label, i""")
def d13(t):
    c = groups.centroids(t("embeddings"), "label", "embedding")
    return c.select("label", F.posexplode("centroid").alias("pos", "x")).select("label", "pos", F.round("x", 6).alias("mean"))


@query("d14_mean_pair_cosine", f"""WITH {CLEANED}, {VECTORS}, s AS (
      SELECT star_bucket, id, embedding::DOUBLE[] AS v, row_number() OVER (PARTITION BY star_bucket ORDER BY id) AS r
      FROM cleaned JOIN vectors USING (id)), f AS (SELECT * FROM s WHERE star_bucket IN (SELECT star_bucket FROM s GROUP BY 1 HAVING count(*) >= 5))
    SELECT a.star_bucket AS "left", b.star_bucket AS "right", round(avg(list_cosine_similarity(a.v, b.v)), 6) AS mean_cosine
    FROM f a JOIN f b ON a.star_bucket <= b.star_bucket GROUP BY ALL""")
def d14(t):
    return profile.mean_pair_cosine(t.cleaned.select("id", "star_bucket").join(t.vectors, "id"), "star_bucket", "embedding")


@query("d17_quantile_threshold", f"""WITH {CLEANED} SELECT quantile_cont(review_length, 0.8)::DOUBLE AS p80,
    quantile_cont(review_length, 0.4)::DOUBLE AS p40 FROM cleaned""")
def d17(t):
    return order.quantiles(t.cleaned.select("review_length"), "review_length", {"p80": 0.8, "p40": 0.4}).drop("_total")


@query("d18_latency_summary", """WITH s AS (SELECT event_type, list(value ORDER BY value) AS xs, avg(value) AS m FROM events GROUP BY 1)
    SELECT event_type, round(m, 3) AS mean, xs[CAST(round_even(0.5 * (len(xs) - 1), 0) AS BIGINT) + 1] AS p50,
      xs[CAST(round_even(0.95 * (len(xs) - 1), 0) AS BIGINT) + 1] AS p95 FROM s""")
def d18(t):
    e = t("events").select("event_type", "value")
    ranks = order.nearest_rank(e, "value", {"p50": 50, "p95": 95}, ["event_type"]).drop("_total")
    return e.groupBy("event_type").agg(F.round(F.avg("value"), 3).alias("mean")).join(ranks, "event_type")


@query("d22_first_seen_index", """SELECT event_type, row_number() OVER (ORDER BY m) - 1 AS label_index FROM (
    SELECT event_type, min(event_id) AS m FROM events GROUP BY 1)""")
def d22(t):
    return profile.first_seen_index(t("events"), "event_type", "event_id").withColumn("label_index", F.col("label_index").cast("long"))


@query("d23_group_mode", f"""WITH {SCORED} SELECT platform, route_category AS mode FROM (SELECT *, row_number() OVER (
      PARTITION BY platform ORDER BY n DESC, route_category) AS r FROM (SELECT platform, route_category, count(*) AS n FROM scored
      WHERE route_category IS NOT NULL GROUP BY ALL)) WHERE r = 1""")
def d23(t):
    return profile.group_mode(t.scored, "platform", "route_category")


@query("d24_filter_domains", f"""WITH {CLEANED} SELECT DISTINCT 'platform' AS domain, platform AS value FROM cleaned
    UNION ALL SELECT DISTINCT 'star_bucket', star_bucket FROM cleaned
    UNION ALL SELECT 'date_from', strftime(min("at"), '%Y-%m-%d') FROM cleaned
    UNION ALL SELECT 'date_to', strftime(max("at"), '%Y-%m-%d') FROM cleaned""")
def d24(t):
    return profile.filter_domains(t.cleaned)


@query("d25_mean_weekly_by_cluster", """WITH c AS (SELECT o_orderpriority, o_orderstatus, date_trunc('month', o_orderdate)::DATE AS month, count(*) AS n
      FROM orders GROUP BY ALL), k AS (SELECT o_orderpriority FROM c GROUP BY 1 ORDER BY sum(n) DESC, 1 LIMIT 3)
    SELECT month, o_orderpriority, round(avg(n), 6) AS mean_count FROM c WHERE o_orderpriority IN (SELECT * FROM k) GROUP BY ALL""")
def d25(t):
    from echofield.functions import calendar as cal

    o = t("orders").select("o_orderpriority", "o_orderstatus", cal.bucket_start(F.col("o_orderdate"), "month").alias("month"))
    counts = profile.group_counts(o, ["o_orderpriority", "o_orderstatus", "month"])
    return profile.mean_bucket_counts(counts, "o_orderpriority", "month", top=3)
