"""Calendar series, spikes, drift, history."""

from pyspark.sql import functions as F

from echofield.functions import calendar as cal
from echofield.operators import profile, series
from echofield.plans.registry import query
from echofield.plans.views import REVIEWS

_KEYS = ["o_orderpriority", "o_orderstatus"]
_WEEKLY = """weekly AS (SELECT o_orderpriority, o_orderstatus, date_trunc('week', o_orderdate)::DATE AS week, count(*) AS complaint_count
  FROM orders GROUP BY ALL)"""


def _rolled(lo, hi, src="weekly"):
    return f"""rolled AS (SELECT *, CASE WHEN count(*) OVER w >= 2 THEN round(avg(complaint_count) OVER w, 6) END AS rolling_mean,
      CASE WHEN count(*) OVER w >= 2 THEN round(stddev_samp(complaint_count) OVER w, 6) END AS rolling_std
      FROM {src} WINDOW w AS (PARTITION BY o_orderpriority, o_orderstatus ORDER BY week ROWS BETWEEN {lo} AND {hi})),
    scored AS (SELECT *, round((complaint_count - rolling_mean) / nullif(rolling_std, 0), 6) AS z_score FROM rolled),
    spikes AS (SELECT *, coalesce(z_score > 2.5, false) AS is_spike FROM scored)"""


def _orders(t):
    return t("orders").select(*_KEYS, cal.week_start(F.col("o_orderdate")).alias("week"))


@query("e1_rolling_mean", f"""WITH {_WEEKLY}, {_rolled('3 PRECEDING', 'CURRENT ROW')}
    SELECT o_orderpriority, o_orderstatus, week, complaint_count, rolling_mean FROM rolled""")
def e1(t):
    c = series.bucket_counts(_orders(t), _KEYS, "week")
    return series.rolling(c, _KEYS, "week", "complaint_count", frame="inclusive").drop("rolling_std")


@query("e2_rolling_std", f"""WITH {_WEEKLY}, {_rolled('3 PRECEDING', 'CURRENT ROW')}
    SELECT o_orderpriority, o_orderstatus, week, complaint_count, rolling_std FROM rolled""")
def e2(t):
    c = series.bucket_counts(_orders(t), _KEYS, "week")
    return series.rolling(c, _KEYS, "week", "complaint_count", frame="inclusive").drop("rolling_mean")


@query("e3_spike_flags", f"WITH {_WEEKLY}, {_rolled('4 PRECEDING', '1 PRECEDING')} SELECT * FROM spikes")
def e3(t):
    return series.spike_report(_orders(t), _KEYS, "week", frame="prior")


@query("e3_spike_flags_inclusive", f"WITH {_WEEKLY}, {_rolled('3 PRECEDING', 'CURRENT ROW')} SELECT * FROM spikes")
def e3_inclusive(t):
    return series.spike_report(_orders(t), _KEYS, "week", frame="inclusive")


@query("e3_spike_flags_densified", f"""WITH {_WEEKLY}, span AS (SELECT o_orderpriority, o_orderstatus, min(week) AS lo, max(week) AS hi FROM weekly GROUP BY ALL),
    grid AS (SELECT o_orderpriority, o_orderstatus, unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 7 DAY))::DATE AS week FROM span),
    dense AS (SELECT o_orderpriority, o_orderstatus, week, coalesce(complaint_count, 0) AS complaint_count FROM grid LEFT JOIN weekly USING (o_orderpriority, o_orderstatus, week)),
    {_rolled('4 PRECEDING', '1 PRECEDING', 'dense')} SELECT * FROM spikes""")
def e3_dense(t):
    return series.spike_report(_orders(t), _KEYS, "week", frame="prior", dense_days=7)


# Events carry one vector each by id modulo the vector count; days are the buckets (30 of them).
_DAILY = """ev AS (SELECT e.event_id, ts::DATE AS day, event_type, v.embedding FROM events e
      JOIN embeddings v ON v.vec_id = e.event_id % (SELECT count(*) FROM embeddings)),
    b AS (SELECT day, count(*) AS n FROM ev GROUP BY 1),
    pairs AS (SELECT * FROM (SELECT day, lag(day) OVER (ORDER BY day) AS prev_day, n, lag(n) OVER (ORDER BY day) AS prev_n FROM b) WHERE n >= 5 AND prev_n >= 5),
    cent AS (SELECT day, list(m ORDER BY i) AS c FROM (SELECT day, i, avg(x) AS m FROM (
      SELECT day, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM ev) GROUP BY day, i) GROUP BY day),
    shares AS (SELECT day, event_type, count(*) / sum(count(*)) OVER (PARTITION BY day)::DOUBLE AS share FROM ev GROUP BY day, event_type),
    aligned AS (SELECT coalesce(q.day, p.day) AS day, coalesce(q.event_type, p.event_type) AS event_type, coalesce(p.share, 0) AS p, coalesce(q.share, 0) AS q
      FROM (SELECT pairs.day, event_type, share FROM pairs JOIN shares ON shares.day = pairs.day) q
      FULL JOIN (SELECT pairs.day, event_type, share FROM pairs JOIN shares ON shares.day = prev_day) p ON p.day = q.day AND p.event_type = q.event_type),
    js AS (SELECT day, sum(0.5::DOUBLE * (p * ln((p + 1e-9) / ((p + q) / 2 + 1e-9)) + q * ln((q + 1e-9) / ((p + q) / 2 + 1e-9)))) AS js_divergence FROM aligned GROUP BY day),
    shift AS (SELECT pairs.day, prev_day, list_distance(a.c, b.c) AS centroid_shift FROM pairs JOIN cent a ON a.day = pairs.day JOIN cent b ON b.day = prev_day),
    raw AS (SELECT day, prev_day, round(centroid_shift, 6) AS centroid_shift, round(js_divergence, 6) AS js_divergence FROM shift JOIN js USING (day)),
    z AS (SELECT *, round((centroid_shift - avg(centroid_shift) OVER ()) / (stddev_samp(centroid_shift) OVER () + 1e-9), 4) AS shift_z,
      round((js_divergence - avg(js_divergence) OVER ()) / (stddev_samp(js_divergence) OVER () + 1e-9), 4) AS js_z FROM raw),
    drift AS (SELECT *, coalesce(shift_z > 1.5 OR js_z > 1.5, false) AS is_drift_alert FROM z)"""


def _daily(t):
    emb = t("embeddings")
    e = t("events").select("event_id", F.to_date("ts").alias("day"), "event_type")
    e = e.withColumn("_n", emb.agg(F.count(F.lit(1))).scalar()).withColumn("vec_id", F.col("event_id") % F.col("_n"))
    return e.drop("_n").join(emb.select("vec_id", "embedding"), "vec_id")


@query("c8_previous_bucket_pairs", f"WITH {_DAILY} SELECT day, prev_day, n, prev_n FROM pairs")
def c8(t):
    return series.consecutive(_daily(t), "day")


@query("c9_aligned_shares", f"WITH {_DAILY} SELECT day, event_type, round(p, 6) AS p, round(q, 6) AS q FROM aligned")
def c9(t):
    a = series.aligned_shares(_daily(t), "day", "event_type")
    return a.select("day", "event_type", F.round("p", 6).alias("p"), F.round("q", 6).alias("q"))


@query("e4_report_z_scores", f"WITH {_DAILY} SELECT day, shift_z, js_z FROM drift")
def e4(t):
    return series.drift_report(_daily(t), "day", "event_type", "embedding").select("day", "shift_z", "js_z")


@query("e5_drift_alerts", f"WITH {_DAILY} SELECT * FROM drift")
def e5(t):
    return series.drift_report(_daily(t), "day", "event_type", "embedding")


@query("e6_centroid_shift", f"WITH {_DAILY} SELECT day, prev_day, round(centroid_shift, 6) AS centroid_shift FROM shift")
def e6(t):
    s = series.centroid_shift(_daily(t), "day", "embedding")
    return s.withColumn("centroid_shift", F.round("centroid_shift", 6))


@query("e7_share_divergence", f"WITH {_DAILY} SELECT day, round(js_divergence, 6) AS js_divergence FROM js")
def e7(t):
    s = series.share_divergence(_daily(t), "day", "event_type")
    return s.withColumn("js_divergence", F.round("js_divergence", 6))


@query("d16_drift_summary", f"""WITH {_DAILY}, s AS (SELECT count(*)::DOUBLE AS weeks_evaluated, count_if(is_drift_alert)::DOUBLE AS drift_alert_weeks,
      avg(is_drift_alert::INT) AS alert_rate, avg(centroid_shift) AS mean_centroid_shift, stddev_samp(centroid_shift) AS std_centroid_shift,
      avg(js_divergence) AS mean_js_divergence, max(js_divergence) AS max_js_divergence, max(shift_z) AS max_shift_z, max(js_z) AS max_js_z FROM drift)
    SELECT metric, round(value, 6) AS value, CASE WHEN metric IN ('weeks_evaluated', 'drift_alert_weeks') THEN 'count'
      WHEN metric = 'alert_rate' THEN 'rate' ELSE 'numeric' END AS kind
    FROM (UNPIVOT s ON COLUMNS(*) INTO NAME metric VALUE value)""")
def d16(t):
    return series.drift_summary(series.drift_report(_daily(t), "day", "event_type", "embedding"))


@query("f4_drift_table_order", f"WITH {_DAILY} SELECT * FROM drift ORDER BY is_drift_alert DESC, day DESC")
def f4(t):
    r = series.drift_report(_daily(t), "day", "event_type", "embedding")
    return r.orderBy(F.desc("is_drift_alert"), F.desc("day"))


@query("e8_calendar_buckets", """SELECT o_orderkey, strftime(date_trunc('week', o_orderdate), '%Y-%m-%d') || '/' ||
      strftime(date_trunc('week', o_orderdate) + INTERVAL 6 DAY, '%Y-%m-%d') AS week, strftime(o_orderdate, '%Y-%m') AS year_month FROM orders""")
def e8(t):
    at = F.col("o_orderdate")
    return t("orders").select("o_orderkey", cal.week_label(at).alias("week"), cal.month_label(at).alias("year_month"))


@query("e9_cumulative_variance", """WITH v AS (SELECT i - 1 AS component, var_samp(x) AS v FROM (
      SELECT unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1)::INTEGER AS i FROM embeddings) GROUP BY i),
    s AS (SELECT component, v / (SELECT sum(v) FROM v) AS explained FROM v)
    SELECT component, round(explained, 6) AS explained, round(sum(explained) OVER (ORDER BY component), 6) AS cumulative FROM s""")
def e9(t):
    x = t("embeddings").select(F.posexplode("embedding").alias("component", "x"))
    v = x.groupBy("component").agg(F.var_samp(F.col("x").cast("double")).alias("v"))
    v = v.withColumn("_t", v.agg(F.sum("v")).scalar()).select("component", (F.col("v") / F.col("_t")).alias("explained"))
    return series.cumulative_share(v, "component", "explained").select(
        "component", F.round("explained", 6).alias("explained"), F.round("cumulative", 6).alias("cumulative")
    )


@query("e11_history_window", r"""WITH p AS (SELECT conv_id, turn // 2 AS pair, max(CASE WHEN turn % 2 = 0 THEN text END) AS q,
      max(CASE WHEN turn % 2 = 1 THEN text END) AS a FROM conversations GROUP BY ALL)
    SELECT conv_id, pair, coalesce(string_agg('Q: ' || coalesce(q, '') || chr(10) || 'A: ' || substr(coalesce(a, ''), 1, 300), chr(10))
      OVER (PARTITION BY conv_id ORDER BY pair ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), '') AS history FROM p""")
def e11(t):
    c = t("conversations")
    pairs = c.groupBy("conv_id", F.expr("turn div 2").alias("pair")).agg(
        F.coalesce(F.max(F.when(F.col("turn") % 2 == 0, F.col("text"))), F.lit("")).alias("q"),
        F.coalesce(F.max(F.when(F.col("turn") % 2 == 1, F.col("text"))), F.lit("")).alias("a"),
    )
    return series.history_text(pairs, "conv_id", "pair", "q", "a").select("conv_id", "pair", "history")
