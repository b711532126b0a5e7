"""Classification metrics and splits."""

from pyspark.sql import functions as F

from echofield.operators import metrics as mt
from echofield.plans.registry import query
from echofield.plans.views import SCORED
from echofield.sources.tables import written

# Three-class truth and prediction plus a probability vector, all from review attributes.
_MULTI = SCORED + """, multi AS (SELECT id, platform, severity_label_weak AS truth,
      CASE churn_risk_label WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 ELSE 2 END AS pred,
      [(thumbs_up + 1) / (thumbs_up + user_id % 10 + id % 7 + 3)::DOUBLE, (user_id % 10 + 1) / (thumbs_up + user_id % 10 + id % 7 + 3)::DOUBLE,
       (id % 7 + 1) / (thumbs_up + user_id % 10 + id % 7 + 3)::DOUBLE] AS probs FROM scored),
    cells AS (SELECT truth, pred, count(*) AS n FROM multi GROUP BY ALL),
    labels2 AS (SELECT truth AS l FROM multi UNION SELECT pred FROM multi),
    conf AS (SELECT a.l AS truth, b.l AS pred, coalesce(n, 0) AS n FROM labels2 a CROSS JOIN labels2 b LEFT JOIN cells ON truth = a.l AND pred = b.l),
    per AS (SELECT l AS class, (SELECT sum(n) FROM conf WHERE truth = l)::BIGINT AS support, (SELECT sum(n) FROM conf WHERE pred = l)::BIGINT AS predicted,
      (SELECT sum(n) FROM conf WHERE truth = l AND pred = l)::BIGINT AS tp FROM labels2),
    cls AS (SELECT *, coalesce(tp / nullif(predicted, 0)::DOUBLE, 0) AS precision, coalesce(tp / nullif(support, 0)::DOUBLE, 0) AS recall,
      coalesce(2 * tp / nullif(predicted + support, 0)::DOUBLE, 0) AS f1 FROM per)"""


def _multi(t):
    total = (F.col("thumbs_up") + F.col("user_id") % 10 + F.col("id") % 7 + 3).cast("double")
    parts = [F.col("thumbs_up") + 1, F.col("user_id") % 10 + 1, F.col("id") % 7 + 1]
    return t.scored.select(
        "id", "platform", F.col("severity_label_weak").alias("truth"),
        F.when(F.col("churn_risk_label") == "Low", 0).when(F.col("churn_risk_label") == "Medium", 1).otherwise(2).alias("pred"),
        F.array(*[p / total for p in parts]).alias("probs"),
    )


_BIN = """b AS (SELECT doc_id, toxic AS truth, CASE WHEN value > 45 THEN 1 ELSE 0 END AS pred, round(value / 500, 2) AS score
    FROM labels JOIN events ON event_id = doc_id)"""


def _bin(t):
    e = t("events").select(F.col("event_id").alias("doc_id"), "value")
    return t("labels").join(e, "doc_id").select(
        "doc_id", F.col("toxic").alias("truth"), F.when(F.col("value") > 45, 1).otherwise(0).alias("pred"),
        F.round(F.col("value") / 500, 2).alias("score"),
    )


@query("m1_confusion_matrix", f"WITH {_MULTI} SELECT truth, pred, n FROM conf")
def m1(t):
    return mt.confusion(_multi(t), "truth", "pred")


@query("m2_per_class", f"WITH {_MULTI} SELECT class, support, predicted, tp, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM cls")
def m2(t):
    c = mt.per_class(mt.confusion(_multi(t), "truth", "pred"))
    return c.select("class", "support", "predicted", "tp", *[F.round(x, 6).alias(x) for x in ("precision", "recall", "f1")])


@query("m3_summary", f"""WITH {_MULTI} SELECT round(sum(tp) / sum(support)::DOUBLE, 6) AS accuracy, round(avg(recall) FILTER (support > 0), 6) AS balanced_accuracy,
    round(avg(precision), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall, round(avg(f1), 6) AS macro_f1,
    round(sum(precision * support) / sum(support), 6) AS weighted_precision, round(sum(recall * support) / sum(support), 6) AS weighted_recall,
    round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM cls""")
def m3(t):
    return mt.summary(mt.per_class(mt.confusion(_multi(t), "truth", "pred")))


@query("m4_agreement", f"""WITH {_MULTI}, s AS (SELECT sum(support)::DOUBLE AS n, sum(tp)::DOUBLE AS c, sum(support * predicted)::DOUBLE AS tp_pp,
      sum(support * support)::DOUBLE AS tt, sum(predicted * predicted)::DOUBLE AS pp FROM cls)
    SELECT round((c / n - tp_pp / (n * n)) / (1 - tp_pp / (n * n)), 6) AS kappa, round((c * n - tp_pp) / sqrt((n * n - pp) * (n * n - tt)), 6) AS matthews_corrcoef FROM s""")
def m4(t):
    return mt.agreement(mt.per_class(mt.confusion(_multi(t), "truth", "pred")))


@query("m5_ovr_roc_auc", f"""WITH {_MULTI}, l AS (SELECT i - 1 AS c, probs[i] AS p, (truth = i - 1)::INT AS y FROM multi, (SELECT unnest([1, 2, 3]) AS i)),
    r AS (SELECT *, rank() OVER (PARTITION BY c ORDER BY p) + (count(*) OVER (PARTITION BY c, p) - 1) / 2.0::DOUBLE AS r FROM l),
    a AS (SELECT c, sum(y) AS p, (sum(r * y) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y)))::DOUBLE AS auc FROM r GROUP BY 1)
    SELECT round(sum(auc * p) / sum(p), 6) AS roc_auc_ovr FROM a""")
def m5(t):
    return mt.ovr_roc_auc(_multi(t), "truth", "probs")


@query("m6_probability_losses", f"""WITH {_MULTI}, l AS (SELECT id, truth, i - 1 AS c, probs[i] AS p FROM multi, (SELECT unnest([1, 2, 3]) AS i))
    SELECT round(avg(pow((truth = c)::INT - p, 2)), 6) AS brier_like, round(avg(-ln(p)) FILTER (truth = c), 6) AS log_loss FROM l""")
def m6(t):
    return mt.probability_losses(_multi(t), "truth", "probs")


@query("m7_binary_metrics", f"""WITH {_BIN}, s AS (SELECT count_if(truth = 1 AND pred = 1)::DOUBLE AS tp, count_if(truth = 0 AND pred = 1)::DOUBLE AS fp,
      count_if(truth = 1 AND pred = 0)::DOUBLE AS fn, count_if(truth = 0 AND pred = 0)::DOUBLE AS tn, avg(pow(score - truth, 2)) AS brier FROM b)
    SELECT round(2 * tp / (2 * tp + fp + fn), 6) AS f1, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(tn / (tn + fp), 6) AS specificity,
      round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round((tp / (tp + fn) + tn / (tn + fp)) / 2, 6) AS balanced_accuracy,
      round((tp * tn - fp * fn) / sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)), 6) AS matthews_corrcoef, round(brier, 6) AS brier_score FROM s""")
def m7(t):
    return mt.binary(_bin(t), "truth", "pred", "score")


_CURVE = """g AS (SELECT score, count(*) AS n, sum(truth) AS pos FROM b GROUP BY 1),
    c AS (SELECT score, n, pos, sum(n) OVER w AS run_n, sum(pos) OVER w AS run_pos FROM g WINDOW w AS (ORDER BY score DESC))"""


@query("m8_average_precision_auc", f"""WITH {_BIN}, {_CURVE}, r AS (SELECT truth, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS r FROM b)
    SELECT (SELECT round(sum(pos * run_pos / run_n::DOUBLE) / sum(pos), 6) FROM c) AS average_precision,
      (SELECT round((sum(r * truth) - sum(truth) * (sum(truth) + 1) / 2) / (sum(truth) * (count(*) - sum(truth)))::DOUBLE, 6) FROM r) AS roc_auc""")
def m8(t):
    return mt.ranking_quality(_bin(t), "truth", "score")


@query("m9_precision_recall_curve", f"""WITH {_BIN}, {_CURVE} SELECT score AS threshold, round(run_pos / run_n::DOUBLE, 6) AS precision,
    round(run_pos / (SELECT sum(truth) FROM b)::DOUBLE, 6) AS recall FROM c""")
def m9(t):
    return mt.curve(_bin(t), "truth", "score").select("threshold", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


@query("j6_adjusted_rand", """WITH d AS (SELECT label AS a, vec_id % 4 + label % 3 AS b FROM embeddings), c AS (SELECT a, b, count(*)::DOUBLE AS n FROM d GROUP BY ALL),
    s AS (SELECT (SELECT sum(n * (n - 1) / 2) FROM c) AS s, (SELECT sum(n * (n - 1) / 2) FROM (SELECT sum(n) AS n FROM c GROUP BY a)) AS sa,
      (SELECT sum(n * (n - 1) / 2) FROM (SELECT sum(n) AS n FROM c GROUP BY b)) AS sb, (SELECT sum(n) * (sum(n) - 1) / 2 FROM c) AS st)
    SELECT round((s - sa * sb / st) / ((sa + sb) / 2 - sa * sb / st), 6) AS adjusted_rand FROM s""")
def j6(t):
    d = t("embeddings").select("label", (F.col("vec_id") % 4 + F.col("label") % 3).alias("other"))
    return mt.adjusted_rand(d, "label", "other")


@query("l6_class_weights", f"""WITH {_MULTI}, c AS (SELECT truth, count(*) AS n FROM multi GROUP BY 1)
    SELECT id, truth, round((SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * n)::DOUBLE, 6) AS weight FROM multi JOIN c USING (truth)""")
def l6(t):
    return mt.class_weights(_multi(t).select("id", "truth"), "truth").select("id", "truth", F.round("weight", 6).alias("weight"))


@query("l1_group_holdout", f"""WITH {_MULTI}, g AS (SELECT platform, row_number() OVER (ORDER BY md5('42|' || platform), platform) AS r, count(*) OVER () AS n FROM (SELECT DISTINCT platform FROM multi))
    SELECT id, platform, r <= ceil(0.25 * n) AS is_test FROM multi JOIN g USING (platform)""")
def l1(t):
    return mt.group_holdout(_multi(t), "truth", "platform").select("id", "platform", "is_test")


_H = "('0x' || substr(md5('42|' || id), 1, 15))::BIGINT"


@query("l1_stratified_fallback", f"""WITH {_MULTI}, r AS (SELECT id, truth, row_number() OVER (PARTITION BY truth ORDER BY {_H}) AS r, count(*) OVER (PARTITION BY truth) AS n FROM multi)
    SELECT id, truth, r <= ceil(0.25 * n) AS is_test FROM r""")
def l1_stratified(t):
    d = written(_multi(t).select("id", "truth"), "labelled").withColumn("only", F.lit("one-group"))  # read by every step of the split
    return mt.group_holdout(d, "truth", "only").select("id", "truth", "is_test")


@query("l2_stratified_folds", f"""WITH {_MULTI} SELECT id, truth, ((row_number() OVER (PARTITION BY truth ORDER BY {_H}) - 1) % 3)::INTEGER AS fold FROM multi""")
def l2_folds(t):
    return mt.folds(_multi(t).select("id", "truth"), "truth", "id").select("id", "truth", "fold")
