"""Classification metrics as relational aggregates.

Counts are aggregated before anything is ordered; score orderings use ``order.running_totals`` so no task
ever sorts the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echofield.operators import joins, order
from echofield.operators.profile import rows_n

TINY = 2.220446049250313e-16


def _div(a, b) -> Column:
    """a / b, 0 where b is 0."""
    return F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))


def confusion(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """(truth, pred, n) on the full grid of labels seen on either side."""
    counts = df.groupBy(F.col(truth).alias("truth"), F.col(pred).alias("pred")).agg(rows_n().alias("n"))
    seen = counts.agg(F.array_sort(F.array_union(F.collect_set("truth"), F.collect_set("pred"))).alias("labels"))
    grid = seen.select(F.explode("labels").alias("truth"), "labels").select("truth", F.explode("labels").alias("pred"))
    return grid.join(counts, ["truth", "pred"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


def per_class(conf: DataFrame) -> DataFrame:
    """(class, precision, recall, f1, support) plus the raw counts tp and predicted."""
    sides = conf.select(F.inline(F.array(
        F.struct(F.col("truth").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"),
                 F.when(F.col("truth") == F.col("pred"), F.col("n")).otherwise(0).alias("tp")),
        F.struct(F.col("pred").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"),
                 F.lit(0).cast("long").alias("tp")),
    )))
    g = sides.groupBy("class").agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp"))
    p, r = _div(F.col("tp"), F.col("predicted")), _div(F.col("tp"), F.col("support"))
    return g.select("class", "support", "predicted", "tp", p.alias("precision"), r.alias("recall"),
                    _div(2 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1"))


def summary(classes: DataFrame, digits: int = 6) -> DataFrame:
    """One row: accuracy, balanced accuracy, macro and weighted precision/recall/F1."""
    n = F.sum("support")
    out = {"accuracy": _div(F.sum("tp"), n), "balanced_accuracy": F.avg(F.when(F.col("support") > 0, F.col("recall")))}
    for m in ("precision", "recall", "f1"):
        out[f"macro_{m}"] = F.avg(m)
        out[f"weighted_{m}"] = _div(F.sum(F.col(m) * F.col("support")), n)
    return classes.agg(*[F.round(e, digits).alias(k) for k, e in out.items()])


def agreement(classes: DataFrame, digits: int = 6) -> DataFrame:
    """One row: Cohen kappa and the multiclass correlation coefficient."""
    s = classes.agg(
        F.sum("support").cast("double").alias("n"), F.sum("tp").cast("double").alias("c"),
        F.sum(F.col("support") * F.col("predicted").cast("double")).alias("tp_pp"),
        F.sum(F.col("support") * F.col("support").cast("double")).alias("tt"),
        F.sum(F.col("predicted") * F.col("predicted").cast("double")).alias("pp"),
    )
    n2 = F.col("n") * F.col("n")
    expected = F.col("tp_pp") / n2
    kappa = (F.col("c") / F.col("n") - expected) / F.nullif(1 - expected, F.lit(0.0))
    bottom = F.sqrt((n2 - F.col("pp")) * (n2 - F.col("tt")))
    mcc = (F.col("c") * F.col("n") - F.col("tp_pp")) / F.nullif(bottom, F.lit(0.0))
    return s.select(F.round(kappa, digits).alias("kappa"), F.round(F.coalesce(mcc, F.lit(0.0)), digits).alias("matthews_corrcoef"))


def roc_auc_by_group(df: DataFrame, score: str, positive: str, group: str) -> DataFrame:
    """(group, positives, auc): rank-sum AUC with average ranks for equal scores; null when undefined."""
    run = order.running_totals(df, score, {"n": rows_n(), "pos": F.sum(positive)}, [group])
    mean_rank = F.col("run_n") - (F.col("n") - 1) / 2.0
    g = run.groupBy(group).agg(
        F.sum(F.col("pos") * mean_rank).alias("rank_sum"), F.sum("pos").cast("double").alias("p"),
        F.sum("n").cast("double").alias("n"),
    )
    neg = F.col("n") - F.col("p")
    auc = (F.col("rank_sum") - F.col("p") * (F.col("p") + 1) / 2) / F.nullif(F.col("p") * neg, F.lit(0.0))
    return g.select(group, F.col("p").alias("positives"), auc.alias("auc"))


def ovr_roc_auc(df: DataFrame, truth: str, probabilities: str, digits: int = 6) -> DataFrame:
    """One row: one-vs-rest AUC weighted by class prevalence; null when a class makes it undefined."""
    long = df.select(truth, F.posexplode(probabilities).alias("_c", "_p")).select(
        "_c", "_p", (F.col(truth) == F.col("_c")).cast("long").alias("_y")
    )
    a = roc_auc_by_group(long, "_p", "_y", "_c")
    whole = F.when(F.count_if(F.col("auc").isNull()) == 0, F.sum(F.col("auc") * F.col("positives")) / F.sum("positives"))
    return a.agg(F.round(whole, digits).alias("roc_auc_ovr"))


def probability_losses(df: DataFrame, truth: str, probabilities: str, digits: int = 6) -> DataFrame:
    """One row: mean squared gap to the one-hot truth over all (row, class) cells, and log loss."""
    p, y = F.col(probabilities), F.col(truth)
    gaps = F.aggregate(
        F.transform(p, lambda x, i: F.pow(F.when(i == y, 1.0).otherwise(0.0) - x, F.lit(2.0))), F.lit(0.0), lambda s, x: s + x
    )
    total = F.aggregate(p, F.lit(0.0), lambda s, x: s + x)
    at = F.element_at(p, (y + 1).cast("int")) / total
    loss = -F.log(F.greatest(F.lit(TINY), F.least(F.lit(1 - TINY), at)))
    return df.select(gaps.alias("_g"), F.size(p).alias("_k"), loss.alias("_l")).agg(
        F.round(F.sum("_g") / F.sum("_k"), digits).alias("brier_like"), F.round(F.avg("_l"), digits).alias("log_loss")
    )


def binary(df: DataFrame, truth: str, pred: str, score: str | None = None, digits: int = 6) -> DataFrame:
    """One row of the two-class metrics at a decision; brier_score when a score is given."""
    t, p = F.col(truth) == 1, F.col(pred) == 1
    brier = F.avg(F.pow(F.col(score) - F.col(truth), F.lit(2.0))) if score else F.lit(None).cast("double")
    s = df.agg(
        F.count_if(t & p).cast("double").alias("tp"), F.count_if(~t & p).cast("double").alias("fp"),
        F.count_if(t & ~p).cast("double").alias("fn"), F.count_if(~t & ~p).cast("double").alias("tn"),
        brier.alias("brier"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    sensitivity, specificity = tp / F.nullif(tp + fn, F.lit(0.0)), tn / F.nullif(tn + fp, F.lit(0.0))
    balanced = F.when(sensitivity.isNull(), specificity).when(specificity.isNull(), sensitivity).otherwise((sensitivity + specificity) / 2)
    mcc = (tp * tn - fp * fn) / F.nullif(F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)), F.lit(0.0))
    out = {
        "f1": _div(2 * tp, 2 * tp + fp + fn), "precision": _div(tp, tp + fp), "recall": _div(tp, tp + fn),
        "specificity": specificity, "accuracy": (tp + tn) / (tp + fp + fn + tn), "balanced_accuracy": balanced,
        "matthews_corrcoef": F.coalesce(mcc, F.lit(0.0)), "brier_score": F.col("brier"),
    }
    return s.select(*[F.round(e, digits).alias(k) for k, e in out.items()])


def curve(df: DataFrame, truth: str, score: str) -> DataFrame:
    """(threshold, precision, recall, n, pos, …): one point per distinct score."""
    run = order.running_totals(df, score, {"n": rows_n(), "pos": F.sum(F.col(truth).cast("long"))}, descending=True)
    run = run.withColumn("_p", df.filter(F.col(score).isNotNull()).agg(F.sum(F.col(truth).cast("long"))).scalar())
    return run.select(
        F.col(score).alias("threshold"), "n", "pos", "run_n", "run_pos",
        (F.col("run_pos") / F.col("run_n")).alias("precision"), _div(F.col("run_pos"), F.col("_p")).alias("recall"),
    )


def ranking_quality(df: DataFrame, truth: str, score: str, digits: int = 6) -> DataFrame:
    """One row: step-wise average precision and ROC AUC.

    With P positives, each point adds pos/P * precision to the first; the second uses average ranks.
    """
    c = curve(df, truth, score)
    p, n = F.sum("pos").cast("double"), F.sum("n").cast("double")
    # ranks counted from the top, ties averaged; N + 1 minus that is the rank from the bottom
    from_top = F.sum(F.col("pos") * (F.col("run_n") - (F.col("n") - 1) / 2.0))
    rank_sum = p * (n + 1) - from_top
    auc = (rank_sum - p * (p + 1) / 2) / F.nullif(p * (n - p), F.lit(0.0))
    return c.agg(
        F.round(F.sum(F.col("pos") * F.col("precision")) / F.nullif(p, F.lit(0.0)), digits).alias("average_precision"),
        F.round(auc, digits).alias("roc_auc"),
    )


def adjusted_rand(df: DataFrame, a: str, b: str, digits: int = 6) -> DataFrame:
    """One row: adjusted Rand index from the contingency counts."""
    pairs = lambda c: c * (c - 1) / 2.0
    cells = df.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(rows_n().cast("double").alias("n"))
    both = cells.agg(F.sum(pairs(F.col("n"))).alias("s"), F.sum("n").alias("total"))
    one = lambda k, name: cells.groupBy(k).agg(F.sum("n").alias("n")).agg(F.sum(pairs(F.col("n"))).alias(name))
    d = both.withColumn("sa", one("a", "x").scalar()).withColumn("sb", one("b", "x").scalar())
    expected = F.col("sa") * F.col("sb") / F.nullif(pairs(F.col("total")), F.lit(0.0))
    top = 0.5 * (F.col("sa") + F.col("sb"))
    ari = F.when(top == expected, 1.0).otherwise((F.col("s") - expected) / (top - expected))
    return d.select(F.round(ari, digits).alias("adjusted_rand"))


def class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Rows with the balanced weight n / (classes * class rows); the lookup has one row per class."""
    c = df.groupBy(label).agg(rows_n().alias("_c"))
    t = c.agg(F.struct(F.sum("_c").alias("n"), rows_n().alias("k"))).scalar()
    c = c.withColumn("_t", t).select(label, (F.col("_t.n") / (F.col("_t.k") * F.col("_c"))).alias(name))
    spread_by = next(x for x in df.columns if x != label)
    return joins.with_group_values(df, c, label, spread_by)


def group_holdout(
    df: DataFrame, label: str, group: str, key: str = "id", share: float = 0.25, seed: int = 42, name: str = "is_test"
) -> DataFrame:
    """Rows with ``is_test``: whole groups held out, or a per-class split when that cannot work.

    Groups are ordered by md5(seed|group) and the first ceil(share * groups) are the test side: a comparison
    of each row's own hash with one number, so no join is needed. With fewer than
    two groups, or a one-class test side, every class gives its first ceil(share * rows) rows by md5(seed|key).
    """
    d = df.withColumn("_g", F.coalesce(F.col(group).cast("string"), F.lit("unknown")))
    names = d.select("_g").distinct().withColumn("_h", _lottery_number("_g", seed))
    cut = order.lowest_share(names, "_h", share).first()  # one row: number of groups and the last test number
    test = _lottery_number("_g", seed) <= F.lit(cut["_limit"])
    seen = d.agg(F.countDistinct(label).alias("all"), F.countDistinct(F.when(test, F.col(label))).alias("test")).first()
    if cut["_total"] >= 2 and (seen["all"] < 2 or seen["test"] >= 2):
        return d.withColumn(name, test).drop("_g")
    return stratified_split(df, label, key, share, seed, name)


def stratified_split(df: DataFrame, label: str, key: str, share: float = 0.25, seed: int = 42, name: str = "is_test"):
    """Per class, the first ceil(share * rows) rows by hash: exact counts, hot classes spread over ranges."""
    d = df.withColumn("_h", _lottery_number(key, seed))
    limit = order.lowest_share(d, "_h", share, label).drop("_total")
    return joins.with_group_values(d, limit, label, "_h").withColumn(name, F.col("_h") <= F.col("_limit")).drop("_h", "_limit")


def folds(df: DataFrame, label: str, key: str, k: int = 3, seed: int = 42, name: str = "fold") -> DataFrame:
    """Fold number per row: the place inside the class by hash, modulo k. No window over a whole class."""
    d = df.withColumn("_h", _lottery_number(key, seed))
    run = order.running_totals(d, "_h", {"n": rows_n()}, [label]).select(label, "_h", (F.col("run_n") - 1).alias("_at"))
    return d.join(run, [label, "_h"]).withColumn(name, (F.col("_at") % k).cast("int")).drop("_h", "_at")


def _lottery_number(key: str, seed: int) -> Column:
    """A 60-bit number from md5(seed|key)."""
    h = F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("long")
