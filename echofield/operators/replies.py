"""Reply templates: fill, score, choose, apply."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echofield import fixed
from echofield.functions import labels as lb
from echofield.operators import pick, profile


def all_replies(df: DataFrame, route: str = "route", templates: dict[str, str] | None = None) -> DataFrame:
    """Every row with every template: (…, generator, response). The constant templates expand inside the row."""
    templates = templates or fixed.REPLY_TEMPLATES
    items = F.array(
        *[F.struct(F.lit(n).alias("generator"), lb.reply(s, F.col(route)).alias("response")) for n, s in templates.items()]
    )
    return df.select("*", F.inline(items))


def score_replies(df: DataFrame, content: str = "content", name: str = "quality_score") -> DataFrame:
    return df.withColumn(name, F.round(lb.reply_quality(F.col(content), F.col("response")), 6))


def sample_scores(reviews: DataFrame, n: int = 400, seed: int = 42) -> DataFrame:
    """Long (id, generator, route, quality_score) over a deterministic sample."""
    return score_replies(all_replies(pick.sample_rows(reviews, n, seed=seed)))


def choose(reviews: DataFrame, n: int = 400, seed: int = 42) -> DataFrame:
    """Summary per generator on the sample, best mean first."""
    return profile.spread_summary(sample_scores(reviews, n, seed), "generator", "quality_score")


def apply_best(reviews: DataFrame, summary: DataFrame) -> DataFrame:
    """Every review with the winner's reply and its score. The winner is a one-value subquery."""
    best = summary.orderBy(F.desc("avg_quality_score"), F.asc("generator")).limit(1).select("generator")
    filled = F.lit(None).cast("string")
    d = reviews.withColumn("generator", best.scalar())
    for name, sentence in fixed.REPLY_TEMPLATES.items():
        filled = F.when(F.col("generator") == name, lb.reply(sentence, F.col("route"))).otherwise(filled)
    d = d.withColumn("response", filled)
    return score_replies(d, name="response_quality_score").withColumnRenamed("response", "suggested_response")
