"""Rule labels, bands and driver scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from echofield import fixed
from echofield.functions import text as tx


def star_bucket(score: Column) -> Column:
    return (
        F.when(score.isNull() | F.isnan(score), "unknown")
        .when(score <= 2, "complaint")
        .when(score == 3, "mixed")
        .otherwise("positive")
    )


def high_engagement(thumbs: Column) -> Column:
    return F.coalesce(thumbs > 10, F.lit(False))


def severity_label(listed: Column, score: Column) -> Column:
    """2 for a text with a listed term, 1 for two stars or fewer, else 0; an absent score never counts as low."""
    return F.when(listed, 2).when(score <= 2, 1).otherwise(0)


def weak_label(content: Column, score: Column, legal: list[str] | None = None) -> Column:
    """2 for a legal term, 1 for two stars or fewer, else 0; an absent score never counts as low."""
    return severity_label(tx.any_word(content, legal or fixed.LEGAL_TERMS), score)


def gold_label(content: Column, score: Column, legal=None, pair=fixed.GOLD_WORD_PAIR) -> Column:
    low = F.lower(content)
    both = F.coalesce(F.contains(low, F.lit(pair[0])) & F.contains(low, F.lit(pair[1])), F.lit(False))
    return severity_label(tx.any_word(content, legal or fixed.LEGAL_TERMS) | both, score)


def severity_colour(isolated: Column, noise: Column) -> Column:
    return F.when(isolated & noise, "RED").when(isolated, "AMBER").otherwise("GREEN")


def churn_band(score: Column) -> Column:
    return F.when(score >= 0.7, "High").when(score >= 0.4, "Medium").otherwise("Low")


def churn_proxy(bucket: Column, score: Column, length: Column, long_from: Column) -> Column:
    unhappy = F.coalesce(score, F.lit(3.0)) <= 1
    rant = F.coalesce(length, F.lit(0)) >= long_from
    return ((bucket == "complaint") & (unhappy | rant)).cast("int")


def severity_drivers(content, score, thumbs, length, legal=None, money=None, top: int = 5) -> Column:
    """Array of (driver, weight), heaviest first, at most ``top``; one neutral entry when none applies."""
    entry = lambda key, w: F.struct(
        F.lit(fixed.DRIVER_NAMES[key]).alias("driver"), F.round(w, 4).alias("weight")
    )
    low = F.lower(F.coalesce(content, F.lit("")))
    n_legal = tx.substring_hits(content, legal or fixed.DRIVER_LEGAL_WORDS)
    n_money = tx.substring_hits(content, money or fixed.DRIVER_MONEY_WORDS)
    rules = [
        (n_legal > 0, entry("legal", 0.35 + 0.1 * F.least(n_legal, F.lit(2)))),
        (n_money > 0, entry("money", 0.22 + 0.05 * F.least(n_money, F.lit(3)))),
        (score <= 2, entry("stars", F.lit(0.18))),
        (thumbs >= 20, entry("thumbs", F.lit(0.16))),
        (length >= 40, entry("length", F.lit(0.10))),
        (F.contains(low, F.lit("!")), entry("exclaim", F.lit(0.05))),
    ]
    found = F.array_compact(F.array(*[F.when(test, item) for test, item in rules]))
    ranked = F.array_sort(
        found,
        lambda a, b: F.when(a["weight"] > b["weight"], -1).when(a["weight"] < b["weight"], 1).otherwise(0),
    )
    return F.when(F.size(found) == 0, F.array(entry("none", F.lit(0.03)))).otherwise(F.slice(ranked, 1, top))


def reply(template: str, route: Column) -> Column:
    """The sentence with its {route} slot filled."""
    return F.replace(F.lit(template), F.lit("{route}"), route)


def reply_quality(complaint: Column, response: Column) -> Column:
    """0.45 word overlap + 0.25 empathy + 0.3 action - 0.4 blame."""
    tokens = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("[a-z]+"), F.lit(0)))
    lits = lambda ws: F.array(*[F.lit(w) for w in ws])
    c_words, r_words = tokens(F.coalesce(complaint, F.lit(""))), tokens(response)
    overlap = F.size(F.array_intersect(c_words, r_words)) / F.greatest(F.size(c_words), F.lit(1))
    empathy = F.arrays_overlap(r_words, lits(fixed.EMPATHY_WORDS)).cast("double")
    action = F.arrays_overlap(r_words, lits(fixed.ACTION_WORDS)).cast("double")
    blame = F.lower(response).rlike("|".join(fixed.BLAME_WORDS)).cast("double")
    return 0.45 * overlap + 0.25 * empathy + 0.3 * action - 0.4 * blame
