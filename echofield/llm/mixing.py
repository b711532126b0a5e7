"""Mixing sources to target weights: whole epochs first, then an Efraimidis-Spirakis sample for the fraction.

Every document draws ``u`` in (0, 1) from its id and gets the exponential key ``-ln(u) / w`` for its quality weight
``w``; sorting a source by that key is weighted sampling without replacement. The sorted sizes are summed up to the
part of the budget that whole epochs leave over.

A source is sorted in pieces: keys go through the distribution function they would have at the mean weight of the
source, which cuts each source into even ranges of about ``ROWS_IN_RANGE`` documents. Running sums are taken in each
range and shifted by the totals of the ranges before it, so that no task sorts a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from echofield.llm.common import WORD, staged, with_group

WEIGHTS = (5.0, 2.0, 1.0)
TOTAL_SHARE = 1.5
MOST_EPOCHS = 2
ROWS_IN_RANGE = 2_000
#: ASCII characters that are neither letters nor white space: their share lowers the quality weight.
ASCII_MARKS = r"[!-@\[-`{-~]"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mark_weight(text: Column) -> Column:
    """1 for plain prose, down to 1/11 for text of digits and punctuation only."""
    n = F.coalesce(F.length(text), F.lit(0))
    marks = F.coalesce(F.regexp_count(text, F.lit(ASCII_MARKS)), F.lit(0))
    return F.when(n == 0, F.lit(1.0)).otherwise(n / (n + 10 * marks))


def draw(text: Column, id_col: Column) -> Column:
    """A number in (0, 1) from the id; a null id draws from its text."""
    h = F.conv(F.substring(F.md5(F.coalesce(id_col.cast("string"), text, F.lit("")).cast("binary")), 1, 13), 16, 10).cast("long")
    return (h + F.lit(0.5)) / F.lit(float(1 << 52))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, total_share: float = TOTAL_SHARE, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """``_source`` (null last), ``_source_size``, ``_docs`` and more -> the same with ``_target``.

    Weights repeat in the order of the names by code point, null last. A target stops at ``most_epochs`` sizes of its
    source; what lies above is shared anew by weight until no target is above. Closed form: sources sorted by the
    ratio of cap to weight reach their caps in that order. The table has one row for each source.
    """
    cap = F.lit(float(most_epochs)) * F.col("_source_size")
    position = F.row_number().over(W.orderBy(F.col("_source").isNull(), F.col("_source"))) - 1
    cycle = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(position, F.lit(len(weights))) + 1).cast("int"))
    s = sizes.withColumn("_position", position).withColumn("_weight", cycle).withColumn("_cap", cap)
    s = staged(s.withColumn("_ratio", F.col("_cap") / F.col("_weight")), "mix-sources")
    upto = W.orderBy("_ratio", "_position").rowsBetween(W.unboundedPreceding, W.currentRow)
    budget = F.sum("_source_size").over(W.partitionBy()) * F.lit(total_share)
    left = F.sum("_weight").over(W.partitionBy()) - F.sum("_weight").over(upto) + F.col("_weight")
    level = (budget - (F.sum("_cap").over(upto) - F.col("_cap"))) / left
    steps = s.select("_ratio", "_position", level.alias("_level"))
    found = steps.filter("_level <= _ratio").agg(F.min_by("_level", F.struct("_ratio", "_position")).alias("_level"))
    return s.withColumn("_target", F.coalesce(F.least("_cap", found.scalar() * F.col("_weight")), F.col("_cap")))


def mix(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", source: str = "source", weights: tuple[float, ...] = WEIGHTS,
    total_share: float = TOTAL_SHARE, most_epochs: int = MOST_EPOCHS, weight: Column | None = None, keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per input row: ``id_col``, ``size``, ``source_size``, ``target``, ``copies``, ``taken``, and ``keep``.

    ``size`` is the number of words of the whole text (null or empty: 0), ``copies`` how often the mix takes the
    document, ``taken`` = ``size * copies``. Of the documents of a source, in the order of their keys, those are in the
    fraction whose middle word lies inside the rest of the budget, so the words taken miss the target by half a
    document at most. ``copies`` is at most ``most_epochs``. A null source is a source of its own. Equal keys are ordered by id;
    rows that repeat an id share one draw. Documents without words take no budget; they are in the fraction as their keys fall.
    No words at all: all targets are 0. An empty table gives an empty result. Other columns of the input are ignored
    whatever their names. Runs over the same rows agree.
    """
    t = F.col(text)
    rows = docs.select(
        F.col(id_col).alias("_id"), F.col(source).alias("_source"), words(t).alias("_size"),
        (mark_weight(t) if weight is None else weight).cast("double").alias("_w"), draw(t, F.col(id_col)).alias("_u"),
        *[F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)],
    )
    named = F.concat(F.lit("s"), F.col("_source"))
    rows = staged(rows.select(F.coalesce(named, F.lit("n")).alias("_key"), "*"), "mix-rows")
    sizes = rows.groupBy("_key", "_source").agg(
        F.sum("_size").alias("_source_size"), F.count(F.lit(1)).alias("_docs"), F.avg("_w").alias("_mean_w")
    )
    total = rows.count()
    plan = staged(targets(sizes, weights, total_share, most_epochs).drop("_source"), "mix-targets")

    d = with_group(rows, plan.select("_key", "_source_size", "_docs", "_mean_w", "_target"), "_key", "_docs", total)
    epochs = F.when(F.col("_source_size") == 0, F.lit(0)).otherwise(F.floor(F.col("_target") / F.col("_source_size")))
    key = -F.log("_u") / F.greatest("_w", F.lit(1e-6))
    ranges = F.ceil(F.col("_docs") / ROWS_IN_RANGE)
    d = d.withColumn("_epochs", epochs.cast("long")).withColumn("_sort", key)
    d = d.withColumn("_rest", F.col("_target") - F.col("_epochs") * F.col("_source_size"))
    d = d.withColumn("_range", F.least(ranges - 1, F.floor(ranges * (1 - F.exp(-F.col("_sort") * F.col("_mean_w"))))))
    sums = d.groupBy("_key", "_range").agg(F.sum("_size").alias("_in_range"))
    before = F.sum("_in_range").over(W.partitionBy("_key").orderBy("_range").rowsBetween(W.unboundedPreceding, -1))
    sums = sums.select("_key", "_range", F.coalesce(before, F.lit(0)).alias("_before"))
    inside = W.partitionBy("_key", "_range").orderBy("_sort", "_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    d = d.withColumn("_upto", F.sum("_size").over(inside)).join(sums, ["_key", "_range"])
    middle = F.col("_before") + F.col("_upto") - F.col("_size") / 2
    picked = (F.col("_rest") > 0) & (middle <= F.col("_rest")) & (F.col("_epochs") < most_epochs)
    copies = F.col("_epochs") + F.when(picked, 1).otherwise(0)
    return d.select(
        F.col("_id").alias(id_col), F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
        copies.alias("copies"), (F.col("_size") * copies).alias("taken"), *[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)],
    )
