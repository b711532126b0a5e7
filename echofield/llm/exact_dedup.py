"""Exact deduplication by progressive refinement: length, then a prefix hash, then a full hash.

The first pass reads lengths and prefix hashes only and counts them (map-side partial sums, one row for each
distinct pair). Pairs that occur more than once survive. They are summed up in a bit table of fixed size that
goes with the second pass, so that no text is shuffled: a row that misses the table is unique for certain and its
full content is not hashed. Rows that hit it get a full hash, and only equal full hashes make a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echofield.llm.common import SPACE_CLASS, TABLE_BITS, bit_table, in_table, staged, with_group

PREFIX_CHARS = 64


def without_space(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_CLASS + "+", "")


def survivors(counts: DataFrame) -> DataFrame:
    """Pairs of length and prefix hash that more than one row has; lengths that one row has are out first."""
    lengths = counts.groupBy("_length").agg(F.sum("_n").alias("_rows")).filter("_rows > 1").select("_length")
    return counts.join(lengths, "_length", "left_semi").filter("_n > 1").select("_length", "_prefix")


def exact_dedup(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", keep: tuple[str, ...] = (),
    prefix_chars: int = PREFIX_CHARS, table_bits: int = TABLE_BITS,
) -> DataFrame:
    """One row per input row: ``id_col``, ``keep_id``, ``group_size``, ``kept``, and the columns named in ``keep``.

    Texts are equal when they are identical without the characters of ``[\\x20\\x09-\\x0D]``; a null text counts as
    empty, and all empty texts are equal. Of equal texts the row with the most code points in the original text
    stays, then the smallest id; a null id comes after every other and its ``kept`` is true only if no row of the
    group has an id. Rows that repeat an id with a text of the same rank all carry ``kept``: nothing orders them.
    Other columns of the input are ignored whatever their names. An empty table gives an empty result.
    """
    plain = without_space(F.col(text))
    base = docs.select(
        F.col(id_col).alias("_id"), F.length(F.coalesce(F.col(text), F.lit(""))).alias("_chars"), plain.alias("_plain"),
        *[F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)],
    )
    shape = [F.length("_plain").alias("_length"), F.xxhash64(F.left("_plain", F.lit(prefix_chars))).alias("_prefix")]
    counts = staged(base.select(*shape).groupBy("_length", "_prefix").agg(F.count(F.lit(1)).alias("_n")), "dedup-counts")
    table = staged(bit_table(survivors(counts), ["_length", "_prefix"], table_bits), "dedup-table")

    hit = in_table("_table", ["_length", "_prefix"], table_bits)
    carried = [f"_keep{i}" for i in range(len(keep))]
    rows = base.select("_id", "_chars", "_plain", *carried, *shape, table.scalar().alias("_table"))
    rows = rows.select("_id", "_chars", *carried, F.when(hit, F.unhex(F.sha2("_plain", 256))).alias("_full"))
    rows = staged(rows, "dedup-rows")

    total = rows.count()
    best = F.max_by("_id", F.struct(F.col("_chars"), F.col("_id").isNotNull(), -F.col("_id"))) if _numeric(docs, id_col) else F.min_by(
        "_id", F.struct(-F.col("_chars"), F.col("_id").isNull(), F.col("_id"))
    )
    groups = rows.filter(F.col("_full").isNotNull()).groupBy("_full").agg(best.alias("_keep_id"), F.count(F.lit(1)).alias("_size"))
    groups = staged(groups.filter("_size > 1"), "dedup-groups")
    out = with_group(rows, groups, "_full", "_size", total)
    alone = F.col("_size").isNull()
    keep_id = F.when(alone, F.col("_id")).otherwise(F.col("_keep_id"))
    return out.select(
        F.col("_id").alias(id_col), keep_id.alias("keep_id"), F.coalesce("_size", F.lit(1).cast("long")).alias("group_size"),
        keep_id.eqNullSafe(F.col("_id")).alias("kept"), *[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)],
    )


def _numeric(docs: DataFrame, id_col: str) -> bool:
    return dict(docs.dtypes)[id_col] in ("bigint", "int", "smallint", "tinyint")
