"""Joins that stay safe when one key is hot or the small side is not small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
SALTS = 32


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """True when the table has at most ``max_rows`` rows; stops counting there."""
    return df.limit(max_rows + 1).count() <= max_rows


def bounded_join(
    big: DataFrame, small: DataFrame, keys: list[str], salt_by: str, how: str = "inner",
    max_rows: int = BROADCAST_ROWS, salts: int = SALTS, at_most: int | None = None,
) -> DataFrame:
    """Join on ``keys``, broadcasting ``small`` only after its size has been checked.

    Beyond the bound the join is salted: a hot key of ``big`` is spread over ``salts`` tasks by the hash of
    ``salt_by`` and ``small`` is repeated once per salt. ``at_most`` is a known bound on the rows of ``small``;
    without it the rows are counted, up to the bound.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    if at_most <= max_rows if at_most is not None else fits(small, max_rows):
        return big.join(F.broadcast(small), keys, how)
    b = big.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(salts)).cast("int"))
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return b.join(s, [*keys, "_salt"], how).drop("_salt")


def with_group_values(df: DataFrame, values: DataFrame, group: str, salt_by: str) -> DataFrame:
    """Rows with the values of their group (one row per group in ``values``), hot groups included.

    The number of groups is read from the group column alone, so the values are not computed twice.
    """
    few = fits(df.select(group).distinct())
    return bounded_join(df, values, [group], salt_by, at_most=0 if few else BROADCAST_ROWS + 1)


def aligned(left: DataFrame, right: DataFrame, key: str, vector: str, width: int = 16) -> DataFrame:
    """Rows with their vector; rows without one get a zero vector of the given width."""
    zero = F.array_repeat(F.lit(0.0).cast("float"), width)
    return left.join(right.select(key, vector), key, "left").withColumn(vector, F.coalesce(vector, zero))


def valid_only(items: DataFrame, allowed: DataFrame, keys: list[str]) -> DataFrame:
    return items.join(allowed.select(*keys).distinct(), keys, "left_semi")


def invalid_only(items: DataFrame, allowed: DataFrame, keys: list[str]) -> DataFrame:
    return items.join(allowed.select(*keys).distinct(), keys, "left_anti")
