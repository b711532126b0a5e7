"""Rounding, clipping and local bindings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once for use inside ``body``.

    A plain column used inside a higher-order function is evaluated again for every element; a bound one is
    evaluated once per row.
    """
    return F.transform(F.array(value), body)[0]


def round_even(c: Column, digits: int) -> Column:
    """Scale, round half to even in binary, scale back: the array-library rule."""
    return F.rint(c * (10.0**digits)) / (10.0**digits)


def clip(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))
