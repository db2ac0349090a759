"""Numeric column helpers (pure Column expressions, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_dp(col: Column | str, digits: int) -> Column:
    """Round half to even on the decimal value, returned as DOUBLE.

    Going through DECIMAL makes the result independent of how an engine
    multiplies binary doubles, so the same SQL gives the same digits.  A value
    such as 2.675, which binary doubles can't hold, counts as the decimal that
    it is written as; a rounding of the binary value may differ there.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.bround(c.cast("decimal(38,12)"), digits).cast("double")


def no_nan(col: Column | str) -> Column:
    """The value, NULL for NaN (a missing number written by another tool)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(~F.isnan(c), c)


def best_first(col: Column | str) -> Column:
    """Descending sort key; NULL and NaN come last."""
    return no_nan(col).desc_nulls_last()


def least_first(col: Column | str) -> Column:
    """Ascending sort key; NULL and NaN come last."""
    return no_nan(col).asc_nulls_last()


def score_key(col: Column | str) -> Column:
    """A score as a sort key: 12 decimals, below which sums of doubles depend on
    the order of their addition and a rank would differ between runs."""
    return no_nan(col).cast("decimal(38,12)")


def norm3(x: Column, y: Column, z: Column) -> Column:
    """Euclidean norm of a 3-vector given as three columns."""
    return F.sqrt(x * x + y * y + z * z)


def safe_norm3(x: Column, y: Column, z: Column) -> Column:
    """Norm with the exact zero guard: a zero-length vector divides by 1."""
    n = norm3(x, y, z)
    return F.when(n == 0.0, F.lit(1.0)).otherwise(n)


def distance3(a: Column, b: Column) -> Column:
    """Distance between two ``struct<x,y,z>`` columns."""
    return norm3(a["x"] - b["x"], a["y"] - b["y"], a["z"] - b["z"])


# Doubles as three integers for sums that do not depend on their order: units
# of 2^-20 and, of what is left, units of 2^-52 and of 2^-84.  The sums stay
# within a long for a billion addends of up to 8192 (fewer if larger).
_UNIT, _NEXT = float(1 << 20), float(1 << 32)
_LARGEST = float(1 << 42)


def exact_sum(value: Column) -> Column:
    """Sum of doubles that gives the same bits for any order and partitioning
    of its rows: each value is taken to 2^-84, below the last bit of any
    coordinate, and added up as integers; the sum of one value is that value.
    NULL and NaN are left out; NULL for no values, NaN where a value is too
    large (2^42 or infinite)."""
    v = no_nan(value)
    large = F.abs(v) >= F.lit(_LARGEST)
    scaled = F.when(~large, v * F.lit(_UNIT))
    coarse = scaled.cast("bigint")
    rest = (scaled - coarse.cast("double")) * F.lit(_NEXT)
    middle = rest.cast("bigint")
    fine = F.rint((rest - middle.cast("double")) * F.lit(_NEXT)).cast("bigint")
    total = (F.sum(coarse).cast("double") / F.lit(_UNIT)
             + (F.sum(middle).cast("double") / F.lit(_UNIT * _NEXT)
                + F.sum(fine).cast("double") / F.lit(_UNIT * _NEXT * _NEXT)))
    return F.when(F.count_if(large) > 0, F.lit(float("nan"))).otherwise(total)


def exact_avg(value: Column) -> Column:
    """Mean over the values that are neither NULL nor NaN, by ``exact_sum``."""
    return exact_sum(value) / F.count(no_nan(value))
