"""Sums and means that do not depend on the order of rows.

Doubles are added as fixed-point decimals with ``SCALE`` digits after the point
(half-up), which is exact in any order, combined map-side like any sum, and cast
to double once at the end.  So the same rows give the same bits on one partition
or a thousand, in a re-run and in another engine.

A group that holds a value without such a decimal (NaN, infinite, or ``LIMIT``
and beyond) takes the plain double sum instead.  Nulls are left out; a group of
nulls alone gives null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 10
#: values of this size and more are not held as decimals
LIMIT = 1e17


def _fixed(value: Column) -> Column:
    held = F.abs(value) < F.lit(LIMIT)  # NaN is above every number
    return F.when(held, value).cast(f"decimal(28,{SCALE})")


def exact_sum(value: Column) -> Column:
    """Aggregate: the sum of a double column, independent of the order of rows."""
    other = F.count(F.when(F.abs(value) >= F.lit(LIMIT), 1))
    return F.when(other > 0, F.sum(value)).otherwise(F.sum(_fixed(value)).cast("double"))


def exact_mean(value: Column) -> Column:
    """Aggregate: the mean of a double column, independent of the order of rows."""
    count = F.count(value)
    return F.when(count > 0, exact_sum(value) / count)


#: what is kept of a group so that it can be merged with others
PARTIAL = f"STRUCT<somme: DECIMAL(38,{SCALE}), brute: DOUBLE, autres: LONG, n: LONG>"


def partial_sum(value: Column) -> Column:
    """Aggregate: what a group gives to the sum and mean of a larger one (``PARTIAL``)."""
    other = F.count(F.when(F.abs(value) >= F.lit(LIMIT), 1))
    return F.struct(
        F.sum(_fixed(value)).alias("somme"),
        F.when(other > 0, F.sum(value)).alias("brute"),
        other.alias("autres"),
        F.count(value).alias("n"),
    ).cast(PARTIAL)


def merged_count(partial: Column) -> Column:
    """Aggregate over partials: the number of values."""
    return F.coalesce(F.sum(partial["n"]), F.lit(0))


def merged_sum(partial: Column) -> Column:
    """Aggregate over partials: :func:`exact_sum` of all their values, with the same bits for any
    split into partials (but for a plain sum, which depends on the order there as here)."""
    plain = F.sum(F.coalesce(partial["brute"], partial["somme"].cast("double")))
    return F.when(F.sum(partial["autres"]) > 0, plain).otherwise(F.sum(partial["somme"]).cast("double"))


def merged_mean(partial: Column) -> Column:
    """Aggregate over partials: :func:`exact_mean` of all their values."""
    count = merged_count(partial)
    return F.when(count > 0, merged_sum(partial) / count)
