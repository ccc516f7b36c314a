"""Household aggregates (per household and minute).

One form for every size: ``groupBy`` aggregates, combined on the map side
before the shuffle, joined back on the keys.  No group is ever held whole by
one task, and in the join-back the readings' side of a hot household-minute is
split by AQE's skew join (the aggregate has one row per group).

Sums and means are exact in any order of rows (``functions.exact``), so the same
readings give the same bits for any partitioning.

Rows with a null household or minute are dropped first, as the inner joins of
the original drop them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exact import exact_mean, exact_sum
from ..functions.fixed import TYPE_AIR_INLET, TYPE_EXTRACT_VENT

KEYS = ("logement", "date")


def keyed(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Rows that can belong to a household group."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return df.where(cond)


def _mean_input(c: str, real_only: bool):
    """Column averaged for the household means: every row (virtual rows hold
    0.0, as in the original) or, with ``real_only``, real sensors only."""
    return F.when(F.col("reel"), F.col(c)) if real_only else F.col(c)


def household_means(df: DataFrame, keys: Sequence[str] = KEYS, real_only: bool = False) -> DataFrame:
    """A1/A2: mean temperature and hr per household and minute.

    Virtual sensors hold 0.0 at this point and are counted, as in the
    original; ``real_only=True`` averages real sensors only."""
    return df.groupBy(*keys).agg(
        exact_mean(_mean_input("temperature", real_only)).alias("temperature_moyenne"),
        exact_mean(_mean_input("hr", real_only)).alias("hr_moyen"),
    )


def fill_virtual(df: DataFrame, means: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """P4 + J8: virtual sensors take the household means (joined on ``keys``)."""
    out = df.join(means, list(keys), "inner")
    return out.withColumns(
        {
            "temperature": F.when(F.col("reel"), F.col("temperature")).otherwise(F.col("temperature_moyenne")),
            "hr": F.when(F.col("reel"), F.col("hr")).otherwise(F.col("hr_moyen")),
        }
    ).drop("temperature_moyenne", "hr_moyen")


def _group_sum_to(df: DataFrame, value: str, target: str, typ: str, keys: Sequence[str]) -> DataFrame:
    """Sum of ``value`` over the household-minute, given to rows of type ``typ``."""
    match = F.coalesce(F.col("type") == typ, F.lit(False))
    sums = df.groupBy(*keys).agg(exact_sum(F.col(value)).alias("__s"))
    out = df.join(sums, list(keys), "inner")
    return out.withColumn(target, F.when(match, F.col("__s")).otherwise(F.lit(0.0))).drop("__s")


def flow_sum(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """A3: sum of produced flow over the whole group, given to extract vents
    (``somme_debits_extraits``), 0.0 for the other rows."""
    return _group_sum_to(df, "debit_produit", "somme_debits_extraits", TYPE_EXTRACT_VENT, keys)


def surface_sum(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """A4: sum of equivalent surfaces over the group, given to air inlets."""
    return _group_sum_to(df, "surface_equivalente_ea", "somme_surface_equivalente", TYPE_AIR_INLET, keys)


def household_totals(df: DataFrame, keys: Sequence[str] = KEYS, factor: str = "__fct_s") -> DataFrame:
    """A3 + F15 + A5 + A6 + J6 in one aggregate per group.

    ``somme_debits_extraits`` = max over rows of (S if extract vent else 0.0)
    with S the sum of produced flow; ``somme_surface_equivalente`` = max over
    rows of (fct1(household) + produced flow if air inlet else 0.0).  Both
    maxima are rebuilt from conditional aggregates, so no per-row value has
    to be joined back before taking the maximum.  fct1 (column ``factor``) is
    constant per household, so max(fct1 + x) = fct1 + max(x) exactly.
    """
    vent = F.coalesce(F.col("type") == TYPE_EXTRACT_VENT, F.lit(False))
    inlet = F.coalesce(F.col("type") == TYPE_AIR_INLET, F.lit(False))
    agg = df.groupBy(*keys).agg(
        exact_sum(F.col("debit_produit")).alias("__s"),
        F.count(F.when(vent, 1)).alias("__n_vent"),
        F.count(F.when(~vent, 1)).alias("__n_other"),
        F.max(F.when(inlet, F.col("debit_produit"))).alias("__max_inlet"),
        F.count(F.when(inlet, 1)).alias("__n_inlet"),
        F.count(F.when(~inlet, 1)).alias("__n_not_inlet"),
        F.max(factor).alias("__fct"),
    )
    extracted = (
        F.when(F.col("__n_vent") == 0, F.lit(0.0))
        .when(F.col("__n_other") == 0, F.col("__s"))
        .otherwise(F.greatest(F.col("__s"), F.lit(0.0)))
    )
    inlet_max = F.when(F.col("__n_inlet") > 0, F.col("__fct") + F.col("__max_inlet"))
    surface = F.when(F.col("__n_not_inlet") > 0, F.greatest(inlet_max, F.lit(0.0))).otherwise(inlet_max)
    return agg.select(
        *keys,
        extracted.alias("somme_debits_extraits"),
        surface.alias("somme_surface_equivalente"),
    )


def daily_real_hr(df: DataFrame) -> DataFrame:
    """Mean hr of real sensors per day of year and household."""
    return (
        df.where(F.col("reel"))
        .groupBy(F.dayofyear("date").alias("jour"), "logement")
        .agg(exact_mean(F.col("hr")).alias("hr_moyen"))
    )
