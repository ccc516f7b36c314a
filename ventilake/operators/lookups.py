"""Dimension lookups as joins (sensor table, factor tables, band tables).

The original looked each factor up with one database query per reading.  Here
every dimension is read once and joined.  No broadcast is forced: Spark
broadcasts a side only when its estimated size (or, with AQE, its measured
size) is below ``spark.sql.autoBroadcastJoinThreshold``, and falls back to a
shuffle join otherwise, so a sensor table that grows past the limit still
works.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bands as bd


def one_row_per_key(dim: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """Make a factor table unique on ``key`` (largest value wins), so a join
    with it never multiplies readings."""
    return dim.groupBy(key).agg(*[F.max(v).alias(v) for v in values])


def join_sensor_dim(readings: DataFrame, capteur: DataFrame, sensor: str = "capteur") -> DataFrame:
    """Readings of known sensors only, with household, room, type and
    real/virtual flag.  ``reel`` null counts as virtual."""
    dim = capteur.select(
        F.col("id_capteur"),
        "logement",
        "piece",
        "type",
        F.coalesce(F.col("reel"), F.lit(False)).alias("reel"),
    )
    return readings.join(dim, readings[sensor] == dim["id_capteur"], "inner").drop("id_capteur")


def attach_factor(
    df: DataFrame,
    factor: DataFrame,
    on: str,
    factor_key: str,
    name: str,
    default: float | None = None,
) -> DataFrame:
    """Scalar factor ``fct1`` of the row's key, as column ``name``.

    Missing factors give ``default`` (J3: 0.0) or null (J2/J6, reported by
    :func:`missing_factors`)."""
    f = one_row_per_key(factor, factor_key, ["fct1"]).select(
        F.col(factor_key).alias("__fk"), F.col("fct1").alias(name)
    )
    out = df.join(f, df[on] == f["__fk"], "left").drop("__fk")
    if default is not None:
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit(default)))
    return out


def band_lookup(
    df: DataFrame, bands: DataFrame, coefficients: Sequence[str], sensor: str, value: str, prefix: str, most: int = bd.MOST
) -> DataFrame:
    """J4/J5 for a frame without the sensor dimension: adds ``<prefix>matched``
    and ``<prefix><column>`` of the winning band.  One row per reading.

    The band with ``borne_inf <= value < borne_sup`` wins, of several the one with
    the highest ``borne_inf``; sensors with more than ``most`` bands are looked up in
    pages (finding them runs jobs)."""
    pages = bd.band_pages(bands, coefficients, most)
    index = bd.band_index(bands, coefficients, pages).select(
        F.col("capteur_facteur").alias(prefix + "key"), F.col("points").alias(prefix + "points"), F.col("winners").alias(prefix + "winners")
    )
    won = df.join(index, df[sensor] == index[prefix + "key"], "left")
    band = bd.winner(F.col(prefix + "points"), F.col(prefix + "winners"), F.col(value), 2 * most)
    if pages is not None:
        won = bd.paged_winner(won, pages, sensor, F.col(value), prefix + "paged")
        band = F.coalesce(band, F.col(prefix + "paged"))
    won = won.withColumn(prefix + "band", band)
    names = ["borne_inf", "borne_sup", *coefficients]
    won = won.withColumns(
        {prefix + "matched": F.col(prefix + "band").isNotNull()}
        | {prefix + c: F.col(prefix + "band")[c] for c in names}
    )
    return won.drop(*[prefix + c for c in ("key", "points", "winners", "band", "paged")])


def sensor_dimension(
    dims: dict[str, DataFrame], coefficients: dict[str, Sequence[str]], pages: dict[str, bd.Pages | None] | None = None
) -> DataFrame:
    """Everything the household transform looks up, one row per sensor.

    The sensor table with its temperature and position factors, its
    breakpoints and winning bands and its household's surface factor: all joins
    here are between dimension tables, so the readings are joined once.
    Sensors that are in ``pages`` have no arrays here."""
    d = dims["capteur"].select(
        "id_capteur", "logement", "piece", "type", F.coalesce(F.col("reel"), F.lit(False)).alias("reel")
    )
    d = attach_factor(d, dims["facteur_temperature"], "id_capteur", "capteur_facteur", "__fct_t")
    d = attach_factor(d, dims["facteur_debit_position1"], "id_capteur", "capteur_facteur", "__fct_p1", default=0.0)
    d = attach_factor(d, dims["facteur_somme_surface_equivalente"], "logement", "logement_facteur", "__fct_s")
    for table, names in coefficients.items():
        index = bd.band_index(dims[table], names, (pages or {}).get(table)).select(
            F.col("capteur_facteur").alias("__bk"),
            F.col("points").alias(f"__points_{table}"),
            F.col("winners").alias(f"__winners_{table}"),
        )
        d = d.join(index, d["id_capteur"] == index["__bk"], "left").drop("__bk")
    return d


def missing_factors(
    readings_with_dim: DataFrame,
    facteur_temperature: DataFrame,
    facteur_surface: DataFrame,
    station_readings: DataFrame | None = None,
) -> DataFrame:
    """The lookups that abort the original job, listed as data.

    Real sensors with readings but no temperature factor, households with
    air-inlet readings but no surface factor, and (with ``station_readings``)
    weather stations without a temperature factor.  Keys are pre-aggregated
    (distinct) before the anti-joins.
    """
    sensors = (
        readings_with_dim.where(F.col("reel"))
        .select(F.col("capteur").alias("key"))
        .distinct()
        .join(facteur_temperature.select(F.col("capteur_facteur").alias("key")), "key", "left_anti")
        .select(F.lit("facteur_temperature").alias("factor_table"), "key")
    )
    households = (
        readings_with_dim.where((F.col("type") == "EA") & F.col("logement").isNotNull())
        .select(F.col("logement").alias("key"))
        .distinct()
        .join(facteur_surface.select(F.col("logement_facteur").alias("key")), "key", "left_anti")
        .select(F.lit("facteur_somme_surface_equivalente").alias("factor_table"), "key")
    )
    out = sensors.unionByName(households)
    if station_readings is None:
        return out
    stations = (
        station_readings.where(F.col("capteur").isNotNull())
        .select(F.col("capteur").alias("key"))
        .distinct()
        .join(facteur_temperature.select(F.col("capteur_facteur").alias("key")), "key", "left_anti")
        .select(F.lit("facteur_temperature (station)").alias("factor_table"), "key")
    )
    return out.unionByName(stations)
