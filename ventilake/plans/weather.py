"""T5 (weather station) and T6 (fan box) transforms: one projection each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import formulas as fx
from ..functions.fixed import TYPE_STATION
from ..operators import lookups as lk
from .household import day_range

STATION_OUTPUT = ("date", "temperature", "hr", "orientation", "vitesse_vent", "co2", "bousole", "capteur", "tranche_vent")
CAISSON_OUTPUT = ("date", "puissance", "pression", "consommation", "capteur")


def wind(readings: DataFrame) -> DataFrame:
    """F13, F14, F17, F18 on raw station counts."""
    out = readings.withColumns(
        {
            "orientation": fx.wind_direction("orientation"),
            "vitesse_vent": fx.wind_speed("vitesse_vent"),
        }
    )
    return out.withColumns(
        {"bousole": fx.compass("orientation"), "tranche_vent": fx.wind_class("vitesse_vent")}
    )


def weather_station(
    readings: DataFrame, facteur_temperature: DataFrame, day_from=None, day_to=None, strict: bool = False
) -> DataFrame:
    """T5: test_station rows.  The temperature factor is required: a station
    without one gets null temperature/hr, or, with ``strict``, an error
    naming the first stations without a factor."""
    r = day_range(readings, day_from, day_to)
    if strict:
        missing = (
            r.select(F.col("capteur").alias("__k")).distinct()
            .join(facteur_temperature.select(F.col("capteur_facteur").alias("__k")), "__k", "left_anti")
            .take(20)
        )
        if missing:
            raise ValueError("stations without facteur_temperature: " + ", ".join(str(m["__k"]) for m in missing))
    withf = lk.attach_factor(r, facteur_temperature, "capteur", "capteur_facteur", "__fct_t")
    out = withf.withColumn("temperature", fx.temperature("temperature", "__fct_t"))
    out = out.withColumns(
        {
            "hr": fx.relative_humidity("hr", "temperature"),
            "co2": fx.co2("co2", F.lit(TYPE_STATION)),
        }
    )
    return wind(out).select(*STATION_OUTPUT)


def calibrate_fanbox(readings: DataFrame, day_from=None, day_to=None) -> DataFrame:
    """test_caisson rows; consumption is written as 0.0 as in the original."""
    r = day_range(readings, day_from, day_to)
    return r.select(
        "date",
        fx.fan_power("puissance").alias("puissance"),
        fx.fan_pressure("pression").alias("pression"),
        F.lit(0.0).alias("consommation"),
        "capteur",
    )
